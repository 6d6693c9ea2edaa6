"""Query subsets, the smoothing sweep, and train/test evaluation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.analysis import query_terms
from quire.operators.evaluate import mean_metrics, metrics
from quire.operators.index import Index
from quire.operators.retrieval import LAMBDAS, best_hits, indexed, score, top_k

METRIC_COLUMNS = {"p": "p", "recall": "recall", "map": "ap", "ap": "ap"}


Range = str | tuple[int, int]


def parse_range(spec: Range) -> tuple[int | None, int | None]:
    """``'all'`` -> (None, None); ``'7'`` -> (7, 7); ``'a-b'`` -> (a, b);
    ``a > b`` is an error. Ids may be negative; a pair of numbers is a range as
    it is."""
    if isinstance(spec, tuple):
        return spec
    spec = spec.strip()
    if spec == "all":
        return None, None
    parts = re.fullmatch(r"(-?\d+)-(-?\d+)", spec)
    if parts:
        a, b = (int(x) for x in parts.groups())
        if a > b:
            raise ValueError(f"bad range {spec!r}: lower bound above upper bound")
        return a, b
    v = int(spec)
    return v, v


def select_queries(queries: DataFrame, spec: Range) -> DataFrame:
    """Keep queries by ``'all'``, one id, or inclusive range ``'a-b'``
    (a filter Spark pushes into the scan)."""
    lo, hi = parse_range(spec)
    if lo is None:
        return queries
    return queries.where(F.col("query_id").between(lo, hi))


def halves(queries: DataFrame) -> tuple[tuple[int, int], tuple[int, int]]:
    """The lower and upper half of the query ids' range, as ranges for
    training and test (one aggregate of two numbers is read back). No queries
    give (0, 0) twice."""
    lo, hi = queries.agg(F.min("query_id"), F.max("query_id")).first()
    if lo is None:
        return (0, 0), (0, 0)
    mid = (lo + hi) // 2
    return (lo, mid), (mid + 1, max(hi, mid + 1))


def split(queries: DataFrame, train: Range, test: Range) -> tuple[DataFrame, DataFrame]:
    """Two inclusive id ranges."""
    return select_queries(queries, train), select_queries(queries, test)


def sweep(docs: Index | DataFrame, train_queries: DataFrame, qrels: DataFrame, k: int,
          lambdas: Sequence[float] = LAMBDAS) -> DataFrame:
    """``(lambda, query_id, p, recall, ap)`` for every lambda, in one pass:
    lambda is a column of the scored rows, not a loop of jobs."""
    for x in lambdas:
        if not 0.0 < x <= 1.0:
            raise ValueError("lambda must be in (0, 1]")
    lams = [float(x) for x in lambdas]
    hits = top_k(score(docs, query_terms(train_queries), model="jm", lam=lams, best=k), k, ["lambda", "query_id"])
    return metrics(train_queries, hits, qrels, k, runs={"lambda": lams})


def best_lambda(sweep_metrics: DataFrame, metric: str = "map") -> DataFrame:
    """One row ``(best_lambda, best_value)``: highest mean of ``metric``; the
    lowest lambda wins a tie."""
    col = METRIC_COLUMNS[metric]
    means = sweep_metrics.groupBy("lambda").agg(F.coalesce(F.avg(col), F.lit(0.0)).alias("_m"))
    top = means.agg(F.max_by(F.struct("lambda", "_m"), F.struct(F.round("_m", 12), -F.col("lambda"))).alias("b"))
    return top.select(F.col("b.lambda").alias("best_lambda"), F.col("b._m").alias("best_value"))


def train_test(docs: Index | DataFrame, queries: DataFrame, qrels: DataFrame, k: int, model: str,
               train: Range | None, test: Range, metric: str = "map",
               lambdas: Sequence[float] = LAMBDAS) -> tuple[DataFrame, DataFrame | None, float | None]:
    """Evaluate ``model`` on the test range.

    ``jm``: sweep the training range, pick the best lambda (one small
    aggregate read back to the driver: a single number), rank the test range
    with it. ``tfidf``: no training. All phases read one index. Returns (test metrics, sweep or None,
    lambda or None).
    """
    test_q = select_queries(queries, test)
    docs = indexed(docs)
    if model == "tfidf":
        hits, _ = best_hits(docs, query_terms(test_q), k)
        return metrics(test_q, hits, qrels, k), None, None
    train_q = select_queries(queries, train or "all")
    sw = sweep(docs, train_q, qrels, k, lambdas)
    lam = best_lambda(sw, metric).first()["best_lambda"]
    hits, _ = best_hits(docs, query_terms(test_q), k, "jm", lam)
    return metrics(test_q, hits, qrels, k), sw, lam


def test_metric(m: DataFrame, metric: str = "map") -> DataFrame:
    """The chosen metric per query: ``(query_id, value)``."""
    return m.select("query_id", F.col(METRIC_COLUMNS[metric]).alias("value"))


__all__ = ["parse_range", "select_queries", "split", "sweep", "best_lambda", "train_test",
           "test_metric", "mean_metrics"]
