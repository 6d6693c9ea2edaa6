"""Evaluation of ranked runs against relevance judgements.

* P@k = relevant hits in the first k / min(k, total hits)
* Recall@k = relevant hits in the first k / relevant docs of the query
* AP@k = sum over relevant hits i <= k of (relevant so far / i), divided by
  the relevant docs of the query (not by min(k, relevant)).

Queries without judgements are not evaluated (``skip_unjudged``); a judged
query without hits scores 0 on all three and stays in the means. All work
after the top-k cut is on at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.retrieval import top_k
from quire.session import bounded_broadcast


def judge(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Mark each hit: adds ``relevant`` (boolean) by a left join on
    ``(query_id, doc_id)``."""
    marks = qrels.select("query_id", "doc_id").distinct().withColumn("relevant", F.lit(True))
    return (run.join(bounded_broadcast(marks), ["query_id", "doc_id"], "left")
               .withColumn("relevant", F.coalesce(F.col("relevant"), F.lit(False))))


def judged_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """``(query_id, n_rel)`` for the queries that have judgements
    (``skip_unjudged``)."""
    counts = (qrels.select("query_id", "doc_id").distinct()
                   .groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel")))
    return queries.select("query_id").distinct().join(counts, "query_id")


def per_query_counts(hits: DataFrame, qrels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, n_hits, vp, ap_sum)`` from the ranked hits (``rank``
    1-based): the hits, the relevant ones and the sum of precision at each
    relevant rank, by a running sum over the (at most k) hits of each query."""
    j = judge(hits, qrels).withColumn("_rel", F.col("relevant").cast("long"))
    w = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("_so_far", F.sum("_rel").over(w))
    return j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_hits"), F.sum("_rel").alias("vp"),
        F.sum(F.when(F.col("relevant"), F.col("_so_far") / F.col("rank")).otherwise(F.lit(0.0))).alias("ap_sum"))


def metrics(queries: DataFrame, scored: DataFrame, qrels: DataFrame, k: int,
            runs: Mapping[str, Sequence] | None = None) -> DataFrame:
    """``(*run_cols, query_id, p, recall, ap)`` at cut ``k``.

    ``scored`` is ``(*run_cols, query_id, doc_id, score)``; a ``rank`` says
    that it is already cut to the first ``k``. min(k, total hits) is the number
    of hits that the cut leaves, so nothing but the cut is needed. ``runs``
    names the run columns and their values (e.g. ``{"lambda": [0.1, ...,
    1.0]}``) so one call evaluates a whole sweep; every evaluated query gets a
    row per run value, also when it has no hits in that run.
    """
    runs = dict(runs or {})
    g = list(runs)
    keys = g + ["query_id"]
    hits = scored if "rank" in scored.columns else top_k(scored, k, keys)
    counts = per_query_counts(hits, qrels, keys)
    base = judged_queries(queries, qrels)
    for col, values in runs.items():
        base = base.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))
    return (base.join(counts, keys, "left")
                .select(*keys,
                        F.coalesce(F.try_divide(F.col("vp").cast("double"), F.col("n_hits").cast("double")),
                                   F.lit(0.0)).alias("p"),
                        F.coalesce(F.try_divide(F.col("vp").cast("double"), F.col("n_rel").cast("double")),
                                   F.lit(0.0)).alias("recall"),
                        F.coalesce(F.try_divide(F.col("ap_sum"), F.col("n_rel").cast("double")),
                                   F.lit(0.0)).alias("ap")))


def mean_metrics(m: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean P, mean Recall and MAP over the evaluated queries; no queries
    gives 0.0."""
    return m.groupBy(*group_cols).agg(
        F.coalesce(F.avg("p"), F.lit(0.0)).alias("mean_p"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("mean_recall"),
        F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map"))
