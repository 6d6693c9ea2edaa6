"""Ranked retrieval: matching, tf-idf and Jelinek-Mercer scoring, top-k.

Everything reads the stored index (``operators.index``): the collection totals
are one small row, the statistics of the query terms come from the term table,
and postings are read as blocks of neighbouring documents. A frame of documents
may be given instead of an index; it is indexed first, below the shared
checkpoint folder.

* ``score`` sums every matching (query, doc). The query terms, with all that
  does not depend on the document folded in, are a size-checked broadcast. The
  blocks of the terms are dealt by span, as compact arrays, and the sums are
  finished, and if asked cut to the best, in the task that holds the span
  (``operators.spans``).
* ``best_hits`` finds the top k without scoring everything (block-max): the
  largest contribution of every term in every block bounds a block's best
  score. The blocks with the highest bounds are scored first and give, for
  every query, a k-th score; other blocks are read only if their bound can
  still reach it. When that leaves out too little, everything is scored.

Scores (survey contracts 2.9-b, 2.9-c), summed over matching query terms:

* tf-idf: qtf * sqrt(tf) * idf^p / sqrt(dl), idf = 1 + ln((N + 1) / (df + 1)),
  N = docs having the field; p = 1 (``idf_power``).
* JM: qtf * ln(1 + (1 - lambda) * (tf / dl) / (lambda * cf / T)), T = tokens
  of the field (``add_one`` uses (cf + 1) / (T + 1)).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.index import Index
from quire.operators.spans import rank_key, span_sums
from quire.session import bounded_broadcast, staging_path, written

# A bound is raised by this much before it is compared with a score.
BOUND_SLACK = 1e-8
# Blocks of a query that are scored before any is left out.
FIRST_BLOCKS = 8
# Blocks are chosen per query only if the bounds leave at most this share of
# the postings to be read after the first blocks; else all are scored.
MOST_OPEN = 0.5
# Default lambda grid of the smoothing sweep (0 excluded).
LAMBDAS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]


def indexed(source: Index | DataFrame, field: str = "text") -> Index:
    """``source`` itself, or an index of a frame of documents."""
    if isinstance(source, Index):
        return source
    return Index(source.sparkSession, staging_path(source.sparkSession, "index")).add(source, {field: F.col(field)}, positions=False)


def matches(index: Index, qterms: DataFrame, field: str = "text") -> DataFrame:
    """``(term, doc_id, tf, dl)``: the postings of the query terms."""
    terms = bounded_broadcast(qterms.select("term").distinct())
    hit = index.blocks(field).join(terms, "term", "left_semi")
    return hit.select("term", F.inline(F.arrays_zip("docs", "tfs", "dls"))).select(
        "term", F.col("docs").alias("doc_id"), F.col("tfs").alias("tf"), F.col("dls").alias("dl"))


def term_weights(index: Index, qterms: DataFrame, model: str, idf_power: int = 1, add_one: bool = False,
                 field: str = "text") -> DataFrame:
    """``(query_id, term, _w, _p)``: the factors that do not depend on the
    document. The collection totals enter as numbers."""
    tot = index.totals(field)
    qt = qterms.join(bounded_broadcast(index.stats_of(qterms, field)), "term")
    if model == "tfidf":
        idf = F.lit(1.0) + F.log(F.lit(float(tot.doc_count + 1)) / (F.col("df") + 1))
        return qt.select("query_id", "term", (F.col("qtf") * F.pow(idf, idf_power)).alias("_w"), F.lit(1.0).alias("_p"))
    if model != "jm":
        raise ValueError(f"unknown model {model!r}")
    one = 1 if add_one else 0
    p = (F.col("cf") + one).cast("double") / F.lit(float(tot.sum_total_term_freq + one))
    return qt.select("query_id", "term", F.col("qtf").cast("double").alias("_w"), p.alias("_p"))


def _smoothed(share: Column, lam: float) -> Column:
    return F.col("_w") * F.log(F.lit(1.0) + (F.lit(1.0 - lam) * share) / (F.lit(lam) * F.col("_p")))


def _contribution(model: str, lam: float) -> Column:
    """What one posting (tf, dl) adds to a score."""
    if model == "tfidf":
        return F.col("_w") * F.sqrt(F.col("tf").cast("double")) / F.sqrt(F.col("dl").cast("double"))
    return _smoothed(F.col("tf") / F.col("dl"), lam)


def _checked(lams) -> list[float]:
    lams = [float(lams)] if isinstance(lams, (int, float)) else [float(x) for x in lams]
    if not all(0.0 < x <= 1.0 for x in lams):
        raise ValueError("lambda must be in (0, 1]")
    return lams


def _parts(model: str, lams: Sequence[float]):
    """What a query's weight is multiplied by in the score of a posting, for
    every lambda (see ``_contribution``)."""
    def parts(tf, dl, p):
        if model == "tfidf":
            return [np.sqrt(tf) / np.sqrt(dl)]
        share = tf / dl
        return [np.log(1.0 + ((1.0 - x) * share) / (x * p)) for x in lams]
    return parts


def _summed(index: Index, weights: DataFrame, model: str, lams: Sequence[float], field: str, best: int | None = None) -> DataFrame:
    """``(run, query_id, doc_id, score)`` of every matching (query, doc) and
    lambda, or what can be among the ``best`` of them. The blocks move once,
    as the arrays they are stored in, and are summed in the task that holds
    the span (``operators.spans``)."""
    return span_sums(index.blocks(field), weights, _parts(model, lams), best)


def score(source: Index | DataFrame, qterms: DataFrame, model: str = "tfidf", lam: float | Sequence[float] = 0.5,
          idf_power: int = 1, add_one: bool = False, field: str = "text", best: int | None = None) -> DataFrame:
    """Score every matching (query, doc): ``(query_id, doc_id, score)``, plus
    ``lambda`` when ``model='jm'``.

    ``lam`` may be a list: a posting is read once for all lambdas. With
    ``best`` a task returns only rows that can be among the first ``best`` of
    their query (and lambda), which ``top_k`` then ranks.
    """
    lams = _checked(lam) if model == "jm" else [0.5]
    index = indexed(source, field)
    weights = written(term_weights(index, qterms, model, idf_power, add_one, field), "weights")
    rows = _summed(index, weights, model, lams, field, best)
    if model == "tfidf":
        return rows.drop("run")
    return rows.select(F.element_at(F.array(*[F.lit(x) for x in lams]), F.col("run") + 1).alias("lambda"), "query_id", "doc_id", "score")


def block_bounds(index: Index, weights: DataFrame, model: str, lam: float = 0.5, field: str = "text") -> DataFrame:
    """``(query_id, block, bound, postings)``: the highest score a document
    of the block can have, and the block's postings of the query's terms. Only
    the heads of the blocks are read. A tf-idf score is also at most the
    length of the vector of its weights, as the squares of sqrt(tf) / sqrt(dl)
    add up to 1 at most."""
    heads = index.blocks(field).select("term", "block", "n", "top", "share")
    most = F.col("_w") * F.col("top") if model == "tfidf" else _smoothed(F.col("share"), lam)
    met = heads.join(bounded_broadcast(weights), "term")
    bound = F.sum(most)
    if model == "tfidf":
        bound = F.least(bound, F.sqrt(F.sum(F.col("_w") * F.col("_w"))))
    return met.groupBy("query_id", "block").agg(bound.alias("bound"), F.sum("n").alias("postings"))


def _score_blocks(index: Index, weights: DataFrame, blocks: DataFrame, model: str, lam: float, field: str) -> DataFrame:
    """Scores of the documents of the given ``(query_id, block)``."""
    wanted = blocks.select("query_id", "block").join(bounded_broadcast(weights), "query_id")
    rows = index.blocks(field).join(bounded_broadcast(wanted), ["term", "block"])
    rows = rows.select("query_id", "_w", "_p", F.inline(F.arrays_zip("docs", "tfs", "dls"))).withColumnsRenamed({"docs": "doc_id", "tfs": "tf", "dls": "dl"})
    return rows.groupBy("query_id", "doc_id").agg(F.sum(_contribution(model, lam)).alias("score"))


def best_hits(source: Index | DataFrame, qterms: DataFrame, k: int, model: str = "tfidf", lam: float = 0.5,
              idf_power: int = 1, add_one: bool = False, field: str = "text",
              first: int = FIRST_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The hits of ``top_k`` over ``score``, and ``(query_id, postings,
    postings_read)``: how many postings of its terms a query has and how many
    were scored.

    Contributions are never negative, so a block whose bound (with
    ``BOUND_SLACK``, far above the rounding of a sum and of the ranking key)
    lies below the k-th score of the blocks scored first holds no hit; ties
    with the k-th score are read.
    """
    _checked(lam)
    index = indexed(source, field)
    weights = written(term_weights(index, qterms, model, idf_power, add_one, field), "weights")
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    bounds = block_bounds(index, weights, model, lam, field).withColumn("place", F.row_number().over(order))
    bounds = written(bounds, "bounds")
    best = written(top_k(_score_blocks(index, weights, bounds.where(F.col("place") <= first), model, lam, field), k), "first-hits")
    least = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest = bounds.where(F.col("place") > first).join(bounded_broadcast(least), "query_id", "left")
    rest = written(rest.where(F.col("least").isNull() | (F.col("bound") + BOUND_SLACK >= F.col("least"))), "open-blocks")
    every, left = bounds.agg(F.sum("postings")).first()[0] or 0, rest.agg(F.sum("postings")).first()[0] or 0   # two numbers
    if left > MOST_OPEN * every:   # a row per query, block and term would cost more than is left out
        rest = bounds.where(F.col("place") > first)
        hits = top_k(_summed(index, weights, model, [lam], field, k).drop("run"), k)
    else:
        more = _score_blocks(index, weights, rest, model, lam, field)
        hits = top_k(best.drop("rank").unionByName(more), k)
    read = F.when(F.col("place") <= first, F.col("postings")).otherwise(0)
    report = bounds.select("query_id", "postings", read.alias("r")).unionByName(rest.select("query_id", F.lit(0).cast("long").alias("postings"), F.col("postings").alias("r")))
    return hits, report.groupBy("query_id").agg(F.sum("postings").alias("postings"), F.sum("r").alias("postings_read"))


def match_any(source: Index | DataFrame, qterms: DataFrame, field: str = "text") -> DataFrame:
    """``(query_id, doc_id)``: documents containing at least one query term."""
    hit = matches(indexed(source, field), qterms, field)
    return hit.join(bounded_broadcast(qterms.select("query_id", "term")), "term").select("query_id", "doc_id").distinct()


def top_k(scored: DataFrame, k: int, group_cols: Sequence[str] = ("query_id",)) -> DataFrame:
    """Best ``k`` documents per query: adds ``rank`` (1-based) ordered by
    score descending (by ``rank_key``), then ``doc_id``. Spark
    cuts to k rows per task before the exchange."""
    w = Window.partitionBy(*group_cols).orderBy(rank_key(F.col("score")).desc(), F.col("doc_id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def total_hits(scored: DataFrame, group_cols: Sequence[str] = ("query_id",)) -> DataFrame:
    """Matching documents per query: ``(query_id, total_hits)``."""
    return scored.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("total_hits"))


def fetch_hits(hits: DataFrame, docs: DataFrame, cols: Sequence[str] = ("text",)) -> DataFrame:
    """Attach stored fields to ranked hits (equi-join on ``doc_id``). The hit
    list, at most k rows per query, is written once; it is the broadcast side
    when its size check passes."""
    return docs.select("doc_id", *cols).join(bounded_broadcast(written(hits, "hits")), "doc_id")
