"""Most telling terms of a document or of the collection.

idf here is ``log10(N / df)`` with N all documents of the collection.
Orders (descending; ties by term ascending): ``tf`` (default), ``df``,
``idf``, ``tfxidf`` for a document; ``df`` (default) or ``idf`` for the
collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.index import Index
from quire.operators.stats import with_idf
from quire.session import bounded_broadcast

DOC_ORDERS = ("tf", "df", "idf", "tfxidf")
COLL_ORDERS = ("df", "idf")


def _doc_terms(index: Index, doc_id: int | None, field: str) -> DataFrame:
    """``(doc_id, term, tf, df, idf, tfxidf)`` for one document (one block is
    read, and the statistics of its terms) or for every document."""
    n = int(index.totals(field).max_doc)
    if doc_id is None:
        target, stats = index.postings(field), index.term_stats(field)
    else:
        target = index.document(doc_id, field)
        stats = index.stats_of(target, field)
    idf = bounded_broadcast(with_idf(stats, n).select("term", "df", "idf"))
    return (target.join(idf, "term")
                  .select("doc_id", "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfxidf")))


# Real-valued keys are compared at this precision so ties do not depend on
# the last bits of a logarithm.
KEY_DECIMALS = 9


def _key(order: str):
    return F.round(F.col(order), KEY_DECIMALS) if order in ("idf", "tfxidf") else F.col(order)


def _order(order: str):
    if order not in DOC_ORDERS:
        raise ValueError(f"order must be one of {DOC_ORDERS}")
    return [_key(order).desc(), F.col("term").asc()]


def best_terms(index: Index, doc_id: int | None, n: int = 10, order: str = "tf", field: str = "text") -> DataFrame:
    """Top ``n`` terms of document ``doc_id`` (or of every document when
    ``doc_id`` is None): ``(doc_id, rank, term, tf, df, idf, tfxidf)``.

    The batch form joins the stored postings with the dictionary (a broadcast
    if it passes the size check) and keeps ``row_number <= n`` per document,
    which Spark cuts per task before the shuffle.
    """
    t = _doc_terms(index, doc_id, field)
    w = Window.partitionBy("doc_id").orderBy(*_order(order))
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def best_terms_coll(index: Index, n: int = 10, order: str = "df", field: str = "text") -> DataFrame:
    """Top ``n`` terms of the collection by df (most common) or idf (rarest):
    ``(rank, term, df, idf)``; a global top-n of the stored dictionary (Spark
    keeps n rows per task before the final merge)."""
    if order not in COLL_ORDERS:
        raise ValueError(f"order must be one of {COLL_ORDERS}")
    stats = with_idf(index.term_stats(field), int(index.totals(field).max_doc))
    top = stats.orderBy(_key(order).desc(), F.col("term").asc()).limit(n)
    w = Window.orderBy(_key(order).desc(), F.col("term").asc())
    # n rows: ranking them in one partition is bounded by n
    return top.withColumn("rank", F.row_number().over(w)).select("rank", "term", "df", "idf")
