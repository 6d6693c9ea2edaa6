"""Collection statistics.

Data model (all long ids, one ``field`` column so several indexed fields share
one table):

* ``postings(field, doc_id, term, tf, dl)``: one row per distinct term of a
  document field; ``dl`` is the field length in tokens, carried on every row so
  scoring never joins a document-length table.
* ``term_stats(field, term, df, cf)``.
* ``field_stats(field, max_doc, doc_count, sum_doc_freq, sum_total_term_freq)``.

The functions here compute them from a frame of documents; a collection that
is asked more than once is stored as an index (``operators.index``), which
holds the same relations.

Postings are produced per document row (``term_counts``), so building them
reads the text once and shuffles nothing; only the per-term aggregates
shuffle, after map-side partial aggregation, which keeps a very frequent term
from landing whole on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import TOKEN_PATTERN, term_counts, token_array
from quire.operators.index import Index
from quire.session import bounded_broadcast


def postings(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             field: str | None = None, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``(field, doc_id, term, tf, dl)`` for a tokenised text column.

    A document without tokens contributes no row.
    """
    field = field or text_col
    per_doc = docs.select(F.col(id_col).alias("doc_id"), token_array(text_col, pattern).alias("_t"))
    counted = per_doc.select("doc_id", F.size("_t").cast("long").alias("dl"),
                             F.inline(term_counts("_t")))
    return counted.select(F.lit(field).alias("field"), "doc_id", "term", "tf", "dl")


def keyword_postings(docs: DataFrame, col: str, id_col: str = "doc_id") -> DataFrame:
    """Postings of a whole-value keyword field: the value is the single term,
    tf = dl = 1; null values index nothing."""
    return (docs.where(F.col(col).isNotNull())
                .select(F.lit(col).alias("field"), F.col(id_col).alias("doc_id"),
                        F.col(col).cast("string").alias("term"),
                        F.lit(1).cast("long").alias("tf"), F.lit(1).cast("long").alias("dl")))


def term_freq(postings_df: DataFrame) -> DataFrame:
    """tf of each term in each doc: ``(doc_id, term, tf)``."""
    return postings_df.select("doc_id", "term", "tf")


def term_stats(postings_df: DataFrame) -> DataFrame:
    """``(field, term, df, cf)``: documents containing the term and its
    total count."""
    return (postings_df.groupBy("field", "term")
                       .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")))


def doc_freq(postings_df: DataFrame) -> DataFrame:
    """``(field, term, df)``."""
    return postings_df.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def doc_count(docs: DataFrame) -> DataFrame:
    """One row ``(n_docs)``: live documents of the collection."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def with_idf(stats: DataFrame, n_docs: DataFrame | int) -> DataFrame:
    """Add ``idf = log10(N / df)`` where N counts every document of the
    collection: a number, or the one-row frame of ``doc_count``, which enters
    as a scalar subquery."""
    n = F.lit(float(n_docs)) if isinstance(n_docs, int) else n_docs.select(F.col("n_docs").cast("double")).scalar()
    return stats.withColumn("idf", F.log10(n / F.col("df")))


def tfxidf(postings_df: DataFrame, idf_df: DataFrame) -> DataFrame:
    """``(field, doc_id, term, tf, df, idf, tfxidf)``. The dictionary is
    broadcast if it passes the size check."""
    return (postings_df.join(bounded_broadcast(idf_df.select("field", "term", "df", "idf")), ["field", "term"])
                       .withColumn("tfxidf", F.col("tf") * F.col("idf"))
                       .select("field", "doc_id", "term", "tf", "df", "idf", "tfxidf"))


def field_stats(postings_df: DataFrame, docs: DataFrame) -> DataFrame:
    """Per field: ``max_doc`` (live docs of the collection), ``doc_count``
    (docs with at least one term in the field), ``sum_doc_freq`` (postings
    rows) and ``sum_total_term_freq`` (tokens).

    One pass over postings; the distinct doc count is de-duplicated map-side
    first, and a document's rows sit in one input partition, so the shuffle
    carries about one row per document.
    """
    per_field = (postings_df.groupBy("field")
                 .agg(F.count(F.lit(1)).alias("sum_doc_freq"),
                      F.sum("tf").alias("sum_total_term_freq"),
                      F.count_distinct("doc_id").alias("doc_count")))
    n = doc_count(docs).select("n_docs").scalar()
    return per_field.select("field", n.alias("max_doc"), "doc_count", "sum_doc_freq", "sum_total_term_freq")


def collection_lm(index: Index, field: str = "text") -> DataFrame:
    """Collection language model of a field: ``(field, term, cf, p)`` with
    ``p = cf / T``, T the field's token total (the JM background model)."""
    total = float(index.totals(field).sum_total_term_freq)
    return index.term_stats(field).select("field", "term", "cf", (F.col("cf") / F.lit(total)).alias("p"))
