"""Text analysis: tokens, positions, keyword terms, query terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import TOKEN_PATTERN, normalise_query, token_array


def tokens(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           pattern: str = TOKEN_PATTERN) -> DataFrame:
    """One row per token: ``(id, pos, term)``; ``pos`` is 0-based."""
    return (df.select(F.col(id_col), F.posexplode(token_array(text_col, pattern)).alias("pos", "term"))
              .select(id_col, F.col("pos").cast("long").alias("pos"), "term"))


def token_positions(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, pos, term, start, end)``: 0-based position and character
    offsets (code points) of each token in the lower-cased text.

    The text between tokens comes from splitting on the same pattern, so
    tokens and gaps cannot disagree; a running sum per row gives the offsets.
    The texts are dealt by row before they are split, so the sum over a row's
    tokens moves nothing more.
    """
    low = df.select(F.col(id_col), F.lower(F.col(text_col)).alias("_low"), F.monotonically_increasing_id().alias("_row"))
    low = low.repartition("_row")
    parts = F.arrays_zip(F.regexp_extract_all("_low", F.lit(TOKEN_PATTERN), F.lit(0)).alias("term"),
                         F.split("_low", TOKEN_PATTERN, -1).alias("gap"))
    rows = low.select(id_col, "_row", F.posexplode(parts).alias("pos", "z")).where(F.col("z.term").isNotNull())
    w = Window.partitionBy("_row").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length("z.gap") + F.length("z.term")).over(w)
    rows = rows.select(id_col, F.col("pos").cast("long").alias("pos"), F.col("z.term").alias("term"), end.cast("long").alias("end"))
    return rows.select(id_col, "pos", "term", (F.col("end") - F.length("term")).alias("start"), "end")


def query_terms(queries: DataFrame, text_col: str = "text", id_col: str = "query_id") -> DataFrame:
    """Analysed query terms with multiplicity: ``(query_id, term, qtf)``.

    Queries are normalised (lower case, grouping characters deleted) and
    tokenised with the document rule. The aggregation is over the query
    table only, which is small.
    """
    toks = queries.select(F.col(id_col).alias("query_id"),
                          F.explode(token_array(normalise_query(F.col(text_col)))).alias("term"))
    return toks.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
