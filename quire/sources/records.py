"""Readers for record files, judgement files and metric result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import normalise_lines

# Record markers of the test-collection format: a line starting with ".I"
# opens a record (its second space-separated field is the id), a line
# starting with ".W" starts (and resets) the text.
RECORD_START = ".I"
TEXT_START = ".W"
_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def read_records(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, text)`` from ``.I id`` / ``.W`` record files.

    The files are split on the record marker by the text source itself
    (``lineSep``), so a record never straddles two tasks and large files stay
    splittable. The text is the lines after the last ``.W`` line (or after
    the ``.I`` line when there is none), joined with ``\\n`` and trimmed.
    """
    raw = spark.read.option("lineSep", "\n" + RECORD_START).text(path)
    body = normalise_lines(F.col("value"))
    body = F.when(body.startswith(RECORD_START), F.substring(body, len(RECORD_START) + 1, 1 << 30)).otherwise(body)
    lines = F.split(body, "\n", -1)
    w_at = F.coalesce(F.array_max(F.transform(
        lines, lambda ln, i: F.when(ln.startswith(TEXT_START), i + 1).otherwise(F.lit(0)))), F.lit(0))
    first_text = F.when(w_at > 0, w_at + 1).otherwise(F.lit(2))
    text_lines = F.slice(lines, first_text, F.greatest(F.size(lines) - first_text + 1, F.lit(0)))
    text = F.regexp_replace(F.array_join(text_lines, "\n"), _TRIM, "")
    rid = F.regexp_extract(F.element_at(lines, 1), r"^ +([^ ]+)", 1)
    return (raw.select(F.trim(rid).alias("_id"), text.alias("text"))
               .where(F.col("_id") != "")
               .select(F.col("_id").cast("long").alias(id_col), "text"))


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, doc_id)`` from ``query 0 doc grade`` lines.

    A line is split on single spaces (trailing empty fields dropped); it
    must have exactly four fields and long ids in fields 1 and 3, otherwise it
    is skipped. The grade is ignored.
    """
    raw = spark.read.text(path)
    fields = F.split(F.regexp_replace(F.col("value"), " +$", ""), " ", -1)
    return (raw.select(fields.alias("_f"))
               .where(F.size("_f") == 4)
               .select(F.element_at("_f", 1).try_cast("long").alias("query_id"),
                       F.element_at("_f", 3).try_cast("long").alias("doc_id"))
               .where(F.col("query_id").isNotNull() & F.col("doc_id").isNotNull()))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(query, value, test_range, metric)`` from metric CSV files.

    The header line is skipped, the second column is the value and the
    ``mean`` row is dropped. The test range and the metric come from the file
    name split on ``.`` (parts 6 and 7).
    """
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    cols = raw.columns
    # a result written by Spark is a folder of part files: the folder carries the name
    fpath = F.col("_metadata.file_path")
    parent = F.regexp_extract(fpath, r"([^/]+)/part-[^/]*$", 1)
    name = F.when(parent != "", parent).otherwise(F.regexp_extract(fpath, r"([^/]*)$", 1))
    parts = F.split(name, r"\.")
    return (raw.select(F.col(cols[0]).alias("query"), F.col(cols[1]).cast("double").alias("value"),
                       F.element_at(parts, 6).alias("test_range"), F.element_at(parts, 7).alias("metric"))
               .where(F.col("query") != "mean"))
