"""Corpus pipeline: the stages that turn raw documents into training tokens.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
below the shared checkpoint folder and read back as the next stage's input.
All but the last return the columns of ``documents``.

Rows without an id and null, empty or very long texts pass through every
stage as the stage's operator defines for them; an empty table gives an empty
result; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, quality, setsketch, suffixes
from quire.llm.tables import read, stage
from quire.llm.windows import Spec

PASSAGE = Spec("words", 50, 25)   # repeated passages that the suffix stage cuts, besides repeated 400-byte strings


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be good: scores
    from the threshold on. The machine learns from ``labels``."""
    machine = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.scores(docs.select(*docs.columns), machine, docs.columns)
    # a column of the documents may be called score: the model's is the last one
    scored = scored.toDF(*docs.columns, "__quire_score")
    return scored.where(F.col("__quire_score") >= quality.THRESHOLD).drop("__quire_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return setsketch.one_row_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated 400-byte strings and without passages of 50 words
    that also start anywhere else; ``n_chars`` (if there) is the new length
    where a text was cut. Null texts stay null."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = suffixes.dedup(docs.withColumn("__quire_null", F.col("text").isNull()), carry=[*rest, "__quire_null"], as_text=True, also=[PASSAGE])
    out = out.toDF("doc_id", "__quire_bytes", "__quire_removed", "__quire_spans", "text", *rest, "__quire_null")
    out = out.withColumn("text", F.when(~F.col("__quire_null"), F.col("text")))
    if "n_chars" in rest:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__quire_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ``benchmark`` item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the token ids of every text and the
    text that they decode to."""
    both = bpe.encode(docs, keep=["doc_id"], decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

# The classifier, the sketches' candidates and the tokenizer are not SQL:
# tests compare the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
