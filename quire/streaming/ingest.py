"""Incremental collection building with Structured Streaming.

The batch indexer's append mode with update-by-path, as a stream: new files
under a folder are read as whole-text documents, and every micro-batch writes
its documents and postings into its own ``epoch=<batch id>`` partition with
dynamic partition overwrite, so a retried batch replaces exactly its own
output (exactly-once with the stream checkpoint). The file source reads a path
once: a file that is written again under its old path is not read again, so a
new version of a document has to come under a new path. Should one path occur
in several epochs (after the stream's checkpoint was replaced), readers keep
the row of the latest (``read_docs`` / ``read_postings``); nothing already
written is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import normalise_lines
from quire.operators.stats import postings


def _batch_writer(target: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        docs = (batch.select(F.col("path"), normalise_lines(F.col("value")).alias("text"))
                     .withColumn("epoch", F.lit(epoch_id).cast("long")))
        (docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch").parquet(f"{target}/docs"))
        post = postings(docs.withColumnRenamed("path", "doc_key"), id_col="doc_key")
        (post.withColumnRenamed("doc_id", "path").withColumn("epoch", F.lit(epoch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch").parquet(f"{target}/postings"))
    return write


def start_ingest(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream the files under ``source_dir`` into the collection at
    ``target`` (``docs`` and ``postings`` tables). ``checkpoint`` must be a
    folder shared by the cluster."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.text(source_dir, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    w = stream.writeStream.foreachBatch(_batch_writer(target)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def _latest(df: DataFrame, key: str) -> DataFrame:
    """Rows of the latest epoch per key (one max per key, then a join)."""
    last = df.groupBy(key).agg(F.max("epoch").alias("epoch"))
    return df.join(last, [key, "epoch"])


def read_docs(spark: SparkSession, target: str) -> DataFrame:
    """``(path, text)``: the current version of every ingested document."""
    return _latest(spark.read.parquet(f"{target}/docs"), "path").select("path", "text")


def read_postings(spark: SparkSession, target: str) -> DataFrame:
    """``(field, path, term, tf, dl)`` of the current document versions."""
    p = spark.read.parquet(f"{target}/postings")
    cur = _latest(spark.read.parquet(f"{target}/docs").select("path", "epoch"), "path")
    return p.join(cur, ["path", "epoch"], "left_semi").select("field", "path", "term", "tf", "dl")


__all__ = ["start_ingest", "read_docs", "read_postings"]
