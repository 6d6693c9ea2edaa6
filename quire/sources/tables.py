"""Loading the driver tables and binding them to the retrieval data model.

Binding (see README): the collection is ``documents(doc_id, text)``; the
queries are ``benchmark(item_id -> query_id, text)``; judgements are derived
by ``quire.plans.binding.shingle_qrels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over the cluster's cores when the scan has fewer
    partitions than cores (a small table in one row group would otherwise be
    one task). A larger table is split by the file source and not moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (``{sf_dir}/{name}.parquet``)."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document collection ``(doc_id, text, lang, source, n_chars)``."""
    return load(spark, sf_dir, "documents")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set ``(query_id, text)``."""
    return load(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_id")
