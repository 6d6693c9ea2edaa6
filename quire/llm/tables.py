"""Reading and staging tables for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir, staging_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, as the file source splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2.
    A null id is held out of training as well (its remainder is null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
