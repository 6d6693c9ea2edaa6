"""Writing and maintaining a document collection stored as Parquet.

A collection without a key is a plain Parquet folder: it can be replaced and
added to. A collection with a key is a ``BucketStore`` of one table, whose
rows can also be replaced by key: only the buckets that hold the keys are
written anew, and a write that fails leaves the collection as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sinks.buckets import BUCKET, BUCKETS, BucketStore, path_exists, upsert

OPEN_MODES = ("create", "append", "create_or_append")
TABLE = "docs"   # the table of a keyed collection


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a collection, with or without a key, is stored at ``path``."""
    return BucketStore(spark, path).exists() or path_exists(spark, path)


def save(df: DataFrame, path: str, openmode: str = "create", key: str | None = None,
         update: bool = False, partition_by: Sequence[str] = (), order: str | None = None, buckets: int = BUCKETS) -> None:
    """Write a collection.

    ``create`` replaces; ``append`` needs an existing collection;
    ``create_or_append`` does either. ``key`` names the column that deals the
    rows of a new collection to buckets. With ``update`` (append modes, keyed
    collections) the rows of ``df`` replace stored rows with the same key (see
    ``upsert``; ``order`` is its column); otherwise rows are appended and
    duplicates are allowed.
    """
    if openmode not in OPEN_MODES:
        raise ValueError(f"openmode must be one of {OPEN_MODES}")
    spark = df.sparkSession
    store = BucketStore(spark, path)
    present = store.exists() or path_exists(spark, path)
    if openmode == "append" and not present:
        raise FileNotFoundError(f"no collection at {path} to append to")
    if store.exists() or (key and not present):
        if key and store.exists() and openmode != "create" and store.tables[TABLE].key != key:
            raise ValueError(f"the collection's key is {store.tables[TABLE].key}")
        if update and store.exists() and openmode != "create":
            store.upsert(TABLE, df, order)
        else:
            store.append({TABLE: (df, key or store.tables[TABLE].key)}, buckets, replace=openmode == "create")
        return
    if update and present and openmode != "create":
        raise ValueError("rows are replaced by key: create the collection with its key")
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.mode("overwrite" if openmode == "create" or not present else "append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a collection."""
    store = BucketStore(spark, path)
    return store.read(TABLE).drop(BUCKET) if store.exists() else spark.read.parquet(path)


def partition_by_top_folder(df: DataFrame, rel_path_col: str = "rel_path") -> DataFrame:
    """Add ``part``: the first folder of the relative path (``''`` for root
    files, which belong to the main collection)."""
    c = F.col(rel_path_col)
    return df.withColumn("part", F.when(F.instr(c, "/") > 0, F.substring_index(c, "/", 1)).otherwise(F.lit("")))


def merge(parts: Sequence[DataFrame]) -> DataFrame:
    """Merge partial collections (union by column name)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dump_fields(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """Every stored field of every document as ``(doc_id, field, value)``
    (values as strings; null values are left out)."""
    cast = docs.select(id_col, *[F.col(f).cast("string").alias(f) for f in fields])
    return (cast.unpivot([id_col], list(fields), "field", "value")
                .where(F.col("value").isNotNull()))


__all__ = ["exists", "save", "load", "upsert", "partition_by_top_folder", "merge", "dump_fields"]
