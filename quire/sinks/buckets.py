"""Versioned Parquet tables whose rows are dealt to hash buckets.

A store is a folder of tables. The rows of a table lie in
``data/<table>/_bucket=<bucket>/_version=<version>``; ``live/n=<version>`` names, for every
table and bucket, the versions that count. A write adds files of a new version
and switches last, by writing ``live`` for it: a write that fails before leaves
the store as it was, and a reader that has begun keeps its files. An append
adds to the buckets, an upsert rewrites the buckets its keys fall into and no
others. Two writers of one version cannot both switch: the second fails.
``vacuum`` removes the files of versions that no bucket names any more.
"""

from __future__ import annotations

import json
import secrets
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

BUCKETS = 32
BUCKET, VERSION = "_bucket", "_version"   # columns that tables cannot have
_LIVE = "tab string, key string, buckets int, layout string, live map<int,array<bigint>>"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds Parquet data; other errors are raised."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def upsert(base: DataFrame, delta: DataFrame, key: str | Sequence[str], order: str | None = None) -> DataFrame:
    """Rows of ``delta`` replace rows of ``base`` with the same key; other
    base rows stay (anti join + union, one shuffle on the key). Of several
    delta rows with one key the last by the column ``order`` replaces; without
    ``order`` such a delta is refused."""
    keys = [key] if isinstance(key, str) else list(key)
    if order is not None:
        last = Window.partitionBy(*keys).orderBy(F.desc(order))
        delta = delta.withColumn("_turn", F.row_number().over(last)).where("_turn = 1").drop("_turn")
    elif not delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").isEmpty():
        raise ValueError("a key occurs twice in the delta: name the column that orders its rows")
    return base.join(delta.select(*keys), keys, "left_anti").unionByName(delta)


class BucketStore:
    """Tables below ``path``; see the module."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._refresh()

    def _refresh(self) -> None:
        self.version, self.tables, self._frames = 0, {}, {}
        if not path_exists(self.spark, f"{self.path}/live"):
            return
        live = self.spark.read.schema(_LIVE + ", n int").parquet(f"{self.path}/live")
        last = live.agg(F.max("n")).first()[0]
        if last is not None:
            self.version = last
            self.tables = {r.tab: r for r in live.where(F.col("n") == last).collect()}   # one row a table

    def exists(self) -> bool:
        return bool(self.tables)

    def read(self, table: str) -> DataFrame:
        """The live rows of a table, with the column ``BUCKET``. A filter on it
        prunes folders."""
        if table not in self._frames:
            t = self.tables[table]
            layout = StructType.fromJson(json.loads(t.layout))
            rows = self.spark.read.schema(with_place(layout)).parquet(f"{self.path}/data/{table}")
            live = F.create_map(*[x for b, vs in sorted(t.live.items()) for x in (F.lit(b), F.array(*[F.lit(v).cast("long") for v in vs]))])
            self._frames[table] = rows.where(F.array_contains(F.element_at(live, F.col(BUCKET)), F.col(VERSION))).drop(VERSION)
        return self._frames[table]

    def bucket(self, table: str, value) -> F.Column:
        """The bucket that holds the rows with a key value."""
        return bucket_of(value, self.tables[table].buckets)

    def begin(self) -> int:
        """A version for the files of the next write: the number that it will
        switch to and, so that two writers never share a folder, a random one."""
        return (self.version + 1 << 30) + secrets.randbelow(1 << 30)

    def _write(self, table: str, rows: DataFrame, key: str, buckets: int, version: int, order: Sequence[str], dealt: bool) -> None:
        rows = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets)).withColumn(VERSION, F.lit(version).cast("long"))
        if not dealt:   # adaptive execution splits a bucket that holds too much
            rows = rows.hint("rebalance", BUCKET)
        rows.sortWithinPartitions(BUCKET, VERSION, *order).write.mode("append").partitionBy(BUCKET, VERSION).parquet(f"{self.path}/data/{table}")

    def _switch(self, tables: Mapping) -> None:
        rows = [(t, x["key"], x["buckets"], x["layout"], x["live"]) for t, x in tables.items()]
        self.spark.createDataFrame(rows, _LIVE).coalesce(1).write.mode("error").parquet(f"{self.path}/live/n={self.version + 1}")
        self._refresh()

    def _known(self) -> dict:
        return {t: {"key": r.key, "buckets": r.buckets, "layout": r.layout, "live": {b: list(v) for b, v in r.live.items()}}
                for t, r in self.tables.items()}

    def append(self, rows: Mapping[str, tuple[DataFrame, str]], buckets: int = BUCKETS, order: Mapping[str, Sequence[str]] | None = None,
               written: Mapping[str, tuple[StructType, str]] | None = None, replace: bool = False, version: int | None = None) -> None:
        """Add rows to tables, given as ``{table: (rows, key column)}``; a new
        table gets ``buckets`` buckets. ``order`` sorts the rows of a file.
        ``written`` names tables whose rows of ``version`` are in place, as
        ``{table: (schema, key column)}``. With ``replace`` the rows before no
        longer count."""
        version, known = version or self.begin(), self._known()
        for table, (schema, key) in (written or {}).items():
            old = known.get(table) or {"key": key, "buckets": buckets, "layout": schema.json(), "live": {}}
            known[table] = old | {"live": {b: [*old["live"].get(b, []), version] for b in range(old["buckets"])}}
        for table, (df, key) in rows.items():
            old = known.get(table)
            n = old["buckets"] if old else buckets
            layout = old["layout"] if old else df.schema.json()
            if old and not replace:
                key = old["key"]
                df = df.select(*[f.name for f in StructType.fromJson(json.loads(layout))])
            else:
                layout = df.schema.json()
            self._write(table, df, key, n, version, (order or {}).get(table, ()), False)
            before = old["live"] if old and not replace else {}
            known[table] = {"key": key, "buckets": n, "layout": layout, "live": {b: [*before.get(b, []), version] for b in range(n)}}
        self._switch(known)

    def upsert(self, table: str, delta: DataFrame, order: str | None = None) -> list[int]:
        """Rows of ``delta`` replace the rows with the same key (see the
        function ``upsert``); the buckets of its keys are written anew and
        listed. An empty delta changes nothing."""
        t = self.tables[table]
        delta = delta.select(*[f.name for f in StructType.fromJson(json.loads(t.layout))])
        touched = sorted(r.b for r in delta.select(bucket_of(F.col(t.key), t.buckets).alias("b")).distinct().collect())   # at most the buckets
        if not touched:
            return touched
        base = self.read(table).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        version, known = self.begin(), self._known()
        self._write(table, upsert(base, delta, t.key, order), t.key, t.buckets, version, (), False)
        known[table]["live"] |= {b: [version] for b in touched}
        self._switch(known)
        return touched

    def vacuum(self) -> int:
        """Remove the folders that the latest version does not name."""
        conf = self.spark._jsc.hadoopConfiguration()
        gone = 0
        for table, t in self.tables.items():
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{table}/{BUCKET}=*/{VERSION}=*")
            fs = path.getFileSystem(conf)
            for s in fs.globStatus(path) or []:
                b, v = (int(x.split("=")[1]) for x in s.getPath().toString().split("/")[-2:])
                if v >> 30 <= self.version and v not in t.live.get(b, []):
                    gone += bool(fs.delete(s.getPath(), True))
        self._refresh()
        return gone


def bucket_of(value, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def with_place(layout: StructType) -> StructType:
    """A table's columns with the bucket and version of its folders."""
    return StructType([*layout.fields, StructField(BUCKET, IntegerType()), StructField(VERSION, LongType())])
