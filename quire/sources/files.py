"""Reading a folder tree as a document collection.

One row per file: ``(path, rel_path, depth, extension, length, modified,
contents)``. On a mounted file system the tasks list the folders and read the
files: a list of a large tree is a table and never on the driver. Elsewhere it
is Spark's ``binaryFile``, which lists on the driver. Extension lists become part of the path pattern, or a
``pathGlobFilter``, when they can, and a depth with such a list becomes one
pattern for every level, so that deeper folders are not listed. A range of
modification times is the file source's own. Files left out by any of these
are never opened.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from urllib.parse import urlparse
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import normalise_lines, path_extension
from quire.session import written

# text forms of a modification time: ISO with milliseconds, and digits that sort
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
MILLIS_FORMAT = "yyyyMMddHHmmssSSS"
# Depths beyond this are filtered after the listing.
MAX_LEVELS = 32
FOLDERS_OF_TASK = 10_000   # folders that a task lists beside those it was given, about
FILES_OF_TASK = 20_000     # files that a task reads, about


def _root_path(root: str) -> str:
    u = urlparse(root)
    p = u.path if u.scheme else root
    return p.rstrip("/")


def _glob_for(exts: Sequence[str]) -> str | None:
    """A file-name glob selecting exactly ``exts`` (each with its dot), or
    None when one of them cannot be written as a glob (``''`` = no dot)."""
    if not exts or any(e == "" or not e.startswith(".") or re.search(r"[{}*?\[\],]", e) for e in exts):
        return None
    inner = ",".join(e for e in exts)
    return f"*{{{inner}}}" if len(exts) > 1 else f"*{exts[0]}"


def _levels(root: str, depth: int, glob: str) -> str:
    """A pattern of the files up to ``depth`` folders below the root."""
    if depth > MAX_LEVELS:
        return root
    at = re.sub(r"([{}*?\[\],\\])", r"\\\1", root.rstrip("/"))
    ends = [("*/" * d) + glob for d in range(depth + 1)]
    return f"{at}/{{{','.join(ends)}}}" if depth else f"{at}/{glob}"


def last_modified(spark: SparkSession, root: str) -> datetime | None:
    """The whole second after the latest change of a file below ``root``;
    None without files. No file is opened."""
    if (at := _mounted(spark, root)) is not None:
        df = _listed(spark, at)
    else:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    last = df.agg(F.max(F.unix_millis("modificationTime"))).first()[0]
    return None if last is None else datetime.fromtimestamp(last // 1000 + 1, timezone.utc)


def _mounted(spark: SparkSession, root: str) -> str | None:
    """The folder of ``root`` if it is on a mounted file system, which tasks
    reach as well; None for other stores and for patterns."""
    u = urlparse(root)
    if u.scheme not in ("", "file") or re.search(r"[{}*?\[\]\\,%#;]", root) or not os.path.isabs(u.path) or not os.path.isdir(u.path):
        return None
    if not u.scheme and not (spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:").startswith("file:"):
        return None
    return u.path.rstrip("/") or "/"


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's file sources leave out a name."""
    if folder and name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


LISTED = pa.schema([("folder", pa.string()), ("level", pa.int32()), ("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64())])


def _list_folders(budget: int):
    """Lists a task's folders ``(folder, level)``, and those found there until
    ``budget`` were listed: a row for each file, and one for each folder that
    is left. What is held does not grow with a folder's entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, found = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), LISTED)], schema=LISTED)

        for batch in batches:
            for given in zip(batch["folder"].to_pylist(), batch["level"].to_pylist()):
                left = [given]
                while left:
                    folder, level = left.pop()
                    try:
                        entries = os.scandir(folder)
                    except FileNotFoundError:   # gone meanwhile
                        continue
                    with entries:
                        for e in entries:
                            try:
                                if _hidden(e.name, e.is_dir()):
                                    continue
                                if not e.is_dir():
                                    s = e.stat()
                                    rows.append((None, level, "file:" + e.path, s.st_mtime_ns // 1_000_000, s.st_size))
                                elif found < budget:
                                    found += 1
                                    left.append((e.path, level + 1))
                                else:
                                    rows.append((e.path, level + 1, None, None, None))
                            except FileNotFoundError:   # gone meanwhile, or a link to nothing
                                continue
                            if len(rows) >= 10_000:
                                yield out()
                                rows = []
        if rows:
            yield out()
    return run


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modificationTime, length)`` of the files below a mounted folder,
    as Spark's ``binaryFile`` lists them: no hidden or empty ones. Each round
    deals the folders that the one before left to new tasks."""
    cores = spark.sparkContext.defaultParallelism
    left, n, files = spark.createDataFrame([(root, 0)], "folder string, level int"), 1, None
    while n:
        dealt = left.repartition(max(min(n, cores), -(-n // FOLDERS_OF_TASK)))
        got = written(dealt.mapInArrow(_list_folders(FOLDERS_OF_TASK), "folder string, level int, path string, modified long, length long"), "listed")
        here = got.where(F.col("path").isNotNull() & (F.col("length") > 0)).select("path", F.timestamp_millis("modified").alias("modificationTime"), "length")
        files = here if files is None else files.unionByName(here)
        left = got.where(F.col("folder").isNotNull()).select("folder", "level")
        n = left.count()
    return files


def _read_file(path: str | None) -> bytes | None:
    if path is None:
        return None
    with open(path.removeprefix("file:"), "rb") as f:
        return f.read()


def _mounted_files(spark: SparkSession, root: str, exts: Sequence[str] | None, after: datetime | None, before: datetime | None) -> DataFrame:
    """``(path, modificationTime, length, content)``: a file is read when its
    content is asked for."""
    files = _listed(spark, root)
    second = lambda moment: F.timestamp_seconds(F.lit(math.floor(moment.timestamp())))
    if exts is not None:
        files = files.where(F.exists(F.array(*[F.lit(e) for e in exts]), lambda e: F.endswith("path", e)))
    if after is not None:
        files = files.where(F.col("modificationTime") > second(after))
    if before is not None:
        files = files.where(F.col("modificationTime") < second(before))
    n = files.count()
    files = files.repartition(max(spark.sparkContext.defaultParallelism, -(-n // FILES_OF_TASK)))
    # by rows, not by Arrow batches: few files are held at once
    return files.withColumn("content", F.udf(_read_file, "binary", useArrow=False)("path"))


def _spark_files(spark: SparkSession, root: str, glob: str | None, depth: int | None, after: datetime | None, before: datetime | None) -> DataFrame:
    """The same from any store, listed by Spark's file source."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for name, moment in (("modifiedAfter", after), ("modifiedBefore", before)):
        if moment is not None:
            reader = reader.option(name, moment.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%dT%H:%M:%S"))
    everything = reader
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(_levels(root, depth, glob) if glob and depth is not None else root)
    except AnalysisException as e:   # no file at these levels, or no root
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = everything.load(root).limit(0)
    return df


def scan_tree(spark: SparkSession, root: str, depth: int | None = None, exts: Sequence[str] | None = None,
              modified_after: datetime | None = None, modified_before: datetime | None = None) -> DataFrame:
    """Every file below ``root`` as one UTF-8 document.

    ``depth``: a file k folders below the root is kept iff k <= depth (root
    files always; 0 = root files only). ``exts``: keep files whose extension
    (from the last dot of the name, with the dot; ``''`` without a dot) is
    listed. ``modified_after`` and ``modified_before`` (whole seconds, both
    exclusive) bound the modification time. ``contents`` has CR/LF unified and
    one final line end dropped. A root that does not exist is an error; one
    without fitting files gives no rows.
    """
    glob = _glob_for(exts) if exts is not None else None
    at = None if glob and depth is not None else _mounted(spark, root)
    if at is not None:
        df = _mounted_files(spark, at, exts if glob else None, modified_after, modified_before)
    else:
        df = _spark_files(spark, root, glob, depth, modified_after, modified_before)
    rp = re.escape(_root_path(root))
    rel = F.regexp_extract(F.col("path"), rf"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?{rp}/(.*)$", 1)
    out = df.select(
        "path", rel.alias("rel_path"), "length", F.col("modificationTime").alias("modified"), "content")
    out = out.withColumn("depth", (F.size(F.split("rel_path", "/")) - 1).cast("int")) \
             .withColumn("extension", path_extension(F.col("rel_path")))
    if depth is not None:
        out = out.where(F.col("depth") <= depth)
    if exts is not None and not glob:
        out = out.where(F.col("extension").isin(list(exts)))
    return out.select("path", "rel_path", "depth", "extension", "length", "modified",
                      normalise_lines(F.decode(F.col("content"), "UTF-8")).alias("contents"))


def with_file_attrs(df: DataFrame) -> DataFrame:
    """File attributes as fields: ``size_kb`` (bytes / 1000.0), the
    modification time as epoch milliseconds, ISO text and sortable
    millisecond text (UTC), and ``type``. Expects the session time zone to be
    UTC for the two text forms."""
    return df.select(
        "*",
        (F.col("length") / F.lit(1000.0)).alias("size_kb"),
        F.unix_millis(F.col("modified")).alias("modified_ms"),
        F.date_format(F.col("modified"), ISO_FORMAT).alias("modified_iso"),
        F.date_format(F.col("modified"), MILLIS_FORMAT).alias("modified_sortable"),
        F.lit("regular").alias("type"))
