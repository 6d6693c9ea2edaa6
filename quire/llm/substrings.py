"""Substring deduplication by Rabin-Karp hashes of word windows.

Every window of ``WINDOW`` consecutive words has a rolling hash. Windows are
counted in Spark by content, after equal contexts have been combined (see
``windows``). A window whose words also start in a document with a smaller id
is removed there; overlapping windows merge into maximal removal intervals.
Windows are judged on the input, so the result does not depend on an order of
removal. Contents are compared by two independent 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import read
from quire.llm.windows import Spec, class_table, counted, covered, hashed, removal, repeated

WINDOW = 50  # fixed value: words in a window
SPEC = Spec("words", WINDOW, 25)


def _cut(data, offs, s, e, row):
    """Kept words joined by one blank, counts and maximal intervals."""
    starts, ends, first = flat.words(data, offs)
    gone = covered(len(starts), s + first[row], e + first[row])
    word_row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    ks, ke, kr = starts[~gone], ends[~gone], word_row[~gone]
    # each kept word with a blank after it, but the last of its document
    size = ke - ks
    last = np.ones(len(kr), bool)
    last[:-1] = kr[1:] != kr[:-1]
    room = size + ~last
    at = np.cumsum(room) - room
    body = np.full(int(room.sum()), 32, np.uint8)
    body[flat.span_index(at, size)] = data[flat.span_index(ks, size)]
    total = np.zeros(len(offs), np.int64)
    np.cumsum(np.bincount(kr, weights=room, minlength=len(offs) - 1).astype(np.int64), out=total[1:])
    return {"n_words": pa.array(np.diff(first)), "n_removed": pa.array(np.bincount(word_row, weights=gone, minlength=len(offs) - 1).astype(np.int64)),
            "kept": flat.string_array(body, total)}


def dedup(docs: DataFrame, spec: Spec = SPEC) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the remaining words joined by one
    blank) for every row of ``docs(doc_id, text)``.

    Null and empty texts have no words. Repeated rows share an id, so neither
    has the smaller one and both are treated alike. A row without an id is
    neither before nor after another: it keeps its words and removes none.
    Other columns are ignored; an empty table gives no rows.
    """
    src = hashed(docs)
    rows = repeated(src.where("doc_id IS NOT NULL"), spec, "substrings")
    whole = rows.where("NOT contested AND first < doc_id").select(
        "doc_id", "thash", "los", F.lit(0).alias("s"), (F.col("cnt") + (spec.window - 1)).alias("e"))
    open_ = rows.where("contested").drop("first")
    classes = class_table(open_)
    seen = counted(src.where("doc_id IS NOT NULL"), classes, spec)
    # a class has a few windows; every member compares its id with their first ids
    lists = seen.groupBy("akey", "ckey").agg(F.collect_list(F.struct("o", "first")).alias("w"))
    parts = open_.join(lists, ["akey", "ckey"]).select("doc_id", "thash", "los", F.filter("w", lambda x: x["first"] < F.col("doc_id")).alias("w"))
    parts = parts.select("doc_id", "thash", "los", F.explode("w").alias("x")).select(
        "doc_id", "thash", "los", F.col("x.o").alias("s"), (F.col("x.o") + spec.window).alias("e"))
    return removal(src, whole.unionByName(parts), _cut, "n_words long, n_removed long, kept string", "substrings")


def op7_rabin_karp_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` without the windows that occur before."""
    return dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
