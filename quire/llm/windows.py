"""Repeated fixed-length windows of many texts, without a row per window.

Two equal windows choose the same *anchor*: the k-gram of the window with the
smallest hash, the leftmost at a tie. Neighbouring windows mostly share their
anchor, so a text becomes a few ranges of windows, each with the hash of its
anchor and the hash of the range's whole *context* (every byte or word that
its windows cover):

* an anchor that occurs once has no repeated window and goes no further,
* equal contexts have equal windows: they are one class, and are combined
  before anything moves, however many copies there are,
* only anchors with several classes are *contested* and need their windows
  compared one by one; the operators differ in how they do that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import stage

UNIT_ROLL = flat.Rolling(0xC2B2AE3D27D4EB4F)
LOOK_ROLL = flat.Rolling(0x9FB21C651E98DF25)
WORD_ROLL = flat.Rolling(0xD6E8FEB86659FD93)
LOW32 = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Spec:
    """Window length and anchor length, in bytes or in words."""
    unit: str
    window: int
    gram: int


def units(spec: Spec, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of bytes or word hashes, and the texts' offsets in it."""
    if spec.unit == "bytes":
        return data, offs
    s, e, first = flat.words(data, offs)
    return WORD_ROLL.ranges(WORD_ROLL.prefix(data), s, e), first


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, from running minima of blocks."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(x)] = x
    grid = pad.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def ranges(spec: Spec, x: np.ndarray, offs: np.ndarray):
    """``(row, first window, windows, anchor)`` of every range, with flat
    positions, and the prefix hashes of the sequence."""
    h = UNIT_ROLL.prefix(x)
    z = np.zeros(0, np.int64)
    if len(x) < spec.window:
        return z, z, z, z, h
    p = np.arange(len(x) - spec.gram + 1)
    grams = UNIT_ROLL.ranges(h, p, p + spec.gram)
    low = sliding_min((grams & ~LOW32) | p.astype(np.uint64), spec.window - spec.gram + 1)
    n = np.maximum(np.diff(offs) - spec.window + 1, 0)
    s = flat.span_index(offs[:-1], n)
    if not len(s):
        return z, z, z, z, h
    row = np.repeat(np.arange(len(n)), n)
    anchor = (low[s] & LOW32).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    return row[new], s[new], np.diff(np.append(new, len(s))), anchor[new], h


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


ANCHORS = "doc_id long, thash long, akey long, ckey long, los array<int>, cnt int"


def _anchors(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
                x, at = units(spec, d, o)
                row, lo, cnt, anchor, h = ranges(spec, x, at)
                akey = UNIT_ROLL.ranges(h, anchor, anchor + spec.gram)
                ckey = flat.mix(UNIT_ROLL.ranges(h, lo, lo + cnt - 1 + spec.window) + (anchor - lo).astype(np.uint64))
                # a context that a text repeats is one row with all its places
                order = np.lexsort((lo, ckey, akey, row))
                r, a, c = row[order], akey[order], ckey[order]
                new = np.ones(len(order), bool)
                new[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                new = np.flatnonzero(new)
                places = pa.ListArray.from_arrays(pa.array(np.append(new, len(order)), pa.int32()), pa.array((lo - at[row])[order], pa.int32()))
                take = pa.array(r[new] + i)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(take), batch.column("thash").take(take), _long(a[new]), _long(c[new]),
                    places, pa.array(cnt[order][new], pa.int32())],
                    names=["doc_id", "thash", "akey", "ckey", "los", "cnt"])
    return run


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, thash, text``: a row is known by its id and its text's hash,
    so rows that share an id but not the text stay apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("thash"), "text")


def repeated(src: DataFrame, spec: Spec, name: str) -> DataFrame:
    """Ranges whose anchor occurs more than once: the anchor table's columns,
    ``first`` (smallest id) and ``contested`` (the contexts differ)."""
    a = stage(src.mapInArrow(_anchors(spec), ANCHORS), f"{name}-anchors")
    k = a.groupBy("akey").agg(F.sum(F.size("los")).alias("c"), F.min("ckey").alias("c0"), F.max("ckey").alias("c1"), F.min("doc_id").alias("first"))
    k = k.where("c > 1").select("akey", "first", (F.col("c0") != F.col("c1")).alias("contested"))
    # written first: a join of two plain scans can be split at a frequent anchor
    return stage(a.join(stage(k, f"{name}-often"), "akey"), f"{name}-repeated")


def with_texts(src: DataFrame, rows: DataFrame, cols: list[str]) -> DataFrame:
    """``src`` joined to the list ``parts`` of its rows' structs of ``cols``."""
    parts = rows.groupBy("doc_id", "thash").agg(F.collect_list(F.struct(*cols)).alias("parts"))  # within one text
    parts = parts.select(F.col("doc_id").alias("d"), F.col("thash").alias("t"), "parts")
    return src.join(parts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("thash") == F.col("t"))).drop("d", "t") \
        .dropDuplicates(["doc_id", "thash"])


def _hashes(spec: Spec):
    """Every window of the wanted ranges: Rabin-Karp hashes of its content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            parts = batch.column("parts")
            for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
                x, at = units(spec, d, o)
                h, g = UNIT_ROLL.prefix(x), LOOK_ROLL.prefix(x)
                mine = parts.slice(i, j - i)
                each = np.diff(mine.offsets.to_numpy())
                f = mine.flatten()
                row = np.repeat(np.arange(j - i), each)
                cnt = f.field("cnt").to_numpy().astype(np.int64)
                lo = f.field("lo").to_numpy() + at[row]
                s = flat.span_index(lo, cnt)
                which = np.repeat(np.arange(len(cnt)), cnt)
                for b in range(0, len(s), 1 << 18):
                    p, w = s[b:b + (1 << 18)], which[b:b + (1 << 18)]
                    yield pa.RecordBatch.from_arrays([
                        f.field("akey").take(pa.array(w)), f.field("ckey").take(pa.array(w)), pa.array((p - lo[w]).astype(np.int32)),
                        _long(UNIT_ROLL.ranges(h, p, p + spec.window)), _long(LOOK_ROLL.ranges(g, p, p + spec.window)),
                        f.field("least").take(pa.array(w)), f.field("copies").take(pa.array(w))],
                        names=["akey", "ckey", "o", "h1", "h2", "least", "copies"])
    return run


def counted(src: DataFrame, classes: DataFrame, spec: Spec) -> DataFrame:
    """Windows of the classes' representatives, counted by content:
    ``akey, ckey, o`` with the smallest id (``first``) and the number of
    occurrences (``copies``) of the window among all classes."""
    rows = with_texts(src, classes, ["akey", "ckey", "lo", "cnt", "least", "copies"]).mapInArrow(
        _hashes(spec), "akey long, ckey long, o int, h1 long, h2 long, least long, copies long")
    rows = stage(rows, "windows")
    total = rows.groupBy("h1", "h2").agg(F.min("least").alias("first"), F.sum("copies").alias("copies"))
    return rows.select("akey", "ckey", "o", "h1", "h2").join(total.where("copies > 1"), ["h1", "h2"]).drop("h1", "h2")


def class_table(ranges_: DataFrame) -> DataFrame:
    """One row per (anchor, context): a representative range, the smallest id
    and the number of copies."""
    return ranges_.groupBy("akey", "ckey").agg(
        F.min(F.struct("doc_id", "thash", F.col("los")[0].alias("lo"), "cnt")).alias("r"),
        F.sum(F.size("los")).alias("copies"), F.min("doc_id").alias("least")
    ).select("akey", "ckey", "r.doc_id", "r.thash", "r.lo", "r.cnt", "copies", "least")


def removal(src: DataFrame, spans: DataFrame, cut: Callable, fields: str, name: str, keep: list | None = None) -> DataFrame:
    """Every row of ``src`` with its unit spans ``(doc_id, thash, los, s, e)``
    (from ``lo + s`` to ``lo + e`` for each of ``los``) cut out by
    ``cut(bytes, offsets, starts, ends, row of each span)``; further columns
    of the spans are further arguments of ``cut``."""
    marks = [c for c in spans.columns if c not in ("doc_id", "thash", "los", "s", "e")]
    by_row = spans.distinct().groupBy("doc_id", "thash").agg(F.collect_list(F.struct("los", "s", "e", *marks)).alias("spans"))
    by_row = stage(by_row, f"{name}-spans").select(F.col("doc_id").alias("d"), F.col("thash").alias("t"), "spans")
    full = src.join(by_row, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("thash") == F.col("t")), "left").drop("d", "t", "thash")
    kept = [c for c in full.columns if c not in ("text", "spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            parts = batch.column("spans").fill_null([])
            for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
                mine = parts.slice(i, j - i)
                f = mine.flatten()
                los = f.field("los")
                n = np.diff(los.offsets.to_numpy())
                at = los.flatten().to_numpy().astype(np.int64)
                row = np.repeat(np.repeat(np.arange(j - i), np.diff(mine.offsets.to_numpy())), n)
                more = [np.repeat(f.field(c).to_numpy(zero_copy_only=False), n) for c in marks]
                out = cut(d, o, at + np.repeat(f.field("s").to_numpy(), n), at + np.repeat(f.field("e").to_numpy(), n), row, *more)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in kept), *out.values()], names=[*kept, *out])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields if f.name in kept)
    return full.select(*kept, "text", "spans").mapInArrow(run, f"{types}, {fields}")


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` units lie in some span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge)[:n] > 0
