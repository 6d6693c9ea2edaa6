"""Suffix-array deduplication with deep-shallow sorting.

Every byte that is covered by a ``WINDOW``-byte string which also starts
anywhere else is removed. The suffixes that can decide this (those whose first
``WINDOW`` bytes lie in a contested range, see ``windows``) are sorted by their
first ``WINDOW`` bytes, group by group:

* *shallow*: multikey quicksort, eight bytes to a key, to ``SHALLOW`` bytes;
  a suffix that stands alone after a key is done,
* *deep*: the remaining groups share a long prefix. Each becomes a blind trie:
  the group's longest common prefix is skipped, the suffixes branch by the one
  byte after it, and only branches with several suffixes go on. A group whose
  common prefix reaches ``WINDOW`` is a repeated string.

All groups of a task are sorted together, one vector operation per key or trie
level. Ranges are dealt to tasks by anchor; anchors with more than ``CROWD``
different contexts are counted window by window instead, so no task holds an
unbounded group.

Windows may also be words (``Spec("words", ...)``): suffixes then start at
words only, a word is compared by its 64-bit hash, and white space does not
count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import read, stage
from quire.llm.windows import Spec, class_table, counted, covered, hashed, removal, repeated, units, with_texts

WINDOW = 400      # fixed value: bytes of a repeated string
SPEC = Spec("bytes", WINDOW, 64)
SHALLOW = 32      # bytes sorted by multikey quicksort
CROWD = 1024      # contexts of one anchor that a task sorts at most
CHUNK = 1 << 18   # suffixes sorted at once, but always whole groups


def _split(group: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of multikey quicksort on all groups: suffixes ordered by group
    and key, with new group numbers; lone suffixes are left out."""
    order = np.lexsort((key, group))
    group, key, at = group[order], key[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    number = np.cumsum(new) - 1
    several = np.bincount(number)[number] > 1
    return number[several], at[several]


def repeated_suffixes(body: np.ndarray, start: np.ndarray, group: np.ndarray, length: int = WINDOW, shallow: int = SHALLOW) -> np.ndarray:
    """For each suffix (``start`` in ``body``) whether another suffix of its
    group has the same first ``length`` bytes."""
    out = np.zeros(len(start), bool)
    if not len(start):
        return out
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, dtype=">u8", buffer=padded.data, strides=(1,))
    at = np.arange(len(start))
    number, at = _split(group, np.zeros(len(start), np.uint8), at)
    depth = 0
    while depth + 8 <= min(shallow, length) and len(at):       # shallow part
        number, at = _split(number, eight[start[at] + depth].astype(np.uint64), at)
        depth += 8
    deep = np.full(len(at), depth)
    while len(at):                                            # blind tries
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        size = np.diff(np.append(first, len(at)))
        lead = np.repeat(start[at[first]], size)
        mine = start[at]
        # longest common prefix of every suffix with its group's first one
        common = deep.copy()
        open_ = np.flatnonzero(common < length)
        while len(open_):
            a, b = eight[mine[open_] + common[open_]], eight[lead[open_] + common[open_]]
            differ = a != b
            stop = open_[differ]
            if len(stop):
                x = (a[differ].astype(np.uint64) ^ b[differ].astype(np.uint64))
                common[stop] += (63 - np.floor(np.log2(x.astype(np.float64))).astype(np.int64).clip(0, 63)) // 8
            open_ = open_[~differ]
            common[open_] += 8
            open_ = open_[common[open_] < length]
        skip = np.repeat(np.minimum.reduceat(common, first), size)  # the group's common prefix
        same = skip >= length
        out[at[same]] = True
        number, at, skip = number[~same], at[~same], skip[~same]
        if not len(at):
            break
        level = np.zeros(number[-1] + 1, np.int64)
        level[number] = skip
        old = number
        branch = padded[start[at] + skip]
        order = np.lexsort((branch, number))
        at, old, branch = at[order], old[order], branch[order]
        new = np.ones(len(at), bool)
        new[1:] = (old[1:] != old[:-1]) | (branch[1:] != branch[:-1])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        deep = (level[old] + 1)[several]
        number, at = number[several], at[several]
    return out


def _width(spec: Spec) -> int:
    """Bytes of a unit in a context: a word stands there as its 64-bit hash."""
    return 1 if spec.unit == "bytes" else 8


def _contexts(specs: Sequence[Spec]):
    """The units of the wanted ranges, with the anchor's hash in front."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            parts = batch.column("parts")
            for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
                mine = parts.slice(i, j - i)
                every = mine.flatten()
                rows = np.repeat(np.arange(j - i), np.diff(mine.offsets.to_numpy()))
                kind = every.field("spec").to_numpy()
                for number, spec in enumerate(specs):
                    x, first = units(spec, d, o)
                    own = np.flatnonzero(kind == number)
                    f, row = every.take(pa.array(own)), rows[own]
                    lo, cnt = f.field("lo").to_numpy().astype(np.int64), f.field("cnt").to_numpy().astype(np.int64)
                    s, n = lo + first[row], cnt + spec.window - 1
                    for b in range(0, len(s), 4096):
                        p, m, k = s[b:b + 4096], n[b:b + 4096], pa.array(row[b:b + 4096] + i)
                        body = x[flat.span_index(p, m)]
                        at = np.concatenate([[0], np.cumsum(m * _width(spec))]).astype(np.int32)
                        ctx = pa.BinaryArray.from_buffers(pa.binary(), len(p), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(body).view(np.uint8))])
                        part = f.slice(b, 4096)
                        yield pa.RecordBatch.from_arrays([part.field("spec"), part.field("akey"), batch.column("doc_id").take(k), batch.column("thash").take(k),
                                                          part.field("lo"), part.field("cnt"), part.field("copies"), ctx],
                                                         names=["spec", "akey", "doc_id", "thash", "lo", "cnt", "copies", "ctx"])
    return run


def _sorted_groups(specs: Sequence[Spec]):
    """Sorts the suffixes of whole anchor groups; yields the spans of ranges
    that stand for one document. Rows come ordered by spec and anchor."""
    names = ["spec", "doc_id", "thash", "s", "e"]

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        number = rows[0].column("spec")[0].as_py()
        spec = specs[number]
        t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        ctx = t.column("ctx")
        offs = np.frombuffer(ctx.buffers()[1], np.int32)[ctx.offset:ctx.offset + len(ctx) + 1].astype(np.int64)
        body = np.frombuffer(ctx.buffers()[2], np.uint8)
        cnt = t.column("cnt").to_numpy().astype(np.int64)
        which = np.repeat(np.arange(len(cnt)), cnt)
        place = flat.span_index(np.zeros(len(cnt), np.int64), cnt)
        start = offs[which] + place * _width(spec)
        _, group = np.unique(t.column("akey").to_numpy(), return_inverse=True)
        hit = repeated_suffixes(body, start, group[which], spec.window * _width(spec)) & (t.column("copies").to_numpy()[which] == 1)
        hit = np.flatnonzero(hit)
        # runs of neighbouring windows are one span
        w, o = which[hit], place[hit] + t.column("lo").to_numpy()[which[hit]]
        new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (np.diff(o) != 1)])) if len(hit) else hit
        last = np.append(new[1:], len(hit)) - 1 if len(hit) else hit
        k = pa.array(w[new])
        return pa.RecordBatch.from_arrays([t.column("spec").take(k), t.column("doc_id").take(k), t.column("thash").take(k), pa.array(o[new], pa.int32()),
                                           pa.array(o[last] + spec.window, pa.int32())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            key, kind = batch.column("akey").to_numpy(), batch.column("spec").to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), batch.num_rows]
            total = np.concatenate([[0], np.cumsum(batch.column("cnt").to_numpy().astype(np.int64))])
            for a, b in zip(cuts[:-1], cuts[1:]):
                last = (held[-1].column("spec")[-1].as_py(), held[-1].column("akey")[-1].as_py()) if held else None
                if held and (kind[a] != last[0] or n >= CHUNK and key[a] != last[1]):
                    yield solve(held)
                    held, n = [], 0
                held.append(batch.slice(a, b - a))
                n += int(total[b] - total[a])
        if held:
            yield solve(held)
    return run


def _cut(data, offs, s, e, row, words):
    """Remaining bytes, counts and maximal removed runs. Spans marked ``words``
    go from the start of their first word to the end of their last one."""
    start, end = s + offs[row], e + offs[row]
    if words.any():
        ws, we, first = flat.words(data, offs)
        start[words] = ws[s[words] + first[row[words]]]
        end[words] = we[e[words] + first[row[words]] - 1]
    gone = covered(len(data), start, end)
    rows = len(offs) - 1
    byte_row = np.repeat(np.arange(rows), np.diff(offs))
    first = gone.copy()
    first[1:] &= ~gone[:-1] | (byte_row[1:] != byte_row[:-1])
    count = lambda m: np.bincount(byte_row, weights=m, minlength=rows).astype(np.int64)
    removed = count(gone)
    at = np.concatenate([[0], np.cumsum(np.diff(offs) - removed)]).astype(np.int32)
    kept = pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[~gone]))])
    return {"n_bytes": pa.array(np.diff(offs)), "n_removed": pa.array(removed), "n_spans": pa.array(count(first)), "kept": kept}


def _cut_text(data, offs, s, e, row, words):
    """As ``_cut``, with the remaining bytes as text: what a cut leaves of a
    character is dropped."""
    out = _cut(data, offs, s, e, row, words)
    kept, cut = out.pop("kept"), out["n_removed"].to_numpy() > 0
    out["text"] = pa.array([b.decode("utf-8", "ignore") if c else b.decode("utf-8", "replace")
                            for b, c in zip(kept.to_pylist(), cut)], pa.string())
    return out


def _spans(src: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """``doc_id, thash, los, s, e, words``: the units of every window of a
    spec that also starts anywhere else. The texts are read for the contexts
    of all specs together."""
    out, sort = None, None

    def add(spans, words):
        nonlocal out
        spans = spans.withColumn("words", words).drop("spec")
        out = spans if out is None else out.unionByName(spans)

    start, end = F.lit(0).alias("s"), F.col("cnt")
    for number, spec in enumerate(specs):
        words = F.lit(spec.unit == "words")
        rows = repeated(src, spec, "suffixes")
        whole = (end + (spec.window - 1)).alias("e")
        add(rows.where("NOT contested").select("doc_id", "thash", "los", start, whole), words)
        open_ = rows.where("contested").drop("first")
        classes = stage(class_table(open_), "suffixes-classes")
        add(open_.join(classes.where("copies > 1").select("akey", "ckey"), ["akey", "ckey"], "left_semi").select(
            "doc_id", "thash", "los", start, whole), words)
        crowded = classes.groupBy("akey").agg(F.count(F.lit(1)).alias("c")).select("akey", (F.col("c") > CROWD).alias("crowded"))
        classes = stage(classes.join(crowded, "akey"), "suffixes-classes")
        # crowded anchors: one row per window, equal windows combined
        alone = classes.where("crowded AND copies = 1").select("akey", "ckey", "doc_id", "thash", "lo")
        seen = counted(src, classes.where("crowded").drop("crowded"), spec)
        add(seen.join(alone, ["akey", "ckey"]).select(
            "doc_id", "thash", F.array("lo").alias("los"), F.col("o").alias("s"), (F.col("o") + spec.window).alias("e")), words)
        mine = classes.where("NOT crowded").withColumn("spec", F.lit(number))
        sort = mine if sort is None else sort.unionByName(mine)
    # most anchors: sort the suffixes of their contexts
    ctx = with_texts(src, sort, ["spec", "akey", "lo", "cnt", "copies"]).mapInArrow(
        _contexts(specs), "spec int, akey long, doc_id long, thash long, lo int, cnt int, copies long, ctx binary")
    done = ctx.repartition("spec", "akey").sortWithinPartitions("spec", "akey").mapInArrow(_sorted_groups(specs), "spec int, doc_id long, thash long, s int, e int")
    worded = F.element_at(F.array(*[F.lit(x.unit == "words") for x in specs]), F.col("spec") + 1)
    add(done.select("spec", "doc_id", "thash", F.array("s").alias("los"), start, (F.col("e") - F.col("s")).alias("e")), worded)
    return out


def dedup(docs: DataFrame, spec: Spec = SPEC, carry: list[str] | None = None, as_text: bool = False,
          also: Sequence[Spec] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes; with
    ``as_text`` a string ``text`` instead) for every row of ``docs(doc_id,
    text)``, with the columns ``carry`` besides. Repeats of every spec of
    ``also`` are cut too; all specs are judged on the input.

    Null and empty texts are empty. Each row counts, rows without an id or
    with the same id too: a repeated row of ``WINDOW`` bytes loses its whole
    text in both places. An empty table gives no rows.
    """
    src = hashed(docs)
    spans = _spans(src, [spec, *also])
    carry = carry or []
    if carry:
        src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("thash"),
                          *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], "text")
    last = "text" if as_text else "kept"
    out = removal(src, spans, _cut_text if as_text else _cut,
                  f"n_bytes long, n_removed long, n_spans long, {last} {'string' if as_text else 'binary'}", "suffixes")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", last, *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def op5_deep_shallow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` without repeated 400-byte strings."""
    return dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
