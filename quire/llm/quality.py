"""Quality classifier: a factorisation machine.

Features of a text: hashed words (square root of their share), statistics of
its structure (shares of byte classes, lengths, repetition) and metadata
(``n_chars``). The model scores
``w0 + sum(w_i x_i) + 1/2 sum_f((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``,
the sum-of-squares identity that gives all pairwise interactions in time
linear in the features present. It is fitted by AdaGrad on a bounded sample
of labelled rows (``max_train``, the rows with the smallest id hashes) and its
fixed size (``BUCKETS * (RANK + 1)`` numbers) is what the tasks receive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import held_out, read

THRESHOLD = 0.7      # fixed value: scores from here on predict 1
MAX_TRAIN = 8000     # labelled rows the model is fitted on, at most
BUCKETS = 1 << 16
RANK = 8
EPOCHS = 8
BATCH = 64
RATE = 0.05
DECAY = 1e-5

# byte classes of the structure statistics
GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"!?", b"|",
          b"%", b"#", b"$", b"&", b"*", b"<>{}[]\\/=+_~^`@", b" ", b"\n\r\t"]
CLASS = np.full(256, len(GROUPS), np.uint8)   # other ASCII
for _i, _g in enumerate(GROUPS):
    CLASS[list(_g)] = _i
CLASS[128:] = len(GROUPS) + 1
KINDS = len(GROUPS) + 2
STATS = KINDS + 9
WORD = np.full(256, 32, np.uint8)             # bytes that are no part of a word become blanks
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    WORD[_c] = _c
WORD[65:91] = np.arange(97, 123)
ROLL = flat.Rolling()


def features(data: np.ndarray, offs: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, value)`` of the words and the matrix of statistics.
    ``n_chars`` is NaN where it is missing."""
    rows = len(offs) - 1
    size = np.diff(offs)
    row_of = np.repeat(np.arange(rows), size)
    share = np.bincount(row_of * KINDS + CLASS[data], minlength=rows * KINDS).reshape(rows, KINDS)
    share = share / np.maximum(size, 1)[:, None]
    plain = WORD[data]
    s, e, first = flat.words(plain, offs)
    h = ROLL.ranges(ROLL.prefix(plain), s, e)
    count = np.diff(first)
    word_row = np.repeat(np.arange(rows), count)
    key, tf = np.unique(word_row * np.int64(BUCKETS) + (h % flat.U64(BUCKETS)).astype(np.int64), return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    value = np.sqrt(tf / np.maximum(count[row], 1))
    kinds = np.bincount(row, minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, row, tf)
    letters = np.bincount(word_row, weights=e - s, minlength=rows)
    n = np.maximum(count, 1)
    lines = np.bincount(row_of, weights=data == 10, minlength=rows) + 1
    known = ~np.isnan(n_chars)
    stats = np.column_stack([
        share, np.log1p(size), np.log1p(count), letters / n, kinds / n, most / n, np.log1p(size / lines), size == 0,
        np.where(known, np.log1p(np.maximum(np.nan_to_num(n_chars), 0)), 0.0), ~known])
    return row, bucket, value, stats


@dataclass
class Machine:
    """Fitted weights; features 0..STATS-1 are the statistics, then the words."""
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def arrays(self, row, bucket, value, stats):
        """Feature ids, values and row pointers, all rows' features together."""
        rows = len(stats)
        words = np.bincount(row, minlength=rows)
        first = np.arange(rows) * STATS + np.cumsum(words) - words   # a row's statistics, then its words
        ids, x = np.empty(rows * STATS + len(row), np.int32), np.empty(rows * STATS + len(row))
        at = (first[:, None] + np.arange(STATS)).ravel()
        ids[at] = np.tile(np.arange(STATS, dtype=np.int32), rows)
        x[at] = (np.clip((stats - self.mean) / self.scale, -5, 5) / 4).ravel()
        at = np.ones(len(ids), bool)
        at[(first[:, None] + np.arange(STATS)).ravel()] = False
        ids[at], x[at] = bucket + STATS, value
        return ids, x, first

    def raw(self, ids, x, first):
        e = self.v[ids] * x[:, None]
        total = np.add.reduceat(e, first, axis=0)
        square = np.add.reduceat(e * e, first, axis=0)
        return self.bias + np.add.reduceat(self.w[ids] * x, first) + 0.5 * (total * total - square).sum(1), e, total

    def score(self, data, offs, n_chars) -> np.ndarray:
        if len(offs) < 2:
            return np.zeros(0)
        y, _, _ = self.raw(*self.arrays(*features(data, offs, n_chars)))
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = flat.buffer_of(batch.column("text"))
        chars = _numbers(batch.column("n_chars"))
        for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
            row, bucket, value, stats = features(d, o, chars[i:j])
            cut = np.searchsorted(row, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), batch.column("quality").slice(i, j - i),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(bucket, pa.int32())),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(value, pa.float32())),
                pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), STATS).cast(pa.list_(pa.float64()))],
                names=["doc_id", "quality", "bucket", "value", "stats"])


def _numbers(col: pa.Array) -> np.ndarray:
    return col.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _with_chars(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chars.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Machine:
    """A machine fitted on at most ``max_train`` labelled rows outside the held
    out fold. A document labelled several times counts with its highest label;
    null labels do not count. Without rows every score is 1/2; with one class
    only, scores lean to that class."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    near = marked.select("doc_id", "quality", F.xxhash64("doc_id").alias("h"))
    # bounded by max_train rows of two numbers
    sample = near.orderBy("h", "doc_id").limit(max_train).select("doc_id", "quality")
    got = _with_chars(docs).join(F.broadcast(sample), "doc_id").mapInArrow(
        _examples, "doc_id long, quality int, bucket array<int>, value array<float>, stats array<double>")
    table = got.limit(2 * max_train).toArrow().sort_by([("doc_id", "ascending")]).combine_chunks()
    y = table["quality"].to_numpy().astype(float)
    n = len(y)
    m = Machine(0.0, np.zeros(BUCKETS + STATS), np.zeros((BUCKETS + STATS, RANK)), np.zeros(STATS), np.ones(STATS))
    if n == 0:
        return m
    stats = table["stats"].combine_chunks().flatten().to_numpy().reshape(n, STATS)
    lens = table["bucket"].combine_chunks().value_lengths().to_numpy()
    # views of the table, which is all that the driver holds of the sample until the features are laid out
    bucket, value = (table[c].combine_chunks().flatten().to_numpy() for c in ("bucket", "value"))
    del table
    m.mean, m.scale = stats.mean(0), np.maximum(stats.std(0), 1e-6)
    rng = np.random.default_rng(7)
    m.v = rng.normal(0, 0.01, m.v.shape)
    share = (y.sum() + 1) / (n + 2)
    m.bias = float(np.log(share / (1 - share)))
    ids, x, first = m.arrays(np.repeat(np.arange(n, dtype=np.int32), lens), bucket, value, stats)
    del bucket, value, stats
    pa.default_memory_pool().release_unused()
    stop = np.append(first[1:], len(ids))
    gw, gv, gb = np.full(m.w.shape, 1e-6), np.full(m.v.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            part = order[i:i + BATCH]
            size = (stop - first)[part]
            at = flat.span_index(first[part], size)
            pid, px, pf = ids[at], x[at], np.cumsum(size) - size
            raw, e, total = m.raw(pid, px, pf)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[part]) / len(part)
            step = np.repeat(g, size) * px
            some, inv = np.unique(pid, return_inverse=True)
            dw = np.bincount(inv, step) + DECAY * m.w[some]
            per = step[:, None] * (np.repeat(total, size, axis=0) - e)
            dv = np.column_stack([np.bincount(inv, per[:, f]) for f in range(RANK)]) + DECAY * m.v[some]
            gw[some] += dw * dw
            gv[some] += dv * dv
            gb += g.sum() ** 2
            m.w[some] -= RATE * dw / np.sqrt(gw[some])
            m.v[some] -= RATE * dv / np.sqrt(gv[some])
            m.bias -= RATE * g.sum() / np.sqrt(gb)
    m.w, m.v = m.w.astype(np.float32), m.v.astype(np.float32)
    return m


def scores(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (``doc_id`` by default) of every row of ``docs``
    and its ``score``: the model's probability of label 1. Null and empty
    texts are scored as texts without words; repeated rows stay repeated."""
    keep = ["doc_id"] if keep is None else keep
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("t"), chars.alias("n"))
    model = docs.sparkSession.sparkContext.broadcast(machine)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("t"))
            chars = _numbers(batch.column("n"))
            for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
                kept = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.value.score(d, o, chars[i:j]))],
                                                 names=[*(f"k{k}" for k in range(len(keep))), "score"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:len(keep)])
    out = src.mapInArrow(run, f"{types}, score double")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score")


def op2_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    out = scores(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
