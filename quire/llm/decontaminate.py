"""Benchmark decontamination by edit-tolerant matching of item-sized windows.

Texts and items are sequences of normalised words (lower case, ASCII
punctuation removed). A document leaks an item if some window is within
``TOLERANCE`` of the item's length in word edits:

1. *Count filter, without loss*: ``n`` words with at most ``e`` edits keep at
   least ``n - q + 1 - q * e`` of their ``q``-word grams; ``q`` is three, or
   less where that bound would be below one. Only item-sized windows around
   documents' grams of an item that reaches this count go on.
2. *CGK embedding*: a random walk reads the window; at each step it writes the
   word it stands on and moves on or stays by a random bit of word
   and step. Windows few edits apart meet again and write equal symbols, so
   edit distance becomes Hamming distance.
3. *Repeated bit sampling*: each of ``REPEATS`` independent walks samples
   ``SAMPLE`` steps; a window is a candidate for the items of its size that
   agree on all samples of some repetition.
4. Candidates are verified by exact edit distance.

Items are handled in blocks of a fixed number, so what the tasks receive is
bounded; documents are read once per block and nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import read

TOLERANCE = 0.2       # word edits per item word
GRAM = 3
REPEATS, SAMPLE = 64, 2
REACH = 1.6           # sampled steps per word: a walk reaches the end after two on average,
                      # and steps beyond the end would agree for any two windows
BLOCK = 20_000        # items a task holds at once
NOTHING = np.uint64(0x2545F4914F6CDD1D)   # symbol after the end of a window

WORD = np.full(256, 32, np.uint8)         # ASCII that is no letter or digit becomes a blank
for _c in [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]:
    WORD[_c] = _c
ROLL, GRAMS = flat.Rolling(0x8EBC6AF09C88C6E3), flat.Rolling(0x589965CC75374CC3)


def symbols(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes with blanks for punctuation, and offsets."""
    data, offs = flat.buffer_of(pc.utf8_lower(col))
    return WORD[data], offs


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, e, first = flat.words(data, offs)
    return ROLL.ranges(ROLL.prefix(data), s, e), first


def edits(n: int, tolerance: float) -> int:
    """Word edits that an item of ``n`` words allows; short items none."""
    return int(n * tolerance + 1e-9) if n >= 5 else 0


def gram_size(n: int, e: int) -> int:
    """Words of the grams that an item of ``n`` words with ``e`` edits is
    counted by: the most of which one is kept."""
    return next((q for q in range(min(GRAM, n), 1, -1) if n - q + 1 - q * e >= 1), 1)


def gram_hashes(words: np.ndarray, first: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``q``-word grams of all texts, and their flat starts."""
    n = np.maximum(np.diff(first) - q + 1, 0)
    at = flat.span_index(first[:-1], n)
    return (GRAMS.ranges(GRAMS.prefix(words), at, at + q) if len(at) else np.zeros(0, np.uint64)), at


def walk(windows: np.ndarray, repeats: int = REPEATS, sample: int = SAMPLE) -> np.ndarray:
    """Signatures (windows x repeats) of equally long word windows: symbols
    that the walks write at their sampled steps, hashed together."""
    rows, n = windows.shape
    steps = max(1, int(REACH * n))
    rng = np.random.default_rng(n)
    salt = rng.integers(0, 1 << 63, (steps, repeats), dtype=np.int64).astype(np.uint64)
    picked = np.sort(rng.integers(0, steps, (repeats, sample)), axis=1)
    padded = np.concatenate([windows, np.full((rows, 1), NOTHING)], axis=1)
    line = np.arange(rows)[:, None]
    at = np.zeros((rows, repeats), np.int64)
    sign = np.zeros((rows, repeats), np.uint64)
    for t in range(int(picked.max()) + 1):
        word = padded[line, at]
        times = (picked == t).sum(1)
        if times.any():
            here = np.flatnonzero(times)
            for _ in range(int(times.max())):
                sign[:, here] = sign[:, here] * np.uint64(0x9E3779B97F4A7C15) + word[:, here]
                times[here] -= 1
                here = np.flatnonzero(times > 0)
        move = ((word ^ salt[t]) * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(40)
        at = np.minimum(at + (move & np.uint64(1)).astype(np.int64), n)
    return flat.mix(sign)


def edit_distance(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int]:
    """Least word edits from ``item`` to a prefix of ``text``, and that
    prefix's length (the shortest at a tie); ``most + 1`` if there are more."""
    width = min(len(text), len(item) + most)
    row = np.arange(width + 1)
    step = np.arange(width + 1)
    for i, w in enumerate(item.tolist(), 1):
        cost = row[:-1] + (text[:width] != w)
        nxt = np.empty(width + 1, np.int64)
        nxt[0] = i
        nxt[1:] = np.minimum(row[1:] + 1, cost)
        row = np.minimum.accumulate(nxt - step) + step   # insertions from the left
        if row.min() > most:
            return most + 1, 0
    end = int(np.argmin(row))
    return int(row[end]), end


class Items:
    """Index of one block of items."""

    def __init__(self, ids: list, words: list[np.ndarray], tolerance: float = TOLERANCE):
        self.ids, self.words = ids, words
        self.n = np.array([len(w) for w in words], np.int64)
        self.e = np.array([edits(n, tolerance) for n in self.n], np.int64)
        self.size: dict[int, np.ndarray] = defaultdict(list)
        for i, n in enumerate(self.n):
            if n:
                self.size[int(n)].append(i)
        self.size = {n: np.array(x) for n, x in self.size.items()}
        self.signs = {n: walk(np.stack([words[i] for i in x])) for n, x in self.size.items()}
        # grams of every length that items need: hash -> (item, place)
        self.grams = {}
        self.q = np.array([gram_size(int(n), int(e)) for n, e in zip(self.n, self.e)], np.int64)
        for q in sorted({int(q) for q, n in zip(self.q, self.n) if n}):
            mine = np.flatnonzero((self.q == q) & (self.n > 0)).tolist()
            flat_words = np.concatenate([words[i] for i in mine])
            first = np.concatenate([[0], np.cumsum(self.n[mine])])
            h, at = gram_hashes(flat_words, first, q)
            item = np.searchsorted(first, at, "right") - 1
            order = np.argsort(h, kind="stable")
            self.grams[q] = (h[order], np.array(mine)[item][order], (at - first[item])[order])
        self.least = np.maximum(self.n - self.q + 1 - self.q * self.e, 1)

    def hits(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """``(row, item, start, words, distance)``: the best window of every
        leaked item of every text (fewest edits, then the first)."""
        out = []
        for q, (keys, items, places) in self.grams.items():
            h, at = gram_hashes(words, first, q)
            left = np.searchsorted(keys, h, "left")
            known = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == h)
            if not len(known):
                continue
            count = np.searchsorted(keys, h[known], "right") - left[known]
            met = flat.span_index(left[known], count)
            where = np.repeat(at[known], count)
            row = np.searchsorted(first, where, "right") - 1
            item, guess = items[met], where - places[met]
            pair, inverse, number = np.unique(row * np.int64(len(self.ids)) + item, return_inverse=True, return_counts=True)
            enough = number >= self.least[pair % len(self.ids)]
            order = np.argsort(inverse, kind="stable")
            cut = np.cumsum(number) - number
            for k in np.flatnonzero(enough):
                r, i = divmod(int(pair[k]), len(self.ids))
                found = self._match(words[first[r]:first[r + 1]], i, guess[order[cut[k]:cut[k] + number[k]]] - first[r])
                out += [(r, *f) for f in found]
        best: dict[tuple[int, int], tuple] = {}
        for r, i, start, n, d in out:
            if (r, i) not in best or (d, start) < best[r, i][:2]:
                best[r, i] = (d, start, n)
        return [(r, i, start, n, d) for (r, i), (d, start, n) in best.items()]

    def _match(self, text: np.ndarray, item: int, guess: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Windows of the item's size near the guessed starts that the walks
        find and the exact distance confirms."""
        n, e = int(self.n[item]), int(self.e[item])
        guess = np.sort(guess)
        starts = np.unique((np.unique(guess)[:, None] + np.arange(-e, e + 1)).ravel())
        # the kept grams of a leak all lie within e words of its start
        near = np.searchsorted(guess, starts + e, "right") - np.searchsorted(guess, starts - e, "left")
        starts = starts[(near >= self.least[item]) & (starts >= 0) & (starts < len(text))]
        padded = np.concatenate([text, np.full(n, NOTHING)])
        peers = self.size[n]
        out = []
        for b in range(0, len(starts), 512):
            s = starts[b:b + 512]
            sign = walk(padded[s[:, None] + np.arange(n)])
            for j, i in enumerate(peers):
                agree = (sign == self.signs[n][j]).sum(1)
                for k in np.argsort(-agree, kind="stable")[:np.count_nonzero(agree)].tolist():
                    p = int(s[k])
                    d, length = edit_distance(self.words[i], text[p:p + n + e], e)
                    if d <= e:
                        out.append((int(i), p, length, d))
                    if d == 0:
                        break
        return out


def _blocks(items: DataFrame, id_col: str, tolerance: float, block: int) -> Iterator[Items]:
    """Indexes of at most ``block`` distinct items each."""
    rows = items.where(F.col("text").isNotNull()).select(F.col(id_col).cast("long").alias("i"), "text").distinct().orderBy("i", "text")
    ids, texts = [], []
    for r in rows.toLocalIterator():
        ids.append(r["i"])
        texts.append(r["text"])
        if len(ids) == block:
            yield _index(ids, texts, tolerance)
            ids, texts = [], []
    if ids:
        yield _index(ids, texts, tolerance)


def _index(ids: list, texts: list[str], tolerance: float) -> Items:
    words, first = word_hashes(*symbols(pa.array(texts, pa.string())))
    return Items(ids, [words[a:b] for a, b in zip(first[:-1], first[1:])], tolerance)


RESULT = "doc_id long, item_id long, start_word int, n_words int, distance int, item_words int"


def matches(docs: DataFrame, items: DataFrame, id_col: str = "item_id", tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, distance, item_words``: one row
    for every row of ``docs(doc_id, text)`` and item that it leaks, with the
    closest window. Null and empty texts leak nothing, null and wordless items
    are leaked by nothing, repeated rows are reported each, a null id stays
    null. Clean documents have no row; empty tables give no rows."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in _blocks(items, id_col, tolerance, block):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most ``block`` items
        part = src.mapInArrow(_report(shared), RESULT)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], RESULT)


def _report(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            data, offs = symbols(batch.column("text"))
            for i, _, d, o in flat.slices(data, offs):
                found = index.hits(*word_hashes(d, o))
                if found:
                    row, item, start, n, dist = (list(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array([r + i for r in row])), pa.array([index.ids[k] for k in item], pa.int64()),
                        pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(dist, pa.int32()),
                        pa.array([int(index.n[k]) for k in item], pa.int32())],
                        names=["doc_id", "item_id", "start_word", "n_words", "distance", "item_words"])
    return run


def clean(docs: DataFrame, items: DataFrame, id_col: str = "item_id", tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that leak no item, unchanged, in one pass per
    block of items and without a shuffle."""
    for index in _blocks(items, id_col, tolerance, block):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(_filter(shared), docs.schema)
    return docs


def _filter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = symbols(batch.column("text"))
            keep = np.ones(batch.num_rows, bool)
            for i, _, d, o in flat.slices(data, offs):
                for hit in shared.value.hits(*word_hashes(d, o)):
                    keep[hit[0] + i] = False
            yield batch.filter(pa.array(keep))
    return run


def op8_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``benchmark`` item that a document of ``documents`` holds, up to
    ``TOLERANCE`` word edits."""
    return matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
