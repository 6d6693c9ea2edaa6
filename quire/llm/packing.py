"""Packing of token sequences by bounded-space online best-fit.

Documents become token ids and an end id; ids beyond the capacity are cut
into pieces. Pieces meet the open bins one by one: a piece goes to the bin
with the least free space that still holds it, else a new bin is opened, and
when all ``OPEN`` places are taken the fullest bin closes first. The open
bins are a bitset keyed by free space, so the best bin is the lowest set bit
at or above the piece's length.

Pieces are dealt into groups of about ``GROUP``; a task packs one group and
holds its open bins only. The bins still open at the end of the groups are
packed once more as items of their own, group by group, until one group is
left, so the last bins of many tasks fill each other.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.tables import read, stage
from quire.llm.vocab import _byte_chars

CAPACITY = 4096      # fixed value: tokens in a sequence
END_ID = 1           # fixed value: id after every document
OPEN = 512           # open bins of a task
GROUP = 1 << 15      # pieces, or left bins, that are packed together
PART = 1 << 20       # bytes of a text that are cut into words at a time
KNOWN = 400_000      # parts whose ids a task remembers
LONG_PART = 256      # characters; longer parts are not remembered


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    return lib


# Fixed values, those of the tokenizer file: its split pattern for texts of
# ASCII and of the letters from U+00C0 to U+00FF, in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff \t-\r]*")
_WORD_END = "</w>"
_OTHER = "\0"          # before a word that is encoded as a whole
_GAP = b"\xff" * 4   # between ids; ids are below 2 ** 24, so no ids hold it


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer drops white space and no token crosses a part of its split
    pattern, so the ids of a text are those of its parts in turn, and every
    distinct part is encoded once. A text of ASCII and accented Latin letters
    is lower-cased and split here; its new parts go to the library's model in
    one call, where the mark of a part's last token tells the parts from each
    other. Of any other text the words (runs without ASCII white space) that
    hold other characters, or that may hold a special string, go through the
    whole library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.lib = _library(path)
        self.model = Tokenizer(self.lib.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocab = self.lib.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_WORD_END)]] = True
        self.shown = {b: c for c, b in _byte_chars().items() if b != 32}
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        other = [p for p in new if p[0] == _OTHER]
        got = self.lib.encode_batch_fast([p[1:] for p in other], add_special_tokens=False)
        self.known.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(other, got))
        parts = [p for p in new if p[0] != _OTHER] if other else new
        if not parts:
            return
        text = " ".join(parts).encode().decode("latin-1").translate(self.shown)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        to = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(to) != len(parts):
            raise ValueError("the vocabulary does not mark the last token of a word")
        raw = ids.tobytes()
        self.known.update(zip(parts, [raw[a:b] for a, b in zip([0, *to], to)]))

    def _split(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _PARTS.findall(text.lower())
        out = []
        for word in text.encode().split():   # exactly the ASCII white space
            word = word.decode()
            if _PLAIN.fullmatch(word) and "<|" not in word:
                out += _PARTS.findall(word.lower())
            else:
                out.append(_OTHER + word)
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text."""
        out: list[list[bytes]] = []
        for some in self._cut(texts):
            split = []
            for _, text in some:
                split += self._split(text.decode())
                split.append("\n")
            if len(self.known) > KNOWN:
                self.known.clear()
            new = list(set(split).difference(self.known, "\n"))
            self._learn(new)
            self.known["\n"] = _GAP
            for (first, _), ids in zip(some, b"".join(map(self.known.__getitem__, split)).split(_GAP)):
                if first:
                    out.append([ids])
                else:
                    out[-1].append(ids)
            for p in new:
                if len(p) > LONG_PART:
                    del self.known[p]
        return [b"".join(x) for x in out]

    @staticmethod
    def _cut(texts: list[bytes]) -> Iterator[list[tuple[bool, bytes]]]:
        """About ``PART`` bytes at a time: texts, or parts of a long one that
        end before a white space; the flag marks a text's first part."""
        some, size = [], 0
        for text in texts:
            at, first = 0, True
            while first or at < len(text):
                to = min(at + PART, len(text))
                while to < len(text) and not flat.WHITE[text[to]]:
                    to += 1
                some.append((first, text[at:to]))
                size += to - at
                at, first = to, False
                if size >= PART:
                    yield some
                    some, size = [], 0
        if some:
            yield some


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            for i, j, d, o in flat.slices(data, offs):
                raw = d.tobytes()
                row, piece, start, ids = [], [], [], []
                for r, own in enumerate(encoder.ids([raw[a:b] for a, b in zip(o, o[1:])])):
                    own += end
                    for n, at in enumerate(range(0, len(own), 4 * capacity)):
                        row.append(i + r)
                        piece.append(n)
                        start.append(at // 4)
                        ids.append(own[at:at + 4 * capacity])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])
    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids)`` of ``docs(doc_id, text)``: the
    token ids (little-endian unsigned 32-bit) of every text and an end id, cut
    where they exceed ``capacity``. A null text is empty and gives the end id;
    rows without an id keep a null one; a repeated row gives its pieces as
    often; other columns are ignored; an empty table gives no rows. A very
    long text is encoded a part at a time."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_cut(path or default_path(), capacity, end_id), "doc_id long, piece int, start long, length long, ids binary")


class Bins:
    """Open bins of one task."""

    def __init__(self, first_id: int, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.next_id, self.mask, self.count = first_id, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity)]   # by free space

    def _take(self, free: int) -> int:
        bin_id = self.at[free].pop()
        if not self.at[free]:
            self.mask ^= 1 << free
        self.count -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of an item; ``length`` is at most the capacity."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.count == self.most:   # the fullest closes
                self._take((self.mask & -self.mask).bit_length() - 1)
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            self.at[left].append(bin_id)
            self.mask |= 1 << left
            self.count += 1
        return bin_id, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """``(bin, tokens)`` of the bins that are still open."""
        return [(b, self.capacity - free) for free, bins in enumerate(self.at) for b in bins]


def _placed(capacity: int, most: int, level: int):
    """Place the rows of a group; an open bin that is left at the group's end
    becomes a row without a ``key``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, part, none = None, -1, None

        def row(part_, key, length, where):
            n = len(where)
            return pa.RecordBatch.from_arrays([
                pa.array([part_] * n, pa.int64()), key, length, pa.array([w[0] for w in where], pa.int64()),
                pa.array([w[1] for w in where], pa.int64())], names=["part", "key", "length", "bin", "offset"])

        def ended():
            left = bins.left()
            return row(part, pa.nulls(len(left), none), pa.array([x[1] for x in left], pa.int64()), [(b, 0) for b, _ in left])

        for batch in batches:
            none = batch.column("key").type
            parts = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if part != parts[a]:
                    if bins is not None:
                        yield ended()
                    part = int(parts[a])
                    bins = Bins((level << 56) + (part << 24), capacity, most)
                some = batch.slice(a, b - a)
                yield row(part, some.column("key"), some.column("length"), [bins.place(n) for n in some.column("length").to_pylist()])
        if bins is not None:
            yield ended()
    return run


def _pack_level(items: DataFrame, count: int, level: int, capacity: int, most: int, group: int) -> tuple[DataFrame, int]:
    """Staged rows of ``_placed`` for ``items(key, length)``, and how many
    groups there were."""
    groups = -(-count // group)
    order = F.xxhash64("key")
    dealt = items.repartition(groups).withColumn("part", F.spark_partition_id().cast("long")).sortWithinPartitions("part", order, "key", "length")
    kind = dict(items.dtypes)["key"]
    out = dealt.select("part", "key", "length").mapInArrow(_placed(capacity, most, level), f"part long, key {kind}, length long, bin long, offset long")
    return stage(out, "packed"), groups


def pack(items: DataFrame, capacity: int = CAPACITY, most: int = OPEN, group: int = GROUP) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: every row of ``length``
    1 to ``capacity`` has its place in a sequence; the items of a sequence lie
    one after the other from 0. Rows that are the same in all columns get
    places of their own. Nulls in other columns are kept; no rows give no
    rows; ``items`` must not have columns of the two result names."""
    names = items.columns
    items = stage(items, "items")
    rows = items.select(F.struct(*names).alias("key"), F.col("length").cast("long").alias("length"))
    placed, groups = _pack_level(rows, max(1, items.count()), 0, capacity, most, group)
    done = placed.where("key IS NOT NULL").select("key", "bin", "offset")
    level, moves = 0, None
    left = placed.where("key IS NULL").select(F.col("bin").alias("key"), "length")
    while groups > 1:
        level += 1
        again, groups = _pack_level(left, max(1, left.count()), level, capacity, most, group)
        step = again.where("key IS NOT NULL").select("key", F.col("bin").alias("to"), F.col("offset").alias("by"))
        if moves is None:
            moves = step
        else:   # bins that moved before move with the bin that holds them
            up = step.select(F.col("key").alias("to"), F.col("to").alias("to2"), F.col("by").alias("by2"))
            moves = moves.join(up, "to", "left").select("key", F.coalesce("to2", "to").alias("to"), (F.col("by") + F.coalesce("by2", F.lit(0))).alias("by"))
        left = again.where("key IS NULL").select(F.col("bin").alias("key"), "length")
    if moves is not None:
        done = done.join(moves.withColumnRenamed("key", "bin"), "bin", "left").select(
            "key", F.coalesce("to", "bin").alias("bin"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))
    return done.select(*[F.col("key")[c].alias(c) for c in names], F.col("bin").alias("sequence_id"), "offset")


def op12_bounded_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as pieces of at most 4096 tokens, packed."""
    cut = pieces(read(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
