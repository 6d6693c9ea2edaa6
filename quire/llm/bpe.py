"""BPE encoding and decoding by batched merge rounds.

The distinct pieces of a slice of documents lie in one flat symbol array. A
round looks up every changed neighbour pair by binary search in the sorted
pair keys of the vocabulary, takes the lowest rank of every piece
(segment-wise minimum) and merges all its non-overlapping occurrences from the
left. Pieces without a mergeable pair leave the array, so later rounds touch
only the long ones. Decoding gathers the bytes of the ids from one flat table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat, vocab
from quire.llm.pretoken import pieces
from quire.llm.tables import read

NONE = np.int64(1 << 40)


def _ranks(v: vocab.Vocab, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and row of every pair in the sorted keys; ``NONE`` if not there."""
    key = left * v.size + right
    at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
    return np.where(v.keys[at] == key, v.rank[at], NONE), at


def merge_rounds(v: vocab.Vocab, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many pieces: flat ids and the number of ids per piece.
    ``data`` holds the bytes of the pieces one after the other."""
    sym = v.byte_id[data]
    piece = np.repeat(np.arange(len(lens)), lens)
    done_piece, done_sym = [], []
    n = len(sym)
    rank, row = np.full(n, NONE), np.zeros(n, np.int64)
    inner = np.flatnonzero(piece[:-1] == piece[1:]) if n else np.zeros(0, np.int64)
    rank[inner], row[inner] = _ranks(v, sym[inner], sym[inner + 1])
    while len(sym):
        first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
        size = np.diff(np.append(first, len(sym)))
        low = np.minimum.reduceat(rank, first)
        open_ = np.repeat(low < NONE, size)
        if not open_.all():
            done_piece.append(piece[~open_])
            done_sym.append(sym[~open_])
            sym, piece, rank, row = sym[open_], piece[open_], rank[open_], row[open_]
            if not len(sym):
                break
            low, size = low[low < NONE], size[low < NONE]
        hit = np.flatnonzero(rank == np.repeat(low, size))
        # neighbours that overlap (a run of one symbol): every second, from the left
        if len(hit) > 1:
            new = np.concatenate([[True], np.diff(hit) > 1])
            at = np.arange(len(hit))
            hit = hit[(at - np.maximum.accumulate(np.where(new, at, 0))) % 2 == 0]
        sym[hit] = v.into[row[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        moved = hit - np.arange(len(hit))  # where the merged symbols are afterwards
        sym, piece, rank, row = sym[keep], piece[keep], rank[keep], row[keep]
        again = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
        rank[again] = NONE
        again = again[again < len(sym) - 1]
        again = again[piece[again] == piece[again + 1]]
        rank[again], row[again] = _ranks(v, sym[again], sym[again + 1])
    if not done_piece:
        return np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
    piece, sym = np.concatenate(done_piece), np.concatenate(done_sym)
    order = np.argsort(piece, kind="stable")
    return sym[order], np.bincount(piece, minlength=len(lens))


ROLL = flat.Rolling()


def distinct(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and lengths of the distinct spans, and the number of each span."""
    h = ROLL.ranges(ROLL.prefix(data), s, e)
    _, one, number = np.unique(h, return_index=True, return_inverse=True)
    lens = (e - s)[one]
    return data[flat.span_index(s[one], lens)], lens, number


def encode_flat(v: vocab.Vocab, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of flat texts and the ``rows + 1`` offsets of the texts in them."""
    s, e, special = pieces(data, offs, v.special)
    ids, lens, number = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(s), np.int64)
    plain = ~special
    if plain.any():
        body, body_lens, number[plain] = distinct(data, s[plain], e[plain])
        ids, lens = merge_rounds(v, body, body_lens)
    if special.any():
        number[special] = len(lens)
        ids, lens = np.append(ids, v.special_id), np.append(lens, 1)
    at = np.cumsum(lens) - lens
    n = lens[number] if len(number) else number
    out = ids[flat.span_index(at[number], n)] if len(number) else ids
    total = np.concatenate([[0], np.cumsum(n)])
    return out, total[np.searchsorted(s, offs)]


def decode_flat(v: vocab.Vocab, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of flat id lists and the offsets of the lists in them."""
    n = v.token_len[ids]
    total = np.concatenate([[0], np.cumsum(n)])
    return v.token_bytes[flat.span_index(v.token_at[ids], n)], total[offs]


def _texts(v: vocab.Vocab, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """Texts of flat id lists; what is no UTF-8 becomes the replacement character."""
    body, to = decode_flat(v, ids, at)
    raw = body.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(to[:-1], to[1:])]


def _encode(path: str, keep: list[str], text: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.load(path)
        for batch in batches:
            data, offs = flat.buffer_of(batch.column(text))
            for i, j, d, o in flat.slices(data, offs, flat.SLICE_BYTES // 2):
                ids, at = encode_flat(v, d, o)
                new = {"ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))}
                if decoded:
                    new["decoded"] = pa.array(_texts(v, ids, at), pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in keep), *new.values()], names=[*keep, *new])
    return run


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """``docs`` with a column ``ids`` (token ids of the whole text) beside the
    columns ``keep`` (all but ``ids`` by default), and with ``decoded`` the
    text that the ids decode to, in the same pass. A null or empty text has no
    ids; repeated rows stay repeated; an empty table gives no rows."""
    keep = [c for c in docs.columns if c not in ("ids", "decoded")] if keep is None else keep
    src = docs.select(*dict.fromkeys([*keep, text]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep)
    more = ", decoded string" if decoded else ""
    return src.mapInArrow(_encode(path or vocab.default_path(), keep, text, decoded), f"{fields}, ids array<int>{more}")


def _decode(path: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = part.column("ids").fill_null([])
                lens = np.diff(ids.offsets.to_numpy()).astype(np.int64)
                texts = _texts(v, ids.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(lens)]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "decoded"])
    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids`` (null: empty);
    bytes that are no UTF-8 become the replacement character."""
    keep = [c for c in encoded.columns if c != "decoded"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name in keep)
    return encoded.mapInArrow(_decode(path or vocab.default_path(), keep), f"{fields}, decoded string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.load(path)
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            for i, j, d, o in flat.slices(data, offs):
                ids, at = encode_flat(v, d, o)
                body, to = decode_flat(v, ids, at)
                small, raw = ids.astype("<u4"), body.tobytes()
                sha_ids = [hashlib.sha256(small[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
                texts = (raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(to[:-1], to[1:]))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at)), pa.array(sha_ids, pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encodes
    the whole text and decodes the ids again in one pass. Null is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _digest(path or vocab.default_path()), DIGEST)


def op4_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded."""
    return round_trip(read(spark, sf_dir, "documents"))
