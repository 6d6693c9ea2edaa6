"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers in a row count tokens without building any:

1. the pre-tokenizer automaton of ``pretoken`` (chunk state maps, composed by
   a parallel prefix scan) marks where the pieces of a text start;
2. the *merge transducer* reads the bytes of a piece. Its state is all that
   later bytes can depend on, and each transition is annotated with the change
   of the number of tokens that the piece read so far encodes to.

The second one rests on a property of byte-pair encoding: every prefix of a
piece has one last token, and a token may follow another exactly if the two
encode to themselves side by side. So the last token after a byte is the one
vocabulary entry that ends there and is compatible with the last token at the
place where it starts. Only places within the longest suffix that some longer
token could still extend matter; their last tokens and relative counts are the
state. States and transitions are compiled when first needed and kept per
worker; a full table is dropped and compiled anew, so memory is bounded and
results do not change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import flat, vocab
from quire.llm.bpe import distinct
from quire.llm.pretoken import pieces
from quire.llm.tables import read

LIMIT = 1024          # fixed value: texts above it are over the limit
NEVER = 1 << 40
MAX_STATES = 250_000  # compiled states a worker keeps


class MergeTransducer:
    """Lazily compiled transducer from bytes to changes of the token count."""

    def __init__(self, v: vocab.Vocab, max_states: int = MAX_STATES):
        self.v, self.max_states = v, max_states
        self.grows = {b[:i] for b in v.id_of for i in range(1, len(b))}
        self.parts = {v.into_of[r]: (p, r) for p, r in v.rank_of.items()}
        self.right: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        for (left, right), r in v.rank_of.items():
            part = v.bytes_of[right]
            self.right.setdefault((left, part[0]), []).append((r, part))
            self.right.setdefault((left, -1), []).append((r, part))
        self.alike: dict[tuple[int, bytes], int] = {}
        self.first: dict[tuple, int] = {}
        self.pair: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: dict = {}
        self.keys: list = []
        self.column = np.full(256, -1, np.int64)
        self.columns = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.delta = np.zeros((1024, 64), np.int8)
        self._state((b"", ((-1, 0),)))

    def _state(self, key) -> int:
        at = self.states.get(key)
        if at is None:
            at = self.states[key] = len(self.keys)
            self.keys.append(key)
            if at >= len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)])
        return at

    def _encodes(self, *ids: int) -> bool:
        """Whether the tokens side by side encode to themselves."""
        v = self.v
        sym = [v.byte_id_list[b] for b in b"".join(v.bytes_of[i] for i in ids)]
        while len(sym) > 1:
            rank, at = min((v.rank_of.get(p, NEVER), i) for i, p in enumerate(zip(sym, sym[1:])))
            if rank == NEVER:
                break
            sym[at:at + 2] = [v.into_of[rank]]
        return sym == list(ids)

    def _follows(self, left: int, token: int) -> bool:
        if left < 0:
            ok = self.whole.get(token)
            if ok is None:
                ok = self.whole[token] = self._encodes(token)
        else:
            ok = self.pair.get((left, token))
            if ok is None:
                ok = self.pair[left, token] = self._encodes(left, token)
        return ok

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and change of the count for one byte read in ``state``."""
        body, places = self.keys[state]
        body = body + bytes([byte])
        for k in range(len(body)):
            token = self.v.id_of.get(body[k:])
            if token is not None and places[k] and self._follows(places[k][0], token):
                break
        count = places[k][1] + 1
        kept = [(self._like(p[0], body[k:]), p[1] - count) if p and body[k:] in self.grows else None
                for k, p in enumerate(places)]
        k = 0
        while k < len(kept) and kept[k] is None:
            k += 1
        return self._state((body[k:], (*kept[k:], (self._like(token, b""), 0)))), count

    def _like(self, token: int, body: bytes) -> int:
        """The first token met that no following token which starts with
        ``body`` can tell from this one.

        What follows touches a token through its right edge only: the token,
        its right part, that one's right part and so on, each from its own
        merge until the merge that absorbs it. Two tokens whose edges meet the
        same merges within these times are alike.
        """
        out = self.alike.get((token, body))
        if out is None:
            edge, at, until = [body], token, NEVER
            while at >= 0:
                met = [r for r, part in self.right.get((at, body[0] if body else -1), ())
                       if r < until and (part.startswith(body) or body.startswith(part))]
                if met:
                    edge.append((at, len(met)))
                if at not in self.parts:
                    break
                (_, at), until = self.parts[at]
            else:
                edge.append(token)
            out = self.alike[token, body] = self.first.setdefault(tuple(edge), token)
        return out

    def _fill(self, state: np.ndarray, byte: np.ndarray) -> None:
        for b in np.unique(byte[self.column[byte] < 0]):
            self.column[b] = self.columns
            self.columns += 1
            if self.columns > self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)], 1)
                self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)], 1)
        col = self.column[byte]
        for key in np.unique((state * 256 + byte)[self.next[state, col] < 0]).tolist():
            s, b = divmod(key, 256)
            to, change = self._compile(s, b)
            self.next[s, self.column[b]], self.delta[s, self.column[b]] = to, change

    def count(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Tokens of many pieces whose bytes lie one after the other."""
        if len(self.keys) > self.max_states:
            self.clear()
        order = np.argsort(-lens, kind="stable")
        at, size = (np.cumsum(lens) - lens)[order], lens[order]
        alive = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
        total, state = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
        for i, n in enumerate(alive.tolist()):
            byte = data[at[:n] + i].astype(np.int64)
            col, s = self.column[byte], state[:n]
            to = self.next[s, col]
            if (to < 0).any() or (col < 0).any():
                self._fill(s, byte)
                col = self.column[byte]
                to = self.next[s, col]
            total[:n] += self.delta[s, col]
            state[:n] = to
        out = np.empty(len(lens), np.int64)
        out[order] = total
        return out


_TRANSDUCERS: dict[str, MergeTransducer] = {}


def _transducer(path: str) -> MergeTransducer:
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = MergeTransducer(vocab.load(path))
    return _TRANSDUCERS[path]


def count_flat(t: MergeTransducer, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Tokens of every flat text."""
    s, e, special = pieces(data, offs, t.v.special)
    n = np.ones(len(s), np.int64)  # a special string is one token
    plain = ~special
    if plain.any():
        body, lens, number = distinct(data, s[plain], e[plain])
        n[plain] = t.count(body, lens)[number]
    total = np.concatenate([[0], np.cumsum(n)])
    return np.diff(total[np.searchsorted(s, offs)])


RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _run(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _transducer(path)
        for batch in batches:
            data, offs = flat.buffer_of(batch.column("text"))
            for i, j, d, o in flat.slices(data, offs):
                n = count_flat(t, d, o)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.diff(o)), pa.array(n), pa.array(n > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id,
    text)``. A null text counts as empty: 0 bytes, 0 tokens. Null ids stay
    null, repeated rows stay repeated, other columns are ignored, an empty
    table gives no rows."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _run(path or vocab.default_path(), limit), RESULT)


def op3_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    return token_counts(read(spark, sf_dir, "documents"))
