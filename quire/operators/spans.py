"""Sums over the postings of a span, and the best of them, inside a task.

Ranking and similarity both add up ``weight(query, term) * part(term, doc)``
over the terms a query and a document share. Spark deals the posting blocks of
the queries' terms by span and sorts them; a task then takes one span at a time
and adds its postings into a small table of queries x ids with numpy, so there
is neither a row nor a hash entry for every query, term and document. When only
the best ``k`` of a query are wanted, a task keeps no more than these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.index import SPAN
from quire.session import BROADCAST_MAX_ROWS

# Ranking key precision: scores are compared after rounding to this many
# decimals so that summation order cannot reorder equal documents.
RANK_DECIMALS = 9
QUERIES = 256      # queries that are added up together
PAIRS = 1 << 20    # postings x queries that are added up together, about
LISTED = 100_000   # queries of a term in one list, about
PENDING = 1 << 18  # rows a task collects before it cuts them to the best

#: ``parts(tf, dl, p)``: what a query's weight is multiplied by, one array for each run
Parts = Callable[[np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


def rank_key(score):
    """The ranking key of a score column, by the same arithmetic as in ``_Best``."""
    return F.rint(score * F.lit(10.0 ** RANK_DECIMALS))


class _Best:
    """The first ``k`` rows ``(run, query, doc, score)`` of every run and query
    by ranking key (a missing score is last), then by document."""

    def __init__(self, k: int):
        self.k, self.held, self.rows, self.at = k, [], 0, {}
        self.least = np.zeros((2, 0))   # key and document of the k-th row so far, by run and query

    def _slots(self, run: int, queries: np.ndarray) -> np.ndarray:
        slots = np.array([self.at.setdefault((run, q), len(self.at)) for q in queries.tolist()], np.int64)
        if len(self.at) > self.least.shape[1]:
            more = np.array([[-np.inf], [np.inf]]).repeat(2 * len(self.at) - self.least.shape[1], axis=1)
            self.least = np.hstack([self.least, more])
        return slots

    def add(self, run: int, queries: np.ndarray, row: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        """Rows of ``queries[row]``."""
        slot = self._slots(run, queries)[row]
        key = np.rint(score * 10.0 ** RANK_DECIMALS)
        key[np.isnan(key)] = -np.inf
        least, last = self.least[0][slot], self.least[1][slot]
        keep = np.flatnonzero((key > least) | ((key == least) & (doc < last)))
        if len(keep):
            self.held.append((np.full(len(keep), run), slot[keep], queries[row[keep]], doc[keep], key[keep], score[keep]))
            self.rows += len(keep)
            if self.rows > PENDING:
                self._cut()

    def _cut(self) -> None:
        cols = [np.concatenate(c) for c in zip(*self.held)]
        order = np.lexsort((cols[3], -cols[4], cols[1]))
        slot = cols[1][order]
        first = np.searchsorted(slot, slot)
        order = order[np.arange(len(slot)) - first < self.k]
        self.held = [tuple(c[order] for c in cols)]
        _, slot, _, doc, key, _ = self.held[0]
        ends = np.flatnonzero(np.append(np.diff(slot) != 0, True))
        full = ends[np.diff(ends, prepend=-1) == self.k]
        self.least[0][slot[full]], self.least[1][slot[full]] = key[full], doc[full]
        self.rows = 0

    def taken(self) -> tuple[np.ndarray, ...] | None:
        if not self.held:
            return None
        self._cut()
        run, _, query, doc, _, score = self.held[0]
        return run, query, doc, score


def _flat(col: pa.ChunkedArray) -> np.ndarray:
    return pa.concat_arrays([c.flatten() for c in col.chunks]).to_numpy(zero_copy_only=False) if col.num_chunks else np.zeros(0)


def _sizes(col: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[c.value_lengths().to_numpy(zero_copy_only=False) for c in col.chunks]]).astype(np.int64)


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``, ``size[i]`` numbers for every i."""
    return np.arange(size.sum()) + np.repeat(first - _starts(size), size)


def _span_sums(rows: pa.Table, parts: Parts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """``(queries, row, doc, sums)`` for the posting blocks of one span: the
    sums of every pair of a query (``queries[row]``) and a document that have
    a term in common, one array for each run."""
    n, asked = _sizes(rows["docs"]), _sizes(rows["queries"])
    if not len(n):
        return
    docs, tf, dl = (_flat(rows[c]) for c in ("docs", "tfs", "dls"))
    part = parts(tf.astype(float), dl.astype(float), np.repeat(rows["p"].to_numpy(), n))
    base = int(docs[0]) // SPAN * SPAN
    place, first = docs - base, _starts(n)
    query, weight = _flat(rows["queries"]), _flat(rows["ws"])
    block = np.repeat(np.arange(len(n)), asked)
    names, at = np.unique(query, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, weight, block = at[order], weight[order], block[order]
    for q in range(0, len(names), QUERIES):
        lo, hi = np.searchsorted(at, [q, q + QUERIES])
        some = names[q:q + QUERIES]
        cells = len(some) * SPAN
        met, sums = np.zeros(cells, bool), [np.zeros(cells) for _ in part]
        size = n[block[lo:hi]]
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // PAIRS, prepend=-1) != 0)
        for i, j in zip(cuts, np.append(cuts[1:], hi - lo)):
            take = slice(lo + i, lo + j)
            posting = _spread(first[block[take]], size[i:j])
            cell = np.repeat(at[take] - q, size[i:j]) * SPAN + place[posting]
            w = np.repeat(weight[take], size[i:j])
            met[cell] = True
            for s, x in zip(sums, part):
                s += np.bincount(cell, w * x[posting], cells)
        got = np.flatnonzero(met)
        yield some, got // SPAN, got % SPAN + base, [s[got] for s in sums]


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one unit after the other, from rows sorted by unit."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column("unit").to_numpy()
        cuts = np.flatnonzero(np.diff(unit) != 0) + 1
        if held and held[-1].column("unit")[0].as_py() != unit[0]:
            yield pa.Table.from_batches(held)
            held = []
        for i, j in zip([0, *cuts], [*cuts, len(unit)]):
            if i:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _runner(parts: Parts, k: int | None, by_norm: bool, apart: bool):
    def batch(run, query, doc, score):
        score = pa.array(score, mask=np.isnan(score))
        return pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(query, pa.int64()), pa.array(doc, pa.int64()), score],
                                          names=["run", "query_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None if k is None else _Best(k)
        for rows in _by_unit(batches):
            if by_norm:
                asked = _sizes(rows["queries"]) > 0
                told = rows.filter(pa.array(~asked))
                rows = rows.filter(pa.array(asked))
                norms = np.full(SPAN, np.nan)
                norms[_flat(told["docs"]).astype(np.int64) % SPAN] = _flat(told["ws"])
            for queries, row, doc, sums in _span_sums(rows, parts):
                if apart:
                    other = np.flatnonzero(queries[row] != doc)
                    row, doc, sums = row[other], doc[other], [s[other] for s in sums]
                for r, s in enumerate(sums):
                    if by_norm:
                        norm = norms[doc % SPAN]
                        s = np.divide(s, norm, out=np.full(len(s), np.nan), where=norm != 0)
                    if best is not None:
                        best.add(r, queries, row, doc, s)
                    elif len(s):
                        yield batch(np.full(len(s), r), queries[row], doc, s)
        if best is not None and (got := best.taken()) is not None:
            yield batch(*got)
    return run


def span_sums(blocks: DataFrame, weights: DataFrame, parts: Parts, k: int | None = None, norms: DataFrame | None = None,
              unit: str = "span", apart: bool = False) -> DataFrame:
    """``(run, query_id, doc_id, score)`` of every query and document that
    share a term, for each run of ``parts``.

    ``blocks`` are posting blocks ``(unit, term, docs, tfs, dls)``, ``weights``
    is ``(query_id, term, _w, _p)`` with one ``_p`` a term. What is added up
    has its ``unit``, a span or a block, in common. With ``k`` only rows that
    can be among the first ``k`` of their run and query by ``rank_key`` and
    document are returned: at most ``k`` a task. ``norms``, rows ``(unit, docs,
    norms)``, divide the sums by a document's norm; by a norm of 0 gives null.
    With ``apart`` a document does not meet the query of its own id.
    """
    n = weights.count()
    few = n <= BROADCAST_MAX_ROWS   # all that is joined has at most a row per weight
    side = F.broadcast if few else lambda df: df
    lists = F.pmod(F.xxhash64("query_id"), F.lit(1 + n // LISTED))
    asked = weights.groupBy("term", lists.alias("list")).agg(F.collect_list(F.struct("query_id", "_w")).alias("a"), F.first("_p").alias("p"))
    asked = side(asked.select("term", F.col("a.query_id").alias("queries"), F.col("a._w").alias("w"), "p"))
    rows = blocks.join(side(weights.select("term")), "term", "left_semi").select(F.col(unit).alias("unit"), "term", "docs", "tfs", "dls")
    if not few:   # joined on term, so before the rows are dealt
        rows = rows.join(asked, "term")
    if norms is not None:
        rows = rows.unionByName(norms.select(F.col(unit).alias("unit"), "docs", F.col("norms").alias("own")), allowMissingColumns=True)
    rows = rows.repartition("unit")
    if few:
        rows = rows.join(asked, "term", "left")
    none = F.array().cast("array<long>")
    ws = F.col("w") if norms is None else F.coalesce("own", "w")
    rows = rows.select("unit", "docs", *[F.coalesce(c, none).alias(c) for c in ("tfs", "dls", "queries")], ws.alias("ws"), F.coalesce("p", F.lit(1.0)).alias("p"))
    return rows.sortWithinPartitions("unit").mapInArrow(_runner(parts, k, norms is not None, apart), "run int, query_id long, doc_id long, score double")
