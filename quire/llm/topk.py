"""Exact top-k inner-product search by Fagin's threshold algorithm.

Candidates are packed into blocks of ``BLOCK`` vectors. Inside a block every
dimension has its list of vectors sorted by component. A query walks the lists
from their better end (largest first for a positive weight, smallest first for
a negative one), fully scores every vector it meets and stops as soon as the
threshold, the best score any vector not yet met can have, lies below its k-th
score. A tie with the k-th score could still win by its smaller id, so the
walk goes on at equality. The k best of every block are merged by rank.

Queries travel in chunks. A block and a chunk are one unit of work, and the
units are dealt evenly over the tasks, so a task holds one block and one chunk
at a time and no task grows with the number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.tables import read

SCALE = 1024       # fixed value: components become floor(1024 * x)
K = 10             # fixed value: results per query
QUERY_STEP = 100   # fixed value: query rows have an id divisible by this
BLOCK = 8192       # vectors in a block
CHUNK = 512        # queries in a chunk
TASKS = 10_000     # most tasks
FIRST_DEPTH = 32   # list entries read in the first round; doubled every round


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with ``v = floor(scale * x)`` as longs. Null vectors and
    vectors that hold a null or non-finite component take no part; an empty
    vector takes part and scores 0 against every query."""
    inf = float("inf")
    ok = F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
    return vectors.where(ok & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("vec_id"),
        F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length; shorter vectors are filled with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lens = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = vectors.flatten().to_numpy()
    out = np.zeros((len(lens), dim), np.int64)
    col = np.arange(dim)
    out[np.repeat(np.arange(len(lens)), lens), np.concatenate([col[:n] for n in lens]) if len(lens) else col[:0]] = flat
    return out


class Block:
    """Sorted lists of one block, and the threshold walk over them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T, np.int32)  # per dimension, ascending

    def dots(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        r = self.rows[at]
        if not r.size:
            return np.zeros(len(at), np.int64)
        # float64 sums are exact below 2**53; otherwise integer arithmetic
        if float(np.abs(self.rows).max()) * float(np.abs(q).max()) * q.size < 2.0 ** 53:
            return (r.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return r @ q

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best rows but the query's own, and the depth read."""
        n = len(self.ids)
        met = np.zeros(n, bool)
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        live = np.flatnonzero(q)
        if not len(live):  # all scores are 0: only ids decide
            live = np.arange(min(1, self.rows.shape[1]))
        up = q[live] < 0
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            to = min(n, depth + step) if len(live) else n
            seen = met.copy()
            for d, a in zip(live, up):
                seen[self.order[d, depth:to] if a else self.order[d, n - to:n - depth]] = True
            if not len(live):   # vectors without components
                seen[:] = True
            new = np.flatnonzero(seen & ~met)
            met = seen
            new = new[self.ids[new] != own]
            best_id = np.concatenate([best_id, self.ids[new]])
            best = np.concatenate([best, self.dots(new, q)])
            keep = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[keep], best[keep]
            depth, step = to, step * 2
            if len(best) == k and depth < n:
                at = np.where(up, depth - 1, n - depth)
                edge = self.rows[self.order[live, at], live]
                if int((edge * q[live]).sum()) < int(best[-1]):
                    break
        return best_id, best, depth


RESULT = "query_id long, vec_id long, score long"


def _walk(k: int):
    """Rows of one unit arrive together, the block before the query chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = ids = rows = block = None
        dim = -1
        for batch in batches:
            for i in range(batch.num_rows):
                key, is_query = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                own_ids = batch.column(2).slice(i, 1).flatten().to_numpy()
                own = batch.column(3).slice(i, 1).flatten()
                if not is_query:
                    at, ids, rows, block, dim = key, own_ids, own, None, -1
                    continue
                if at != key:  # no candidate fell into this block
                    continue
                need = max(_longest(own), _longest(rows))
                if block is None or need > dim:
                    dim, block = need, Block(ids, _matrix(rows, need))
                got = [block.top(q, o, k) for q, o in zip(_matrix(own, dim), own_ids)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own_ids, [len(g[0]) for g in got])),
                    pa.array(np.concatenate([g[0] for g in got])),
                    pa.array(np.concatenate([g[1] for g in got]))], names=["query_id", "vec_id", "score"])
    return run


def _longest(vectors: pa.Array) -> int:
    return int(np.diff(vectors.offsets.to_numpy()).max()) if len(vectors) else 0


def _packed(df: DataFrame, groups: int) -> DataFrame:
    """``(part, ids, rows)``: the rows dealt into ``groups`` even lists."""
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return df.select(part.alias("part"), F.struct("vec_id", "v").alias("s")).groupBy("part").agg(
        F.collect_list("s").alias("s")).select("part", F.col("s.vec_id").alias("ids"), F.col("s.v").alias("rows"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries(vec_id,
    v)`` its ``k`` highest integer inner products over ``vectors(vec_id, v)``
    without rows of its own id; all rows if there are fewer; ties to the
    smaller id. Missing components of shorter vectors count as 0. A repeated
    candidate row counts as often as it occurs; of a query id with several
    vectors the smallest vector asks. Empty tables give no rows.
    """
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-vectors.count() // block))
    chunks = max(1, -(-queries.count() // chunk))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    unit = lambda b, c: (F.col(b) * F.lit(chunks) + F.col(c)).alias("unit")
    sent = _packed(queries, chunks).withColumn("block", every(blocks)).select(unit("block", "part"), F.lit(True).alias("is_query"), "ids", "rows")
    dealt = _packed(vectors, blocks).withColumn("chunk", every(chunks)).select(unit("part", "chunk"), F.lit(False).alias("is_query"), "ids", "rows")
    tasks = min(blocks * chunks, TASKS)
    both = dealt.unionByName(sent).repartitionById(tasks, (F.col("unit") % tasks).cast("int")).sortWithinPartitions("unit", "is_query")
    hits = both.mapInArrow(_walk(k), RESULT)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every 100th vector over all vectors."""
    v = quantised(read(spark, sf_dir, "embeddings"))
    return top_k(v, v.where(F.col("vec_id") % QUERY_STEP == 0))
