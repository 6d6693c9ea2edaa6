"""K-means over sparse vectors ``points(doc_id, term, w)``.

Centroids are rows ``(cluster, term, w)`` (clusters numbered 0..k-1).
Distances use ||p||^2 - 2 p.c + ||c||^2 (clamped at 0 before the root). Inside
the loop the points' elements are cells of a part of the terms and a chunk of
the points (``_Grid``), stored once as arrays; a step moves the dot products of
points and cells and the parts of the centroids, and the centroids' sums
change by the points that changed their cluster. The driver only loops and
reads k rows per step; memberships and centroids are written to cut the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import BROADCAST_MAX_ROWS, bounded_broadcast, materialize, written

RANK_DECIMALS = 9
# Two centroid weights closer than this count as equal (unchanged centroid).
SAME_WEIGHT = 1e-12
PART_TERMS = 1 << 18    # terms of a part of the centroids, about
CHUNK_POINTS = 8192     # points of a chunk, about
SENT_PARTS = 4          # parts of the centroids that are broadcast, at most
HEAD = -1               # the chunk of a lane's head, the row that brings the centroids


def init_points(points: DataFrame, k: int) -> DataFrame:
    """The first ``k`` points by ``doc_id`` as the starting centroids."""
    firsts = points.select("doc_id").distinct().orderBy("doc_id").limit(k)
    firsts = firsts.withColumn("cluster", (F.row_number().over(Window.orderBy("doc_id")) - 1).cast("int"))
    return points.join(F.broadcast(firsts), "doc_id").select("cluster", "term", "w")


def _first_points(vectors: DataFrame, k: int) -> DataFrame:
    """``init_points`` of the rows of ``as_vectors``."""
    firsts = vectors.select("doc_id").orderBy("doc_id").limit(k)
    firsts = firsts.withColumn("cluster", (F.row_number().over(Window.orderBy("doc_id")) - 1).cast("int"))
    return vectors.join(F.broadcast(firsts), "doc_id").select("cluster", F.inline("v"))


def init_box(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` centroids drawn uniformly in the per-term [min, max] box of the
    points (a term absent from a point counts as 0 there). The draw of a
    weight is the hash of its term, cluster and seed, so it does not depend on
    how the points are partitioned."""
    n_points = points.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    box = points.groupBy("term").agg(F.min("w").alias("lo"), F.max("w").alias("hi"), F.count(F.lit(1)).alias("cnt"))
    lo = F.when(F.col("cnt") < n_points, F.least(F.col("lo"), F.lit(0.0))).otherwise(F.col("lo"))
    hi = F.when(F.col("cnt") < n_points, F.greatest(F.col("hi"), F.lit(0.0))).otherwise(F.col("hi"))
    grid = box.select("term", lo.alias("lo"), hi.alias("hi"),
                      F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster"))
    digest = F.md5(F.concat_ws("|", "term", F.col("cluster").cast("string"), F.lit(str(seed))))
    u = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)
    out = grid.select("cluster", "term", (u * (F.col("hi") - F.col("lo")) + F.col("lo")).alias("w"))
    return out.where(F.col("w") != 0)


def _distances(vectors: DataFrame, centroids: DataFrame, cc: Sequence[float], clusters: Sequence[int]) -> DataFrame:
    """``(doc_id, nearest)`` for rows ``(doc_id, pp, v)``, v being the array
    of ``(term, w)`` and pp the squared norm: the clusters as an array of
    ``(r, cluster, dist)``, nearest first (r is the rounded distance, so ties go
    to the lowest cluster). ``centroids`` is ``(term, ws)``, one row per term
    with its weight in every cluster; ``cc`` are the squared norms.
    """
    rows = vectors.select("doc_id", F.inline("v"))
    wide = centroids.select("term", "ws")
    met = rows.join(bounded_broadcast(wide), "term")
    met = met.select("doc_id", "w", F.posexplode("ws").alias("cluster", "cw")).where("cw <> 0")
    dots = met.groupBy("doc_id", "cluster").agg(F.sum(F.col("w") * F.col("cw")).alias("dot"))
    dots = dots.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "dot"))).alias("dots"))   # at most k
    # points that share no term with any centroid have no dots
    per = vectors.select("doc_id", "pp").join(dots, "doc_id", "left")
    norm = F.array(*[F.struct(F.lit(j).alias("cluster"), F.lit(float(cc[j])).alias("cc")) for j in clusters])

    def of(x):
        dot = F.coalesce(F.try_element_at(F.col("dots"), x["cluster"]), F.lit(0.0))
        dist = F.sqrt(F.greatest(F.col("pp") - 2 * dot + x["cc"], F.lit(0.0)))
        return F.struct(F.round(dist, RANK_DECIMALS).alias("r"), x["cluster"].alias("cluster"), dist.alias("dist"))

    return per.select("doc_id", F.array_sort(F.transform(norm, of)).alias("nearest"))


def as_vectors(points: DataFrame) -> DataFrame:
    """``(doc_id, pp, v)``: one row per point."""
    return points.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("pp"), F.collect_list(F.struct("term", "w")).alias("v"))


def wide_centroids(centroids: DataFrame, k: int) -> DataFrame:
    """``(term, ws)``: one row per term with its weight in every cluster."""
    per = centroids.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("cluster", "w"))).alias("m"))   # at most k
    return per.select("term", _by_cluster(k, lambda j: F.coalesce(F.try_element_at("m", j), F.lit(0.0))).alias("ws"))


def _by_cluster(k: int, value) -> F.Column:
    """An array with ``value(cluster)`` for every cluster."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), value)


def _norms(wide: DataFrame, k: int) -> list[float]:
    """Squared norms of the k centroids (k rows are read back)."""
    rows = wide.select(F.posexplode("ws").alias("cluster", "w"))
    got = {r.cluster: r.cc for r in rows.groupBy("cluster").agg(F.sum(F.col("w") * F.col("w")).alias("cc")).collect()}
    return [got.get(j, 0.0) for j in range(k)]


def assign(points: DataFrame, centroids: DataFrame, k: int, clusters: Sequence[int] | None = None) -> DataFrame:
    """Nearest centroid of every point: ``(doc_id, cluster, dist)``; a tie
    goes to the lowest cluster. ``clusters`` lists the clusters that exist;
    by default those with a row in ``centroids``. A listed cluster without
    rows lies at the origin, one that is not listed takes no points."""
    if clusters is None:
        clusters = sorted(r["cluster"] for r in centroids.select("cluster").distinct().collect())  # k rows
    if not clusters:
        return points.sparkSession.createDataFrame([], "doc_id long, cluster int, dist double")
    wide = written(wide_centroids(centroids, k), "centroids")
    near = _distances(as_vectors(points), wide, _norms(wide, k), clusters)
    return near.select("doc_id", F.element_at("nearest", 1)["cluster"].alias("cluster"), F.element_at("nearest", 1)["dist"].alias("dist"))


def update(points: DataFrame, assignment: DataFrame, centroids: DataFrame) -> DataFrame:
    """New centroids: the mean of each cluster's members; an empty cluster
    keeps its centroid."""
    sizes = F.broadcast(cluster_sizes(assignment))  # at most k rows
    means = (points.join(assignment.select("doc_id", "cluster"), "doc_id")
                   .groupBy("cluster", "term").agg(F.sum("w").alias("_s"))
                   .join(sizes, "cluster")
                   .select("cluster", "term", (F.col("_s") / F.col("size")).alias("w")))
    kept = centroids.join(sizes, "cluster", "left_anti")
    return means.unionByName(kept)


def cluster_sizes(assignment: DataFrame) -> DataFrame:
    """``(cluster, size)`` of the non-empty clusters."""
    return assignment.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def status(new: DataFrame, old: DataFrame, assignment: DataFrame) -> DataFrame:
    """``(cluster, empty, changed)`` for every cluster of ``old``: empty when
    no point chose it, changed when some weight moved by more than
    ``SAME_WEIGHT``."""
    sizes = F.broadcast(cluster_sizes(assignment))
    diff = (new.withColumnRenamed("w", "w_new")
               .join(old.withColumnRenamed("w", "w_old"), ["cluster", "term"], "full")
               .where(F.abs(F.coalesce(F.col("w_new"), F.lit(0.0)) - F.coalesce(F.col("w_old"), F.lit(0.0)))
                      > SAME_WEIGHT)
               .groupBy("cluster").agg(F.count(F.lit(1)).alias("n_diff")))
    clusters = old.select("cluster").distinct()
    return (clusters.join(sizes, "cluster", "left").join(diff, "cluster", "left")
                    .select("cluster", F.col("size").isNull().alias("empty"),
                            (F.coalesce(F.col("n_diff"), F.lit(0)) > 0).alias("changed")))


def objective(assignment: DataFrame) -> DataFrame:
    """Sum of (not squared) distances of the points to their centroid."""
    return assignment.agg(F.coalesce(F.sum("dist"), F.lit(0.0)).alias("objective"))


@dataclass
class KMeansResult:
    assignment: DataFrame   # (doc_id, cluster, dist): distances to ``centroids``
    centroids: DataFrame    # (cluster, term, w)
    iterations: int

    def objective(self) -> DataFrame:
        """Sum of the points' distances to the returned centroids."""
        return objective(self.assignment)


def fit(points: DataFrame, k: int, init: str = "points", max_iter: int | None = None, seed: int = 42,
        stop: str = "stable") -> KMeansResult:
    """Lloyd iterations.

    ``stop='stable'`` ends when, in one iteration, every cluster is empty or
    kept its centroid. ``stop='once'`` ends when every cluster has at some
    iteration been empty or unchanged (a flag that is never cleared). There is
    no limit of iterations unless ``max_iter`` sets one. The result holds the
    memberships the last centroids were made of, with the distances to these
    centroids. ``k <= 0`` or no points gives empty frames.
    """
    if stop not in ("stable", "once"):
        raise ValueError("stop must be 'stable' or 'once'")
    spark = points.sparkSession
    nothing = KMeansResult(spark.createDataFrame([], "doc_id long, cluster int, dist double"),
                           spark.createDataFrame([], "cluster int, term string, w double"), 0)
    if k <= 0 or points.isEmpty():
        return nothing
    points = written(as_vectors(points.where("doc_id IS NOT NULL")), "points")
    some = points.select("doc_id", F.explode("v").alias("x")).select("doc_id", "x.term", "x.w")
    first = _first_points(points, k) if init == "points" else init_box(some, k, seed)
    grid = _Grid(points, some, k)
    clusters = list(range(min(k, grid.points) if init == "points" else k))
    c, marks = grid.centroids(first)
    cc = [marks[j].cc for j in range(k)]
    done: set[int] = set()
    mem, it = None, 0
    while max_iter is None or it < max_iter:
        it += 1
        mem = written(grid.memberships(mem, c, cc, clusters), "memberships")
        counts = mem.select(F.inline("sizes")).groupBy("cluster").agg(F.sum("size").alias("size"), F.sum("moved").alias("moved")).collect()  # k rows
        size = {r["cluster"]: r["size"] for r in counts if r["size"]}
        if it > 1 and not any(r["moved"] for r in counts):   # no centroid moves any more
            break
        c, marks = grid.moved_sums(c, mem, size)
        cc = [marks[j].cc for j in range(k)]
        settled = {j for j in clusters if j not in size or marks[j].most <= SAME_WEIGHT}
        done |= settled
        if len(settled if stop == "stable" else done) == len(clusters):
            break
    if mem is None:
        mem = written(grid.memberships(None, c, cc, clusters), "memberships")
    return KMeansResult(grid.to_own(mem, c, cc), grid.rows(c), it)


class _Grid:
    """The points' elements as cells of a part of the terms and a chunk of the
    points, each a row with arrays in compressed-row form.

    Terms are dealt to parts of some ``PART_TERMS`` and numbered there, points
    to chunks. The centroids are a row per part, with a weight per cluster and
    term. A cell gives the dot products of its points with its part of the
    centroids; a chunk adds them up over the parts. The cells are stored once,
    dealt to lanes of a part; the centroids come to them, not the reverse, once
    a lane: with its head, the row before its cells.
    """

    def __init__(self, points: DataFrame, some: DataFrame, k: int):
        spark = points.sparkSession
        cores = spark.sparkContext.defaultParallelism
        self.k = k
        self.points = points.count()
        words = written(some.select("term").distinct(), "words")
        self.parts = max(1, -(-words.count() // PART_TERMS))
        chunk_points = max(256, min(CHUNK_POINTS, -(-self.points // (4 * cores))))
        chunks = max(1, -(-self.points // chunk_points))
        self.lanes = max(1, -(-3 * cores // self.parts))
        words = words.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(self.parts)).cast("int"))
        by_term = Window.partitionBy("part").orderBy("term")
        self.terms = written(words.withColumn("tid", (F.row_number().over(by_term) - 1).cast("int")), "terms")
        by_id = Window.partitionBy("chunk").orderBy("doc_id")
        ids = points.select("doc_id", "pp", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int").alias("chunk"))
        ids = written(ids.withColumn("at", (F.row_number().over(by_id) - 1).cast("int")), "ids")
        self.chunks = written(ids.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("doc_id", "pp"))).alias("x"))
                              .select("chunk", F.col("x.doc_id").alias("ids"), F.col("x.pp").alias("pp")), "chunks")
        # points meet their places before they are taken apart; the terms are the side that is hashed
        rows = points.join(ids.select("doc_id", "chunk", "at"), "doc_id").select("chunk", "at", F.inline("v")).join(self.terms.hint("shuffle_hash"), "term")
        cells = rows.select("part", "chunk", "at", "tid", F.col("w").cast("double").alias("w")).groupBy("part", "chunk").applyInArrow(
            _cell, "part int, chunk int, at binary, tid binary, w binary")
        lane = (F.col("part") * self.lanes + F.pmod("chunk", F.lit(self.lanes))).cast("int").alias("lane")
        none = F.lit(None).cast("binary")
        heads = spark.range(self.parts * self.lanes).select(F.col("id").cast("int").alias("lane"), F.floor(F.col("id") / self.lanes).cast("int").alias("part"),
                                                            F.lit(HEAD).alias("chunk"), none.alias("at"), none.alias("tid"), none.alias("w"))
        cells = cells.select(lane, "part", "chunk", "at", "tid", "w").unionByName(heads)
        # a lane's head comes first
        self.cells = materialize(cells.repartition(self.parts * self.lanes, "lane").sortWithinPartitions("lane", "chunk"))

    def centroids(self, first: DataFrame):
        """The centroids of rows ``(cluster, term, w)``, with sums of zero."""
        near = self.terms.join(first, "term", "left").select("part", "tid", "cluster", F.col("w").cast("double").alias("w"))
        return self._marked(near.groupBy("part").applyInArrow(_first_centroids(self.k), CENTROIDS))

    def _marked(self, c: DataFrame):
        c = written(c, "centroids")
        rows = c.select(F.inline("marks")).groupBy("cluster").agg(F.max("most").alias("most"), F.sum("cc").alias("cc")).collect()  # k rows
        return c, {r.cluster: r for r in rows}

    def _dots(self, c: DataFrame) -> DataFrame:
        """``(chunk, dots)``: the products of every cell, a cluster's after the other."""
        wide = c.select(F.col("part").alias("of"), "ws")
        head = F.col("chunk") == HEAD
        if self.parts <= SENT_PARTS:
            met = self.cells.join(F.broadcast(wide), (F.col("part") == F.col("of")) & head, "left")
        else:
            dealt = wide.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(self.lanes - 1)))).select(
                (F.col("of") * self.lanes + F.col("to")).cast("int").alias("to"), "ws")
            met = self.cells.join(dealt.hint("shuffle_hash"), (F.col("lane") == F.col("to")) & head, "left")
        return met.select("chunk", "at", "tid", "w", "ws").mapInArrow(_cell_dots(self.k), "chunk int, at binary, dots binary")

    def _of_chunks(self, c: DataFrame, mem: DataFrame | None) -> DataFrame:
        """A row per chunk: its points, their memberships before, and the
        products of its cells."""
        dots = self._dots(c).groupBy("chunk").agg(F.collect_list("at").alias("ats"), F.collect_list("dots").alias("dots"))   # a row per part
        own = self.chunks.join(mem.select("chunk", "cluster"), "chunk") if mem is not None else self.chunks.withColumn("cluster", F.lit(None).cast("binary"))
        return own.join(dots, "chunk", "left")

    def memberships(self, before: DataFrame | None, c: DataFrame, cc: Sequence[float], clusters: Sequence[int]) -> DataFrame:
        """``(chunk, cluster, was, sizes)``: the nearest centroid of every point
        of a chunk and the one before (-1 at first), and for every cluster
        its points and those that came or left."""
        return self._of_chunks(c, before).mapInArrow(
            _nearest(self.k, list(cc), list(clusters)), "chunk int, cluster binary, was binary, sizes array<struct<cluster:int,size:long,moved:long>>")

    def moved_sums(self, c: DataFrame, mem: DataFrame, size: dict[int, int]):
        """New centroids: the sums change by the points that changed their
        cluster only; a cluster without points keeps its centroid."""
        moved = mem.where(F.exists("sizes", lambda x: x["moved"] > 0)).select("chunk", "cluster", "was")
        met = self.cells.join(F.broadcast(moved) if self.points <= BROADCAST_MAX_ROWS * CHUNK_POINTS else moved, "chunk")
        change = met.select("part", "at", "tid", "w", "cluster", "was").mapInArrow(_cell_changes(self.k), "part int, tids binary, sums binary")
        change = change.groupBy("part").agg(F.collect_list("tids").alias("tids"), F.collect_list("sums").alias("sums"))   # a row per task and part
        both = c.select("part", "ss", "ws").join(change, "part", "left")
        return self._marked(both.mapInArrow(_new_centroids(self.k, dict(size)), CENTROIDS))

    def to_own(self, mem: DataFrame, c: DataFrame, cc: Sequence[float]) -> DataFrame:
        """``(doc_id, cluster, dist)`` with the distance to the own centroid."""
        return self._of_chunks(c, mem).mapInArrow(_own_distances(self.k, list(cc)), "doc_id long, cluster int, dist double")

    def rows(self, c: DataFrame) -> DataFrame:
        """``(cluster, term, w)`` of the weights that are not zero."""
        cells = c.select("part", "ws").mapInArrow(_weights(self.k), "part int, tid int, cluster int, w double")
        return cells.join(self.terms, ["part", "tid"]).select("cluster", "term", "w")


CENTROIDS = "part int, ss binary, ws binary, marks array<struct<cluster:int,most:double,cc:double>>"


def _cell(table: pa.Table) -> pa.Table:
    at, tid, w = (table[c].to_numpy() for c in ("at", "tid", "w"))
    by = np.argsort(at, kind="stable")
    return pa.table({"part": table["part"].slice(0, 1), "chunk": table["chunk"].slice(0, 1),
                     "at": pa.array([at[by].astype(np.int32).tobytes()]), "tid": pa.array([tid[by].astype(np.int32).tobytes()]),
                     "w": pa.array([w[by].astype(float).tobytes()])})


def _ints(x) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), np.int32)


def _doubles(x, k: int = 0) -> np.ndarray:
    got = np.frombuffer(x.as_buffer(), float)
    return got.reshape(-1, k) if k else got


def _mark(part: int, ss: np.ndarray, ws: np.ndarray, was: np.ndarray):
    gap = np.abs(ws - was).max(axis=0, initial=0.0)
    cc = (ws * ws).sum(axis=0)
    return {"part": part, "ss": ss.tobytes(), "ws": ws.tobytes(),
            "marks": [{"cluster": j, "most": float(gap[j]), "cc": float(cc[j])} for j in range(ws.shape[1])]}


MARKS = pa.schema([("part", pa.int32()), ("ss", pa.binary()), ("ws", pa.binary()),
                   ("marks", pa.list_(pa.struct([("cluster", pa.int32()), ("most", pa.float64()), ("cc", pa.float64())])))])


def _first_centroids(k: int):
    def run(table: pa.Table) -> pa.Table:
        tid = table["tid"].to_numpy()
        ws = np.zeros((int(tid.max()) + 1, k))
        there = table.filter(pc.is_valid(table["cluster"]))
        np.add.at(ws, (there["tid"].to_numpy(), there["cluster"].to_numpy()), there["w"].to_numpy())
        return pa.Table.from_pylist([_mark(table["part"][0].as_py(), np.zeros_like(ws), ws, ws)], MARKS)
    return run


def _cell_dots(k: int):
    def run(batches):
        ws = None   # of the lane that is read: one row a cluster
        for b in batches:
            for i in range(b.num_rows):
                if b["chunk"][i].as_py() == HEAD:
                    ws = np.ascontiguousarray(_doubles(b["ws"][i], k).T)
                    continue
                at, tid, w = _ints(b["at"][i]), _ints(b["tid"][i]), _doubles(b["w"][i])
                first = np.flatnonzero(np.diff(at, prepend=-1))
                dots = np.stack([np.add.reduceat(ws[j].take(tid) * w, first) for j in range(k)], axis=1)
                yield pa.RecordBatch.from_pydict({"chunk": b["chunk"].slice(i, 1), "at": pa.array([at[first].tobytes()]), "dots": pa.array([dots.tobytes()])})
    return run


def _summed(row_ats, row_dots, n: int, k: int) -> np.ndarray:
    dots = np.zeros((n, k))
    for at, d in zip(row_ats or [], row_dots or []):
        dots[np.frombuffer(at, np.int32)] += np.frombuffer(d, float).reshape(-1, k)
    return dots


def _nearest(k: int, cc: Sequence[float], clusters: Sequence[int]):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                pp = b["pp"][i].values.to_numpy()
                dots = _summed(b["ats"][i].as_py(), b["dots"][i].as_py(), len(pp), k)
                dist = np.sqrt(np.maximum(pp[:, None] - 2 * dots + np.array(cc), 0.0))
                # ties go to the lowest cluster
                near = np.round(dist[:, clusters], RANK_DECIMALS).argmin(axis=1)
                cluster = np.array(clusters, np.int32)[near]
                was = _ints(b["cluster"][i]) if b["cluster"][i].is_valid else np.full(len(pp), -1, np.int32)
                moved = cluster != was
                size, came, left = (np.bincount(x, minlength=k) for x in (cluster, cluster[moved], was[moved & (was >= 0)]))
                sizes = [{"cluster": j, "size": int(size[j]), "moved": int(came[j] + left[j])} for j in range(k)]
                yield pa.RecordBatch.from_pydict({"chunk": b["chunk"].slice(i, 1), "cluster": pa.array([cluster.tobytes()]), "was": pa.array([was.tobytes()]),
                                                  "sizes": pa.array([sizes], MEMBER_SIZES)})
    return run


MEMBER_SIZES = pa.list_(pa.struct([("cluster", pa.int32()), ("size", pa.int64()), ("moved", pa.int64())]))


def _cell_changes(k: int):
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i in range(b.num_rows):
                at, tid, w = _ints(b["at"][i]), _ints(b["tid"][i]), _doubles(b["w"][i])
                now, was = _ints(b["cluster"][i])[at], _ints(b["was"][i])[at]
                moved = now != was
                if not moved.any():
                    continue
                part, most = b["part"][i].as_py(), int(tid.max()) + 1
                s = sums.get(part, np.zeros((0, k)))
                if len(s) < most:
                    s = np.vstack([s, np.zeros((most - len(s), k))])
                sums[part] = s
                for of, sign in ((now, 1.0), (was, -1.0)):
                    some = moved & (of >= 0)
                    s += np.bincount(tid[some] * np.int64(k) + of[some], sign * w[some], minlength=s.size).reshape(-1, k)
        for part, s in sums.items():
            some = np.flatnonzero((s != 0).any(axis=1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "tids": pa.array([some.tobytes()]), "sums": pa.array([s[some].tobytes()])})
    return run


def _new_centroids(k: int, size: dict[int, int]):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ss, was = _doubles(b["ss"][i], k).copy(), _doubles(b["ws"][i], k)
                for tids, sums in zip(b["tids"][i].as_py() or [], b["sums"][i].as_py() or []):
                    ss[np.frombuffer(tids, np.int32)] += np.frombuffer(sums, float).reshape(-1, k)
                ws = was.copy()
                for j, n in size.items():
                    ws[:, j] = ss[:, j] / n
                yield pa.RecordBatch.from_pylist([_mark(b["part"][i].as_py(), ss, ws, was)], MARKS)
    return run


def _own_distances(k: int, cc: Sequence[float]):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                pp, cluster = b["pp"][i].values.to_numpy(), _ints(b["cluster"][i])
                dots = _summed(b["ats"][i].as_py(), b["dots"][i].as_py(), len(pp), k)[np.arange(len(pp)), cluster]
                dist = np.sqrt(np.maximum(pp - 2 * dots + np.array(cc)[cluster], 0.0))
                yield pa.RecordBatch.from_pydict({"doc_id": b["ids"][i].values, "cluster": pa.array(cluster), "dist": pa.array(dist)})
    return run


def _weights(k: int):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ws = _doubles(b["ws"][i], k)
                tid, cluster = np.nonzero(ws)
                yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(tid), b["part"][i].as_py(), np.int32)), "tid": pa.array(tid.astype(np.int32)),
                                                  "cluster": pa.array(cluster.astype(np.int32)), "w": pa.array(ws[tid, cluster])})
    return run
