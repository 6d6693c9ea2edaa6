"""Hard-negative mining with exact scores by the method of four Russians.

Vectors are integer. The dimensions fall into groups of eight. For every
anchor and group a table holds the 256 subset sums of the anchor's eight
components. A candidate's components are cut into bit planes (two's
complement), and the eight bits of a group and plane are one byte: the index
of the subset sum that this plane adds. A score is the sum of the looked-up
values over the groups, shifted by the plane and added up (the sign plane is
subtracted), so it is the full inner product.

Candidates are packed into blocks and anchors into chunks; a block and a
chunk meet as one unit of work, the units are dealt evenly over the tasks. One
pass scores anchors with the blocks of their own label and keeps each
anchor's best as positives; a second one scores them with all blocks and
keeps, for every positive, the best of other labels inside its window of
scores. The best of every unit are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.tables import read, stage
from quire.llm.topk import quantised
from quire.session import bounded_broadcast

SCALE = 256          # fixed value: components become floor(256 * x)
ANCHOR_STEP = 100    # fixed value: anchors have an id divisible by this
RELABEL_STEP = 7     # fixed value: every such id has the next of LABELS labels
LABELS = 10
POSITIVES = 5        # fixed value: positives of an anchor
NEGATIVES = 10       # fixed value: negatives of an anchor and positive
LEAST, MOST = 30, 90   # fixed values: a negative's percent of the positive's score
BLOCK = 8192         # candidates in a block
CHUNK = 512          # anchors in a chunk
ROWS = 512           # candidates scored at a time
TASKS = 10_000       # most tasks of a pass


def planes(rows: np.ndarray) -> np.ndarray:
    """Bit planes of integer rows as bytes, ``(planes, rows, groups)``; the
    last plane is the sign."""
    bits = max(int(rows.max(initial=0)).bit_length(), int(-1 - rows.min(initial=-1)).bit_length()) + 1
    return np.stack([np.packbits(((rows >> k) & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)])


SUBSETS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums of every group of eight dimensions, ``(groups, 256, anchors)``."""
    short = -anchors.shape[1] % 8
    a = np.pad(anchors, ((0, 0), (0, short))).reshape(len(anchors), -1, 8)
    return np.einsum("si,agi->gsa", SUBSETS, a)


def scores(cut: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products ``(rows, anchors)`` from ``planes`` and ``tables``."""
    bits, n, groups = cut.shape
    width = sums.shape[2]
    out = np.zeros((n, width), np.int64)
    # sums of one plane stay exact in 32 bits if all looked-up values do
    small = int(np.abs(sums).max(initial=0)) * groups < 1 << 31
    sums = np.ascontiguousarray(sums, np.int32 if small else np.int64)
    for at in range(0, n, ROWS):
        part = cut[:, at:at + ROWS]
        plane, got = np.empty((part.shape[1], width), sums.dtype), np.empty((part.shape[1], width), sums.dtype)
        for k in range(bits):
            plane[:] = 0
            for g in range(groups):
                np.take(sums[g], part[k, :, g], axis=0, out=got, mode="clip")
                plane += got
            shifted = plane.astype(np.int64) << k
            if k == bits - 1:
                out[at:at + ROWS] -= shifted
            else:
                out[at:at + ROWS] += shifted
    return out


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    lens = np.diff(col.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(lens), dim), np.int64)
    out[np.arange(dim) < lens[:, None]] = col.flatten().to_numpy()
    return out


def _positives(want: int):
    """The best rows of the anchor's own label; a unit holds one label."""
    def find(ids, labels, got, anchors):
        for a, own in enumerate(anchors.field("vec_id").to_pylist()):
            s = got[:, a]
            ok = np.flatnonzero(ids != own)
            if len(ok) > want:
                ok = ok[s[ok] >= np.partition(s[ok], len(ok) - want)[len(ok) - want]]
            for r in ok[np.lexsort((ids[ok], -s[ok]))][:want]:
                yield own, int(ids[r]), int(s[r])
    return find, "anchor_id long, vec_id long, score long"


def _negatives(want: int, least: int, most: int):
    """The best rows of other labels in the window of every positive."""
    def find(ids, labels, got, anchors):
        cols = [anchors.field(c).to_pylist() for c in ("vec_id", "label", "positives")]
        for a, (own, label, positives) in enumerate(zip(*cols)):
            spans = [(n, -(-least * p["score"] // 100), most * p["score"] // 100) for n, p in enumerate(positives)]
            spans = [x for x in spans if x[1] <= x[2]]
            if not spans:
                continue
            s = got[:, a]
            ok = np.flatnonzero((s >= min(x[1] for x in spans)) & (s <= max(x[2] for x in spans)) & (labels != label) & (ids != own))
            ok = ok[np.lexsort((ids[ok], -s[ok]))]
            down = -s[ok]
            for n, low, high in spans:
                first = int(np.searchsorted(down, -high, "left"))
                last = min(int(np.searchsorted(down, -low, "right")), first + want)
                for r in ok[first:last]:
                    yield own, n, int(ids[r]), int(s[r])
    return find, "anchor_id long, place int, vec_id long, score long"


def _units(find, schema: str):
    """Score the units of a task; a unit's block comes before its chunk."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64() if f.endswith("long") else pa.int32() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = block = None
        for batch in batches:
            for i in range(batch.num_rows):
                unit, is_chunk = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = batch.column(2).slice(i, 1).flatten()
                if not is_chunk:
                    at, block = unit, rows
                    continue
                if at != unit:   # no candidate fell into this block
                    continue
                v, w = block.field("v"), rows.field("v")
                dim = max(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in (v, w))
                got = scores(planes(_matrix(v, dim)), tables(_matrix(w, dim))) if dim else np.zeros((len(v), len(w)), np.int64)
                out = list(find(block.field("vec_id").to_numpy(), block.field("label").to_numpy(), got, rows))
                cols = list(zip(*out)) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def _met(candidates: DataFrame, anchors: DataFrame, find_schema, block: int, chunk: int) -> DataFrame:
    """What ``find`` gives for every block and chunk of the same ``side``.
    Both frames hold ``side`` and the struct ``row``."""
    def sizes(df, size, name):
        return df.groupBy("side").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias(name))

    def packed(df, own, other):
        # dealt by the row's number, so that a repeated row cannot fill a block
        df = df.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
        df = df.join(plan, "side").withColumn("own", F.pmod("deal", own))
        df = df.groupBy("side", "own").agg(F.collect_list("row").alias("rows"), F.first(other).alias("n"))
        return df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))

    plan = sizes(candidates, block, "blocks").join(sizes(anchors, chunk, "chunks"), "side")
    plan = stage(plan, "units")
    total = plan.agg(F.sum(F.col("blocks") * F.col("chunks"))).first()[0]
    find, schema = find_schema
    if total is None:
        return candidates.sparkSession.createDataFrame([], schema)
    plan = bounded_broadcast(plan)
    kind = dict(candidates.select("row").dtypes)["row"], dict(anchors.select("row").dtypes)["row"]
    extra = [] if kind[0] == kind[1] else ["positives"]
    first = packed(candidates, "blocks", "chunks").select("side", F.col("own").alias("b"), F.col("other").alias("c"), F.lit(False).alias("is_chunk"), "rows")
    then = packed(anchors, "chunks", "blocks").select("side", F.col("other").alias("b"), F.col("own").alias("c"), F.lit(True).alias("is_chunk"), "rows")
    if extra:   # candidates have no positives
        none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>").alias("positives")
        first = first.withColumn("rows", F.transform("rows", lambda r: F.struct(r["vec_id"].alias("vec_id"), r["label"].alias("label"), r["v"].alias("v"), none)))
    tasks = min(int(total), TASKS)
    chunks = plan.groupBy().agg(F.max("chunks").alias("m")).first()["m"]
    unit = F.struct("side", "b", "c")
    place = F.pmod(F.xxhash64("side") + F.col("b") * F.lit(chunks) + F.col("c"), F.lit(tasks)).cast("int")
    dealt = first.unionByName(then).select(unit.alias("unit"), "is_chunk", "rows", place.alias("place"))
    dealt = dealt.repartitionById(tasks, "place").sortWithinPartitions("unit", "is_chunk").select(F.to_json("unit").alias("unit"), "is_chunk", "rows")
    return dealt.mapInArrow(_units(find, schema), schema)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for every row of ``anchors(vec_id, label, v)`` its
    first ``positives`` other rows of its label among ``vectors(vec_id, label,
    v)``, and for each of them the first ``negatives`` rows of other labels
    whose score is ``least`` to ``most`` percent of the positive's. Higher
    scores come first, ties by the smaller id.

    Missing components of shorter vectors count as 0, empty vectors score 0.
    A repeated row counts as often as it occurs; rows of the anchor's id are
    neither; of an anchor id with several rows the smallest (label, v) asks.
    Anchors without a positive or a row in the window, and empty tables, give
    no rows. Scores are exact within 64 bits.
    """
    asked = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    asked = stage(asked, "anchors")
    row = F.struct("vec_id", "label", "v").alias("row")
    same = _met(vectors.select(F.col("label").alias("side"), row), asked.select(F.col("label").alias("side"), row), _positives(positives), block, chunk)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = same.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    # at most ``positives`` of an anchor
    lists = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("l")).select(
        F.col("anchor_id").alias("vec_id"), F.transform("l", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("positives"))
    asked = stage(asked.join(lists, "vec_id"), "positives")
    everywhere = F.lit(0).alias("side")
    other = _met(vectors.select(everywhere, row), asked.select(everywhere, F.struct("vec_id", "label", "v", "positives").alias("row")),
                 _negatives(negatives, least, most), block, chunk)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    hard = other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    known = asked.select(F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("place", "p"))
    return hard.join(known, ["anchor_id", "place"]).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def labelled(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, v)`` of rows with a label and a whole finite vector;
    every ``RELABEL_STEP``-th id has the next label."""
    label = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = embeddings.where("label IS NOT NULL").select("vec_id", label.cast("long").alias("label"), "embedding")
    # the label travels beside the vector through the quantisation
    ok = quantised(rows.select(F.struct("vec_id", "label").alias("vec_id"), "embedding"), scale=SCALE)
    return ok.select("vec_id.vec_id", "vec_id.label", "v").where("vec_id IS NOT NULL")


def op13_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector over all ``embeddings``."""
    rows = labelled(read(spark, sf_dir, "embeddings"))
    return mine(rows, rows.where(F.col("vec_id") % ANCHOR_STEP == 0))
