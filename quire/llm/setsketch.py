"""Near-duplicate groups by SetSketch registers.

A document is the set of its distinct word shingles. Its sketch holds, for
every register, the minimum of exponentially distributed hashes of the set,
kept as a 16-bit exponent of a base near one (a truncated minimum): sketches
of unions are register-wise maxima, and equal registers are about as likely
as the Jaccard similarity. The steps:

1. Sets that are equal fall into one class; only the class goes on.
2. Bands of registers are hashed; classes that share a band are candidates.
3. In every band the member that shares the most bands with others leads: it
   is compared with the others, and links merge classes into components.
   Copies of one text thus cost one comparison each and no pairs among
   themselves. Of the bands that still hold several components, members whose
   shingles are too much their own for any link leave without loss. The others
   are described by how their sets differ from a common root, the first member
   of the leader's component. Linked sets have similar differences, and a
   prefix filter on these, rarest elements first, finds every pair that can be
   linked: near copies of one text share the text but not their edits.
4. A pair is estimated jointly from its registers and known set sizes by
   maximum likelihood, and confirmed on the full sets.

Sizes that differ too much are never compared (an exact bound). A pair at the
threshold is missed by all bands with probability below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import flat
from quire.llm.components import components
from quire.llm.tables import read, stage
from quire.session import bounded_broadcast

SHINGLE = 5       # fixed value: words in a shingle
PERCENT = 85      # fixed value: 100 * intersection >= PERCENT * union
BANDS, WIDTH = 32, 6
REGISTERS = BANDS * WIDTH
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1   # parameters of the registers
SLACK = 0.17      # about six standard errors of the estimate
BROADCAST_ROWS = 200_000

_rng = np.random.default_rng(20260101)
MULT = (_rng.integers(0, 1 << 31, REGISTERS, dtype=np.int64) * 2 + 1).astype(np.uint32)
PLUS = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.int64).astype(np.uint32)
WORD_ROLL, SHINGLE_ROLL = flat.Rolling(), flat.Rolling(0xD1B54A32D192ED03)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every flat text, and ``rows + 1`` offsets."""
    low = flat.LOWER[data]
    s, e, first = flat.words(low, offs)
    h = WORD_ROLL.ranges(WORD_ROLL.prefix(low), s, e)
    count = np.diff(first)
    n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    at = flat.span_index(first[:-1], n)
    row = np.repeat(np.arange(len(count)), n)
    size = np.minimum(count, SHINGLE)[row]
    got = SHINGLE_ROLL.ranges(SHINGLE_ROLL.prefix(h), at, at + size) if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((got, row))
    got, row = got[order], row[order]
    new = np.ones(len(got), bool)
    new[1:] = (got[1:] != got[:-1]) | (row[1:] != row[:-1])
    got, row = got[new], row[new]
    return got, np.searchsorted(row, np.arange(len(count) + 1))


def sketches(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Registers (rows x REGISTERS, 16 bit); a row of zeros for an empty set."""
    rows = len(at) - 1
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((rows, REGISTERS), np.uint16)
    if not len(full):
        return out
    low = np.empty((len(full), REGISTERS), np.uint32)
    h = (sets >> np.uint64(32)).astype(np.uint32)
    x = np.empty_like(h)
    for i in range(REGISTERS):
        np.multiply(h, MULT[i], out=x)
        x += PLUS[i]
        low[:, i] = np.minimum.reduceat(x, at[full])
    least = -np.log1p(-(low + 0.5) / 2.0 ** 32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of a union from the sketches of its parts."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of rows of registers, given the
    set sizes, from how many registers are larger, smaller and equal."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    grid = np.linspace(0, 1, 201)[:, None]
    j = grid * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    pm, pl = p(u - v * j), p(v - u * j)
    ll = more * np.log(pm) + less * np.log(pl) + same * np.log(np.clip(1 - pm - pl, 1e-12, 1))
    return np.take_along_axis(j, np.argmax(ll, 0)[None], 0)[0]


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _prints(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of every set, whatever its order."""
    total = np.zeros((2, len(sets) + 1), np.uint64)
    np.cumsum(flat.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), out=total[0, 1:])
    np.cumsum(flat.mix(sets + np.uint64(0x14057B7EF767814F)), out=total[1, 1:])
    return total[0][at[1:]] - total[0][at[:-1]], total[1][at[1:]] - total[1][at[:-1]]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roll = flat.Rolling(0xA0761D6478BD642F)
    for batch in batches:
        data, offs = flat.buffer_of(batch.column("text"))
        for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
            sets, at = shingle_sets(d, o)
            f1, f2 = _prints(sets, at)
            k = sketches(sets, at).astype(np.uint64).ravel()
            s = np.arange((j - i) * BANDS) * WIDTH
            band = roll.ranges(roll.prefix(k), s, s + WIDTH) if len(s) else np.zeros(0, np.uint64)
            band = flat.mix(band + np.tile(np.arange(BANDS, dtype=np.uint64), j - i))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at)), _longs(f1), _longs(f2),
                pa.FixedSizeListArray.from_arrays(_longs(band), BANDS).cast(pa.list_(pa.int64()))],
                names=["doc_id", "n", "f1", "f2", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = flat.buffer_of(batch.column("text"))
        for i, j, d, o in flat.slices(data, offs, flat.SMALL_SLICE):
            sets, at = shingle_sets(d, o)
            f1, f2 = _prints(sets, at)
            k = sketches(sets, at)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), pa.array(np.diff(at)), _longs(f1), _longs(f2),
                pa.array([r.tobytes() for r in k], pa.binary()),
                pa.array([sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["doc_id", "n", "f1", "f2", "sketch", "members"])


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("xa", "xb")]
                j = estimate(*regs, part.column("na").to_numpy().astype(float), part.column("nb").to_numpy().astype(float))
                yield part.select(["a", "b"]).filter(pa.array(j >= percent / 100 - SLACK))
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _attach(pairs: DataFrame, full: DataFrame, what: str) -> DataFrame:
    """``(a, b, na, nb, xa, xb)``: both ends' size and column ``what``."""
    side = lambda x: full.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col(what).alias(f"x{x}"))
    return side("b").join(side("a").join(bounded_broadcast(pairs, BROADCAST_ROWS), "a"), "b").select("a", "b", "na", "nb", "xa", "xb")


def _links(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame | None:
    """Those of ``pairs(a, b)`` whose sets are similar enough; None for none."""
    pairs = stage(pairs, "pairs")
    if pairs.isEmpty():
        return None
    likely = stage(_attach(pairs, full, "sketch").mapInArrow(_likely(percent), "a long, b long"), "likely")
    found = stage(_attach(likely, full, "members").mapInArrow(_confirmed(percent), "a long, b long"), "links")
    return None if found.isEmpty() else found


def _side(rows: DataFrame, x: str) -> DataFrame:
    """Columns of one end of a pair."""
    return rows.drop("degree").withColumnsRenamed({"rep": x, "n": f"n{x}", "comp": f"c{x}", "alone": f"u{x}"})


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct ``(a, b)`` of different components that can reach the
    threshold: at most what is not alone is shared, and all that is alone is
    in the union."""
    ma, mb = F.col("na") - F.col("ua"), F.col("nb") - F.col("ub")
    union = F.greatest(F.greatest(ma, mb) + F.col("ua") + F.col("ub"), F.greatest("na", "nb"))
    able = F.lit(100) * F.least(ma, mb) >= F.lit(percent) * union
    return pairs.where((F.col("ca") != F.col("cb")) & able).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _still_mixed(open_: DataFrame, label: DataFrame) -> DataFrame:
    """The bands that hold several components, with the components."""
    mine = open_.drop("comp").join(label, open_["rep"] == label["node"], "left").select(
        "key", "rep", "n", "alone", "degree", F.coalesce("component", "rep").alias("comp"))
    mixed = mine.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    return stage(mine.join(mixed, "key"), "bands")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("members")]
            take = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), part.column("doc_id").take(take)], names=["h", "rep"])


def _able(open_: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """``open_`` with ``alone``, the shingles of a document that no other one
    left has, without the documents that are too much alone for any link."""
    left = full.join(open_.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rows = left.select("doc_id", "members").mapInArrow(_members, "h long, rep long")
    once = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("rep")).where("c = 1")
    alone = once.groupBy("rep").agg(F.count(F.lit(1)).alias("u"))
    out = open_.join(alone, "rep", "left").withColumn("alone", F.coalesce("u", F.lit(0).cast("long"))).drop("u")
    return out.where(F.lit(100 - percent) * (F.col("n") - F.col("alone")) >= F.lit(percent) * F.col("alone"))


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            diff = [np.setxor1d(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), assume_unique=True)
                    for x, y in zip(part.column("xa"), part.column("xr"))]
            lens = np.array([len(x) for x in diff], np.int64)
            flat_ = np.concatenate(diff) if diff else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(flat_))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("root", "a", "na", "nr")), pa.array(lens), lists],
                                             names=["root", "a", "n", "nr", "d", "diff"])


def _differences(open_: DataFrame, refs: DataFrame, label: DataFrame | None, full: DataFrame) -> DataFrame:
    """``(root, a, n, nr, d, diff)``: for every document of a mixed band what
    its set and that of the band's root do not share. The root is the first
    document of the component of the band's leader."""
    if label is not None:
        refs = refs.join(label, refs["ref"] == label["node"], "left").select("key", F.coalesce("component", "ref").alias("ref"))
    near = open_.join(refs.withColumnRenamed("ref", "root"), "key").select("root", F.col("rep").alias("a")).distinct()
    side = lambda x: full.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x[0]}"), F.col("members").alias(f"x{x[0]}"))
    both = side("root").join(side("a").join(near, "a"), "root")
    return stage(both.mapInArrow(_differing, "root long, a long, n long, nr long, d long, diff array<long>"), "differences")


def _close_pairs(differences: DataFrame, label: DataFrame | None, percent: int) -> DataFrame:
    """Distinct ``(a, b)`` of different components that can be linked.

    The sets of a and b differ by what their differences to a common root
    differ by, so links are pairs of differences of ``da`` and ``db`` elements
    that share at least ``o`` = (da + db - most) / 2 of them, ``most`` being
    how much linked sets of these sizes can differ. In any common order of the
    elements two such differences have an element in common among the first
    da - o + 1 and db - o + 1; the order is by how many differences hold an
    element, rarest first, so copies that were edited in different places
    share none.
    """
    spare = 100 - percent
    rows = differences.select("root", "a", "n", "d", "diff")
    if label is not None:
        rows = rows.join(label, rows["a"] == label["node"], "left")
    else:
        rows = rows.withColumn("component", F.lit(None).cast("long"))
    each = rows.select("root", "a", "n", "d", F.coalesce("component", "a").alias("comp"), F.explode("diff").alias("h"))
    often = each.groupBy("root", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = each.join(often, ["root", "h"])
    mine = Window.partitionBy("root", "a")
    place = F.col("d") - F.count(F.lit(1)).over(mine) + F.row_number().over(mine.orderBy("c", "h")) - 1
    first = shared.withColumn("place", place).where(F.col("place") <= F.floor(F.lit(spare) * F.col("n") / percent))
    first = stage(first.select("root", "h", "a", "n", "d", "comp", "place"), "first-differences")
    x = first.withColumnsRenamed({"n": "na", "d": "da", "comp": "ca", "place": "i"})
    y = first.withColumnsRenamed({"a": "b", "n": "nb", "d": "db", "comp": "cb", "place": "j"})
    most = F.floor(F.lit(spare) * (F.col("na") + F.col("nb")) / (100 + percent))
    o = F.ceil((F.col("da") + F.col("db") - most) / 2)
    able = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (F.col("i") <= F.col("da") - o) & (F.col("j") <= F.col("db") - o)
    return x.join(y, ["root", "h"]).where(able).select("a", "b").distinct()


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of
    ``docs(doc_id, text)``.

    Null texts and texts without words have an empty set, are linked with
    nothing and stay. Repeated rows and exact copies share their group; the
    row (or rows) with the smallest id stays. Rows without an id are linked
    with nothing: their group is null and they stay. Other columns are
    ignored; an empty table gives no rows.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = stage(src.mapInArrow(_signatures, "doc_id long, n long, f1 long, f2 long, bands array<long>"), "signatures")
    real = sigs.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(real.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    rows = classes.select(F.explode("bands").alias("key"), "rep", "n")
    crowd = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    open_ = rows.join(crowd, "key")
    # a class in the middle of many others shares the most bands with them
    degree = open_.groupBy("rep").agg(F.sum("c").alias("degree"))
    open_ = stage(open_.drop("c").join(degree, "rep"), "bands")
    touched = open_.select(F.col("rep").alias("doc_id")).distinct().join(
        classes.select(F.col("rep").alias("doc_id"), "f1", "f2"), "doc_id")
    full = src.join(touched.select("doc_id").distinct(), "doc_id").mapInArrow(
        _full_sets, "doc_id long, n long, f1 long, f2 long, sketch binary, members binary")
    full = stage(full.join(touched, ["doc_id", "f1", "f2"], "left_semi").dropDuplicates(["doc_id", "f1", "f2"]), "sets")
    open_ = open_.withColumns({"comp": F.col("rep"), "alone": F.lit(0).cast("long")})
    links, label = None, None

    def add(found):
        nonlocal links, label
        if found is not None and not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            label = components(links, "near-duplicates")

    if not open_.isEmpty():
        order = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("degree"), "rep"))
        lead = stage(open_.withColumn("place", order).where("place = 1").drop("place"), "leaders")
        add(_links(_possible(_side(lead, "a").join(_side(open_, "b"), "key").where("a <> b"), percent), full, percent))
        if label is not None:
            open_ = _still_mixed(open_, label)
        open_ = stage(_able(open_, full, percent), "bands")
        near = _differences(open_, lead.select("key", F.col("rep").alias("ref")), label, full)
        shared = (F.col("n") + F.col("nr") - F.col("d")) / 2
        alike = F.lit(100) * shared >= F.lit(percent) * (F.col("n") + F.col("nr") - shared)
        add(stage(near.where(alike & (F.col("a") != F.col("root"))).select("a", F.col("root").alias("b")), "links"))
        add(_links(_close_pairs(near, label, percent), full, percent))
    out = sigs.select("doc_id", "n", "f1", "f2").join(classes.select("f1", "f2", "rep"), ["f1", "f2"], "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = out.withColumn("rep", F.when(linked, F.col("rep")))
    if label is not None:
        out = out.join(label, out["rep"] == label["node"], "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    component = F.coalesce("component", "rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged: one of each group, that with
    the smallest id, and all rows without an id. Of several rows with one id
    the first by text hash and text stays."""
    kept = groups(docs, percent).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__quire_kept")).distinct()
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    named = docs.where("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("__quire_kept"), "left_semi")
    first = named.withColumn("__quire_turn", turn).where("__quire_turn = 1").drop("__quire_turn")
    return first.unionByName(docs.where("doc_id IS NULL"))


def one_row_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """As ``one_of_each``, but a row is known by its id and its text: rows that
    share an id and hold unrelated texts all stay, and join no groups. Of each
    group the row with the smallest id (then text hash) stays, once."""
    rows = docs.withColumns({"__quire_id": F.col("doc_id").cast("long"), "__quire_hash": F.xxhash64("text")})
    named = rows.where("__quire_id IS NOT NULL")
    several = named.groupBy("__quire_id").agg(F.min("__quire_hash").alias("x"), F.max("__quire_hash").alias("y"))
    several = stage(several.where("x <> y").select(F.col("__quire_id").alias("__quire_several")), "several-texts")
    # an id with several texts is a node for each of them
    node = F.when(F.col("__quire_several").isNull(), F.col("__quire_id")).otherwise(F.xxhash64("__quire_id", "text"))
    noded = named.join(bounded_broadcast(several, BROADCAST_ROWS), F.col("__quire_id") == F.col("__quire_several"), "left").withColumn("__quire_node", node)
    found = groups(noded.select(F.col("__quire_node").alias("doc_id"), "text"), percent)
    found = found.select(F.col("doc_id").alias("__quire_node"), "component_id").distinct()
    members = noded.select("__quire_node", "__quire_id", "__quire_hash").distinct().join(found, "__quire_node")
    kept = members.groupBy("component_id").agg(F.min(F.struct("__quire_id", "__quire_hash")).alias("k")).select("k.*")
    turn = F.row_number().over(Window.partitionBy("__quire_id", "__quire_hash").orderBy("text"))
    first = named.join(kept, ["__quire_id", "__quire_hash"], "left_semi").withColumn("__quire_turn", turn).where("__quire_turn = 1")
    return first.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def op9_setsketch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""
    return groups(read(spark, sf_dir, "documents"))
