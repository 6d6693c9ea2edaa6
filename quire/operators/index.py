"""The stored index of a collection: postings and statistics as tables.

A text is tokenised once, when its document is added. The index is a
``BucketStore`` of three tables:

* ``blocks(field, span, block, term, n, cf, top, share, docs, tfs, dls,
  places)``: the postings of a term in a block, with
  the documents, term frequencies, field lengths and positions as arrays in
  step (no positions if the addition left them out), and the largest ``sqrt(tf) / sqrt(dl)`` and ``tf / dl`` among them. The
  row with a null term lists all documents of the block that were added. A
  block holds documents of one span of ``SPAN`` neighbouring ids whose fields
  are of similar length, which keeps these bounds close. Spans are dealt to
  buckets, so the postings of a document lie together and no term is a hot
  key.
* ``terms(field, term, df, cf, top, share)`` and ``fields(field, max_doc,
  doc_count, sum_doc_freq, sum_total_term_freq)``: one row for each addition;
  readers add them up, so an addition writes its own share only.

One addition switches all three tables at once. Documents without an id are
not indexed; a null text has no terms. A document's id is added once: a second
row with the same id counts as another document of that id.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import token_array
from quire.session import bounded_broadcast
from quire.sinks.buckets import BUCKET, BUCKETS, VERSION, BucketStore, bucket_of, with_place

SPAN = 1024       # ids in a span
CLASSES = 64      # length classes of a span, two for every doubling
PARTS = 4         # tasks a bucket is built by, at most
HELD = 1 << 20    # tokens that are sorted together, about


def _forward(docs: DataFrame, fields: Mapping[str, Column], keywords: Sequence[str], id_col: str) -> DataFrame:
    """``(field, doc_id, dl, tokens)``: one row per document and field."""
    parts = [(name, token_array(expr)) for name, expr in fields.items()]
    parts += [(c, F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("string"))).otherwise(F.array().cast("array<string>"))) for c in keywords]
    out = None
    for name, tokens in parts:
        t = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), tokens.alias("tokens"))
        t = t.select(F.lit(name).alias("field"), "doc_id", F.size("tokens").cast("long").alias("dl"), "tokens")
        out = t if out is None else out.unionByName(t)
    return out


BLOCK_COLUMNS = ("field string, span long, block long, term string, n long, cf long, top double, share double, "
                 "docs array<long>, tfs array<long>, dls array<long>, places array<array<int>>")


def _blocks_of(rows: pa.Table, positions: bool) -> Iterator[pa.RecordBatch]:
    """The posting blocks of documents ``(field, span, block, doc_id, dl,
    tokens)`` that are sorted by field, span, block and id."""
    rows = rows.combine_chunks()
    block, doc, dl = (rows[c].to_numpy() for c in ("block", "doc_id", "dl"))
    field = rows["field"].combine_chunks()
    name = field.dictionary_encode().indices.to_numpy()
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(block) != 0) | (np.diff(name) != 0)
    first = np.flatnonzero(fresh)              # the first document of every block
    group = np.cumsum(fresh) - 1
    ends = np.append(first, len(doc))

    def batch(group_of, term, n, cf, top, share, cuts, docs, tfs, dls, places):
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), x) for x in (pa.array(docs), pa.array(tfs), pa.array(dls), places)]
        at = pa.array(first[group_of])
        cols = [field.take(at), rows["span"].combine_chunks().take(at), pa.array(block[first[group_of]]), term, pa.array(n), pa.array(cf), top, share, *lists]
        return pa.RecordBatch.from_arrays(cols, names=[c.strip().split()[0] for c in BLOCK_COLUMNS.split(", ")])

    no_places = lambda size: pa.nulls(size, pa.list_(pa.int32()))
    groups = np.arange(len(first))
    size = np.diff(ends)
    none = pa.nulls(len(first), pa.float64())
    yield batch(groups, pa.nulls(len(first), pa.string()), size, np.zeros(len(first), np.int64), none, none, ends, doc, np.zeros(len(doc), np.int64), dl,
                no_places(len(doc)))
    tokens = rows["tokens"].combine_chunks().flatten()
    if not len(tokens):
        return
    words = tokens.dictionary_encode()
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    owner = np.repeat(np.arange(len(doc)), dl)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(dl) - dl, dl)
    key = group[owner] * len(order) + rank[words.indices.to_numpy()]
    by = np.argsort(key, kind="stable")        # tokens lie by document and position
    key, owner, place = key[by], owner[by], place[by]
    new_key = np.ones(len(key), bool)
    new_key[1:] = np.diff(key) != 0
    new = new_key.copy()
    new[1:] |= np.diff(owner) != 0
    start = np.flatnonzero(new)                # postings
    tf = np.diff(np.append(start, len(key)))
    own = owner[start]
    row = np.flatnonzero(new_key[start])       # the first posting of every term of a block
    cuts = np.append(row, len(start))
    spots = no_places(len(start))
    if positions:
        spots = pa.ListArray.from_arrays(pa.array(np.append(start, len(key)), pa.int32()), pa.array(place, pa.int32()))
    k = key[start][row]
    term = words.dictionary.take(pa.array(order[k % len(order)]))
    top = np.maximum.reduceat(np.sqrt(tf.astype(float)) / np.sqrt(dl[own].astype(float)), row)
    share = np.maximum.reduceat(tf / dl[own], row)
    yield batch(k // len(order), term, np.diff(cuts), np.add.reduceat(tf, row), pa.array(top), pa.array(share), cuts, doc[own], tf, dl[own], spots)


def _inverted(positions: bool):
    """Turns a task's sorted documents into posting blocks, some ``HELD``
    tokens at a time. A block with more tokens gives several rows a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for got in batches:
            if not got.num_rows:
                continue
            lengths = got.column("dl").to_numpy()
            fresh = np.ones(got.num_rows, bool)
            fresh[1:] = np.diff(got.column("block").to_numpy()) != 0
            begin = 0
            # at a new block once enough is held, or anywhere at twice that
            for i in np.flatnonzero(fresh | (np.diff(np.cumsum(lengths) // HELD, prepend=0) != 0)):
                here = tokens + int(lengths[begin:i].sum())
                if here >= HELD and (fresh[i] or here >= 2 * HELD):
                    held.append(got.slice(begin, i - begin))
                    yield from _blocks_of(pa.Table.from_batches(held), positions)
                    held, tokens, begin = [], 0, i
            held.append(got.slice(begin))
            tokens += int(lengths[begin:].sum())
        if held:
            yield from _blocks_of(pa.Table.from_batches(held), positions)
    return run


def span_of(doc_id: Column) -> Column:
    return F.floor(doc_id / SPAN)


class Index:
    """The index stored at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.store = BucketStore(spark, path)
        self._totals: dict[str, object] = {}

    def add(self, docs: DataFrame, fields: Mapping[str, Column] | None = None, keywords: Sequence[str] = (),
            id_col: str = "doc_id", buckets: int = BUCKETS, positions: bool = True) -> Index:
        """Index documents: ``fields`` are tokenised, ``keywords`` are whole
        values. Without ``positions`` phrases cannot be searched."""
        n = self.store.tables["blocks"].buckets if self.store.exists() else buckets
        rows = _forward(docs, fields or {"text": F.col("text")}, keywords, id_col)
        rows = rows.withColumn("span", span_of(F.col("doc_id"))).withColumn("_b", bucket_of(F.col("span"), n))
        rows = rows.withColumn("block", F.col("span") * CLASSES + F.floor(F.log2(F.col("dl") + 1.0) * 2))
        # the one exchange: whole documents go to a part of the bucket of their span
        dealt = rows.repartition("_b", F.pmod(F.hash("span"), F.lit(PARTS))).sortWithinPartitions("_b", "field", "span", "block", "doc_id")
        blocks = dealt.select("field", "span", "block", "doc_id", "dl", "tokens").mapInArrow(_inverted(positions), BLOCK_COLUMNS)
        version = self.store.begin()
        self.store._write("blocks", blocks, "span", n, version, (), True)
        made = self.store.spark.read.schema(with_place(blocks.schema)).parquet(
            f"{self.store.path}/data/blocks").where(F.col(VERSION) == version)
        terms = made.where("term IS NOT NULL").groupBy("field", "term").agg(
            F.sum("n").alias("df"), F.sum("cf").alias("cf"), F.max("top").alias("top"), F.max("share").alias("share"))
        # the class of a block tells whether its fields have tokens (length 0 is class 0, a class of its own), and the
        # lengths add up to the frequencies: the arrays are not read again
        has = F.when(F.pmod("block", F.lit(CLASSES)) > 0, F.col("n")).otherwise(0)
        sums = made.select("field", F.when(F.col("term").isNull(), F.col("n")).alias("max_doc"), F.when(F.col("term").isNull(), has).cast("long").alias("doc_count"),
                           F.when(F.col("term").isNotNull(), F.col("n")).alias("sum_doc_freq"),
                           F.when(F.col("term").isNotNull(), F.col("cf")).alias("sum_total_term_freq"))
        zero = F.lit(0).cast("long")
        totals = sums.groupBy("field").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in sums.columns[1:]])
        self.store.append({"terms": (terms, "term"), "fields": (totals, "field")}, n, {"terms": ("field", "term")}, written={"blocks": (blocks.schema, "span")}, version=version)
        self._totals.clear()
        return self

    def blocks(self, field: str = "text") -> DataFrame:
        """Posting blocks of a field, without the rows of all documents."""
        return self.store.read("blocks").where((F.col("field") == field) & F.col("term").isNotNull())

    def postings(self, field: str = "text") -> DataFrame:
        """``(field, doc_id, term, tf, dl)``."""
        return self.blocks(field).select("field", "term", F.inline(F.arrays_zip("docs", "tfs", "dls"))).select(
            "field", F.col("docs").alias("doc_id"), "term", F.col("tfs").alias("tf"), F.col("dls").alias("dl"))

    def document(self, doc_id: int, field: str = "text") -> DataFrame:
        """The postings of one document: the blocks of one span are read."""
        b = self.store.bucket("blocks", F.lit(doc_id // SPAN).cast("long"))
        rows = self.blocks(field).where((F.col(BUCKET) == b) & (F.col("span") == doc_id // SPAN))
        at = F.array_position("docs", F.lit(doc_id).cast("long")).cast("int")
        return rows.where(at > 0).select("field", F.lit(doc_id).cast("long").alias("doc_id"), "term",
                                         F.element_at("tfs", at).alias("tf"), F.element_at("dls", at).alias("dl"))

    def documents(self, field: str = "text") -> DataFrame:
        """``(doc_id, dl)`` of every document that was added."""
        rows = self.store.read("blocks").where((F.col("field") == field) & F.col("term").isNull())
        return rows.select(F.inline(F.arrays_zip("docs", "dls"))).select(F.col("docs").alias("doc_id"), F.col("dls").alias("dl"))

    def term_stats(self, field: str | None = "text") -> DataFrame:
        """``(field, term, df, cf, top, share)``, added up over the additions."""
        rows = self.store.read("terms")
        rows = rows if field is None else rows.where(F.col("field") == field)
        if all(len(v) == 1 for v in self.store.tables["terms"].live.values()):
            return rows.drop(BUCKET)
        return rows.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.max("top").alias("top"), F.max("share").alias("share"))

    def stats_of(self, terms: DataFrame, field: str = "text") -> DataFrame:
        """``term_stats`` of the terms of a frame ``(term)``."""
        return self.term_stats(field).join(bounded_broadcast(terms.select("term").distinct()), "term", "left_semi")

    def field_stats(self) -> DataFrame:
        """``(field, max_doc, doc_count, sum_doc_freq, sum_total_term_freq)``."""
        rows = self.store.read("fields").drop(BUCKET)
        return rows.groupBy("field").agg(*[F.sum(c).alias(c) for c in rows.columns[1:]])

    def totals(self, field: str = "text"):
        """The one row of ``field_stats`` for a field, read back; zeros for a
        field without rows."""
        if field not in self._totals:
            rows = {r.field: r for r in self.field_stats().collect()}   # one row a field
            self._totals = rows | {field: rows.get(field) or type("Zeros", (), dict.fromkeys(
                ("max_doc", "doc_count", "sum_doc_freq", "sum_total_term_freq"), 0))}
        return self._totals[field]
