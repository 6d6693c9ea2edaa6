"""Sparse document vectors and cosine similarity.

Vectors are rows ``(doc_id, term, w)``; they are never densified. Weights:
``bin`` (1 when the term occurs), ``tf`` (default), ``tfxidf`` with
idf = log10(N / df) over all documents.

Similarity of a bounded set of target documents to every document reads the
stored index. Norms are added up where the blocks are read. The posting blocks
of the targets' terms are dealt by block once, as the compact arrays they are
stored in, and meet the norms there, so that a document's cosines with every
target are finished in the task that holds it (``operators.spans``); a task
then keeps the ``n`` best of every target, and only these are shuffled. The
targets' terms, with every document-independent factor folded in (their weight,
and idf twice for ``tfxidf``), are the size-checked side of a join on term. The
work is targets x postings of their terms; no pair of non-target documents is
ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.index import SPAN, Index, span_of
from quire.operators.retrieval import indexed
from quire.operators.spans import rank_key, span_sums
from quire.operators.stats import with_idf
from quire.session import bounded_broadcast, written

REPS = ("bin", "tf", "tfxidf")
# Targets that meet the documents together in ``cosine_table``.
TARGET_BLOCK = 1_000


def _checked(rep: str) -> str:
    if rep not in REPS:
        raise ValueError(f"rep must be one of {REPS}")
    return rep


def _idf_table(index: Index, field: str) -> DataFrame:
    return with_idf(index.term_stats(field), int(index.totals(field).max_doc)).select("term", "idf")


def _doc_factor(rep: str):
    return F.lit(1.0) if rep == "bin" else F.col("tf").cast("double")


def vectorise(source: Index | DataFrame, rep: str = "tf", field: str = "text") -> DataFrame:
    """``(doc_id, term, w)`` for one field of the collection."""
    index = indexed(source, field)
    rows = index.postings(field)
    if _checked(rep) == "tfxidf":
        rows = rows.join(bounded_broadcast(_idf_table(index, field)), "term")
        return rows.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    return rows.select("doc_id", "term", _doc_factor(rep).alias("w"))


def norms(vecs: DataFrame) -> DataFrame:
    """``(doc_id, norm)`` Euclidean norm of each vector."""
    return vecs.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def target_side(index: Index, targets: DataFrame, rep: str, field: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(target, term, wq)``, each target's weight on a term times the
    document-independent part of a document's weight on it (idf for
    ``tfxidf``), so ``dot = sum over shared terms of doc_factor * wq``; and
    ``(target, tnorm)``. Only the spans of the targets are read."""
    asked = targets.select("target", span_of(F.col("target")).alias("span")).distinct()
    rows = index.blocks(field).join(bounded_broadcast(asked), "span")
    at = F.array_position("docs", F.col("target")).cast("int")
    own = rows.where(at > 0).select("target", "term", F.element_at("tfs", at).alias("tf"))
    if rep == "tfxidf":
        idf = _idf_table(index, field).join(bounded_broadcast(own.select("term").distinct()), "term", "left_semi")
        own = own.join(bounded_broadcast(idf), "term")
        own = own.select("target", "term", (F.col("tf") * F.col("idf")).alias("w"), (F.col("tf") * F.col("idf") * F.col("idf")).alias("wq"))
    else:
        own = own.select("target", "term", _doc_factor(rep).alias("w"), _doc_factor(rep).alias("wq"))
    own = written(own, "targets")
    tnorm = own.groupBy("target").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("tnorm"))
    return own.select("target", "term", "wq"), tnorm


def _squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of squares ``(block, doc_id, square)`` of a batch's postings."""
    for batch in batches:
        docs, w = batch.column("docs").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy().astype(float)
        n = batch.column("docs").value_lengths().to_numpy().astype(np.int64)
        w = w * np.repeat(batch.column("idf").to_numpy(), n)
        # a block's ids lie in one span: its number and a place there
        block, at = np.unique(batch.column("block").to_numpy(), return_inverse=True)
        cell, of = np.unique(np.repeat(at, n) * SPAN + docs % SPAN, return_inverse=True)
        some = np.zeros(len(cell), np.int64)
        some[of] = docs
        square = np.bincount(of, w * w, len(cell))
        yield pa.RecordBatch.from_arrays([pa.array(block[cell // SPAN]), pa.array(some), pa.array(square)], names=["block", "doc_id", "square"])


def _norms_by_block(index: Index, rep: str, field: str) -> DataFrame:
    """``(block, docs, norms)``: the documents of a block and their norms. The
    squares are added up where the blocks are read, so a row per document
    moves and no posting does."""
    blocks = index.blocks(field).select("block", "term", "docs", F.transform("tfs", lambda x: F.lit(1).cast("long")).alias("tfs") if rep == "bin" else F.col("tfs"))
    if rep == "tfxidf":
        blocks = blocks.join(bounded_broadcast(_idf_table(index, field)), "term")
    else:
        blocks = blocks.withColumn("idf", F.lit(1.0))
    sums = blocks.select("block", "docs", "tfs", F.col("idf").cast("double").alias("idf")).mapInArrow(_squares, "block long, doc_id long, square double")
    per = sums.groupBy("block", "doc_id").agg(F.sqrt(F.sum("square")).alias("norm"))
    return per.groupBy("block").agg(F.collect_list(F.struct("doc_id", "norm")).alias("d")).select("block", F.col("d.doc_id").alias("docs"), F.col("d.norm").alias("norms"))


def _parts(rep: str):
    """A document's part of a product (``_doc_factor``)."""
    return lambda tf, dl, p: [np.ones(len(tf)) if rep == "bin" else tf]


def _weights(side: DataFrame, wq: Column) -> DataFrame:
    return side.select(F.col("target").alias("query_id"), "term", wq.alias("_w"), F.lit(1.0).alias("_p"))


def _ranked(cosines: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("target").orderBy(rank_key(F.col("cosine")).desc_nulls_last(), F.col("doc_id").asc())
    return cosines.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def similar_docs(source: Index | DataFrame, targets: DataFrame, n: int = 10, rep: str = "tf", field: str = "text") -> DataFrame:
    """Top ``n`` documents by cosine to each target (target excluded):
    ``(target, rank, doc_id, cosine)``.

    Documents sharing a term with the target come from the join; the rest all
    score 0 (or null for a zero norm) and rank by ``doc_id``, so only the
    first ``n + 1`` documents in (zero norm last, doc_id) order can fill the
    remaining places: that short list is read back and added to every target.
    """
    _checked(rep)
    index = indexed(source, field)
    # the target list may be the result of a whole retrieval run: written once
    side, tnorm = target_side(index, written(targets.select("target").distinct(), "targets"), rep, field)
    lengths = written(_norms_by_block(index, rep, field), "norms")
    # without a target's norm every cosine is null
    unit = F.coalesce(F.try_divide(F.col("wq"), F.col("tnorm")), F.lit(float("nan")))
    weights = written(_weights(side.join(bounded_broadcast(tnorm), "target"), unit), "weights")
    near = span_sums(index.blocks(field), weights, _parts(rep), n, lengths, "block", apart=True)
    best = written(_ranked(near.select(F.col("query_id").alias("target"), "doc_id", F.col("score").alias("cosine")), n), "similar")
    every = lengths.select(F.inline(F.arrays_zip("docs", "norms"))).toDF("doc_id", "norm")
    fill = every.orderBy((F.col("norm") == 0).asc(), F.col("doc_id").asc()).limit(n + 1).collect()   # n + 1 rows
    if fill:
        fillers = F.array(*[F.struct(F.lit(r.doc_id).cast("long").alias("doc_id"), F.lit(r.norm).alias("norm")) for r in fill])
        zero = tnorm.select("target", "tnorm", F.inline(fillers)).where(F.col("doc_id") != F.col("target"))
        zero = zero.select("target", "doc_id", F.try_divide(F.lit(0.0), F.col("tnorm") * F.col("norm")).alias("cosine"))
        best = best.drop("rank").unionByName(zero).groupBy("target", "doc_id").agg(F.max("cosine").alias("cosine"))
    return _ranked(best, n).select("target", "rank", "doc_id", "cosine")


def cosine_table(source: Index | DataFrame, targets: DataFrame, rep: str = "tf", field: str = "text") -> DataFrame:
    """``(target, doc_id, cosine)`` of each target to every other document
    with a vector (0 when no term is shared, null for a zero norm).

    The output has targets x documents rows by definition. Targets come in
    groups: a document meets one group per row, joined on the group's number.
    """
    _checked(rep)
    index = indexed(source, field)
    targets = written(targets.select("target").distinct(), "targets")
    side, tnorm = target_side(index, targets, rep, field)
    groups = max(1, -(-targets.count() // TARGET_BLOCK))
    every = _norms_by_block(index, rep, field).select(F.inline(F.arrays_zip("docs", "norms"))).toDF("doc_id", "norm")
    met = every.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = tnorm.withColumn("group", F.pmod(F.xxhash64("target"), F.lit(groups)).cast("int"))
    pairs = met.join(bounded_broadcast(asked), "group").where(F.col("doc_id") != F.col("target"))
    dots = span_sums(index.blocks(field), _weights(side, F.col("wq")), _parts(rep)).select(F.col("query_id").alias("target"), "doc_id", F.col("score").alias("dot"))
    return pairs.join(dots, ["target", "doc_id"], "left").select(
        "target", "doc_id", F.try_divide(F.coalesce(F.col("dot"), F.lit(0.0)), F.col("tnorm") * F.col("norm")).alias("cosine"))
