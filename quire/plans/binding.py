"""Binding of the driver tables to the retrieval data model.

The driver tables carry no relevance judgements, so they are derived: a
document is relevant to a query when both share a run of ``n`` consecutive
words (word rule ``WORD_PATTERN`` on lower-cased text). This only builds the
``qrels(query_id, doc_id)`` input; evaluation never looks at how it was made.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import BROADCAST_MAX_ROWS, materialize

SHINGLE_WORDS = 3
SLICE = 1 << 22   # bytes of text that are split into words together, about
# Anything that is not part of a word under ``WORD_PATTERN``.
NON_WORD = r"[^\p{L}\p{N}_]+"


def _words(text_col: str) -> Column:
    """A text's words under ``WORD_PATTERN``, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.col(text_col)), NON_WORD, " "))


def shingles(df: DataFrame, id_col: str, text_col: str = "text", n: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, shingle)``: every run of ``n`` words of each row, as the words
    joined by single spaces; a text shorter than ``n`` words has none.

    The text is reduced to space-separated words, then one regular
    expression with a look-ahead captures the run starting at every word:
    built inside the row, no shuffle.
    """
    words = _words(text_col)
    run = " ".join(["[^ ]+"] * n)
    rx = f"(?<![^ ])(?=({run}))"
    return df.select(F.col(id_col), F.explode(F.regexp_extract_all(words, F.lit(rx), 1)).alias("shingle"))


class _Asked:
    """The shingles of the queries, to be found among the words of texts: a
    word is a number, a run a chain of codes ``(code of the run so far, next
    word)``, so runs are compared exactly."""

    def __init__(self, texts: pa.Array, n: int):
        self.texts, self.n = texts, n
        runs = [t.split(" ") for t in texts.to_pylist()]
        self.words = sorted({w for run in runs for w in run})
        number = {w: i for i, w in enumerate(self.words)}
        ids = np.array([[number[w] for w in run] for run in runs], np.int64).reshape(len(runs), n)
        self.known, code = [], ids[:, 0]
        for j in range(1, n):
            key = code * len(self.words) + ids[:, j]
            self.known.append(np.unique(key))
            code = np.searchsorted(self.known[-1], key)
        self.text_of = np.zeros(len(runs), np.int64)
        self.text_of[code] = np.arange(len(runs))

    def met(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(row, shingle)`` of every run of the texts, given as their words
        with single spaces between, that is asked for."""
        lists = pc.split_pattern(words, " ")
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        ids = pc.fill_null(pc.index_in(flat, pa.array(self.words, flat.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(ids >= 0)
        ends = np.cumsum(size)
        row = np.searchsorted(ends, at, side="right")
        inside = at + self.n <= ends[row]
        at, row = at[inside], row[inside]
        code = ids[at]
        for j, known in enumerate(self.known, 1):
            key = code * len(self.words) + ids[at + j]
            code = np.searchsorted(known, key)
            hit = (ids[at + j] >= 0) & (known[np.minimum(code, len(known) - 1)] == key)
            at, row, code = at[hit], row[hit], code[hit]
        return row, self.text_of[code]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not self.words or not batch.num_rows:
                continue
            ids, words = batch.columns
            big = np.cumsum(pc.fill_null(pc.binary_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
            cuts = np.flatnonzero(np.diff(big, prepend=-1) != 0)
            for i, j in zip(cuts, [*cuts[1:], batch.num_rows]):
                row, shingle = self.met(words.slice(i, j - i))
                if len(row):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row + i)), self.texts.take(pa.array(shingle))], names=["id", "shingle"])


def shingle_qrels(docs: DataFrame, queries: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``(query_id, doc_id)`` pairs sharing a run of ``n`` words.

    Query shingles are the small, size-checked side: the runs of a document
    that are among them are found where its words lie (``_Asked``), and only
    matches are joined and de-duplicated. Above the bound all document
    shingles are joined.
    """
    q = shingles(queries, "query_id", n=n).distinct()
    if q.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS:
        q = F.broadcast(q)
        asked = _Asked(q.select("shingle").distinct().toArrow()["shingle"].combine_chunks().cast(pa.string()), n)   # bounded as a broadcast is
        kind = docs.schema["doc_id"].dataType.simpleString()
        d = docs.select(F.col("doc_id").alias("id"), _words("text").alias("words")).mapInArrow(asked, f"id {kind}, shingle string")
        d = d.withColumnRenamed("id", "doc_id")
    else:
        d = shingles(docs, "doc_id", n=n)
    # judgements feed several consumers (marks, counts, query sets): written once
    return materialize(d.join(q, "shingle").select("query_id", "doc_id").distinct())


def wait_for(moment: datetime) -> None:
    """Return after ``moment``, so that files written next are later."""
    while (left := moment.timestamp() + 0.1 - time.time()) > 0:
        time.sleep(left)


def _folder(col: str) -> Column:
    """``col=value`` as the name of a folder, as Spark's writers name it."""
    value = F.col(col).cast("string")
    unsafe = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
    # hexadecimal codes of the characters that a folder's name cannot have
    codes = F.transform(F.split(value, ""), lambda c: F.when(c.rlike(unsafe), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    escaped = F.when(value.rlike(unsafe), F.array_join(codes, "")).otherwise(value)
    return F.concat(F.lit(f"{col}="), F.when(F.coalesce(F.length(value), F.lit(0)) == 0, F.lit("__HIVE_DEFAULT_PARTITION__")).otherwise(escaped))


def _write_files(root: str):
    """Writes a task's texts, sorted by folder, as a file per folder below
    ``root``, a line end after each text. A repeated task writes the same
    files again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, written = None, 0
        for batch in batches:
            for folder, text in zip(batch.column("folder").to_pylist(), batch.column("text").to_pylist()):
                os.makedirs(f"{root}/{folder}", exist_ok=True)
                with open(f"{root}/{folder}/part-{task:05d}{tag}.txt", "ab" if folder == last else "wb") as f:
                    f.write((text or "").encode() + b"\n")
                written += folder != last
                last = folder
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["files"])

    tag = "-" + uuid.uuid4().hex[:8]   # one for each write, as files may be added to a folder
    return run


def write_doc_tree(docs: DataFrame, root: str, summary: bool = True) -> None:
    """Stage the collection as a folder tree of UTF-8 text files (input of
    the file-tree readers): one summary CSV at the root, documents in
    language ``en`` two folders deep (``source=…/doc_id=…/``), the others one
    folder deep (``doc_id=…/``), one file per document. Without ``summary`` the
    documents are added to a tree that is there.

    On a mounted file system the tasks write the files themselves: a commit of
    Spark's partitioned writer moves folder by folder on the driver, and each
    file it makes starts processes that set its mode."""
    if summary:
        docs.agg(F.count(F.lit(1)).alias("n_docs")).write.mode("overwrite").csv(root)
    en = docs.where(F.col("lang") == "en").select("source", "doc_id", "text")
    rest = docs.where(F.coalesce(F.col("lang") != "en", F.lit(True))).select("doc_id", "text")
    place = urlparse(root)
    for rows, by in ((en, ["source", "doc_id"]), (rest, ["doc_id"])):
        if place.scheme in ("", "file"):
            files = rows.select(F.concat_ws("/", *[_folder(c) for c in by]).alias("folder"), "text").sortWithinPartitions("folder", "text")
            files.mapInArrow(_write_files(place.path), "files long").agg(F.sum("files")).first()   # one number
        else:
            rows.write.mode("append").partitionBy(*by).text(root)


def write_records(docs: DataFrame, path: str) -> None:
    """Stage the collection in the ``.I id`` / ``.W`` record format."""
    rec = F.concat(F.lit(".I "), F.col("doc_id").cast("string"), F.lit("\n.W\n"), F.col("text"))
    docs.select(rec.alias("value")).write.mode("overwrite").text(path)


def write_qrels(qrels: DataFrame, path: str) -> None:
    """Stage judgements as ``query 0 doc 1`` lines, each pair also once in
    the old space-aligned layout (which a reader must skip)."""
    good = qrels.select(F.format_string("%d 0 %d 1", "query_id", "doc_id").alias("value"))
    old = qrels.select(F.format_string("%-5d %-6d 0 0.000000", "query_id", "doc_id").alias("value"))
    good.unionByName(old).write.mode("overwrite").text(path)


# Clause sets of the predicate queries, built from each benchmark query's
# own words: t0, t1, t2 are its first three words, ``longest`` its first
# longest word, ``text`` the normalised query text.
CLAUSE_SETS = {
    "must": [("should", "term", "text", 1.0, 0, "text"), ("must", "term", "longest", 1.0, 0, "text")],
    "must_not": [("should", "term", "text", 1.0, 0, "text"), ("must_not", "term", "t0", 1.0, 0, "text")],
    "phrase": [("should", "term", "text", 1.0, 0, "text"), ("must", "phrase", "t0 t1", 1.0, 0, "text")],
    "phrase_slop": [("should", "phrase", "t0 t2", 1.0, 2, "text")],
    "prefix": [("should", "prefix", "pre3(t0)", 1.0, 0, "text")],
    "wildcard": [("should", "wildcard", "wild(t0)", 1.0, 0, "text")],
    "fuzzy": [("should", "fuzzy", "t0", 1.0, 1, "text")],
    "regex": [("should", "regex", "re2(t0)", 1.0, 0, "text")],
    "boost": [("should", "term", "text", 1.0, 0, "text"), ("should", "term", "t0", 3.0, 0, "text")],
    "field": [("should", "term", "text", 1.0, 0, "text"), ("must", "term", "t0", 1.0, 0, "top_lines")],
}


def benchmark_clauses(queries: DataFrame, variant: str) -> DataFrame:
    """Clause table ``(query_id, clause_id, occur, kind, text, boost, slop,
    field)`` of one clause set for every query."""
    from quire.functions.text import normalise_query, token_array
    q = queries.select("query_id", normalise_query("text").alias("qtext"))
    q = q.withColumn("_t", token_array("qtext"))
    t0, t1, t2 = (F.element_at("_t", 1), F.try_element_at("_t", F.lit(2)), F.try_element_at("_t", F.lit(3)))
    longest = F.aggregate("_t", F.element_at("_t", 1), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a))
    vals = {
        "text": F.col("qtext"), "t0": t0, "longest": longest,
        "t0 t1": F.concat_ws(" ", t0, t1), "t0 t2": F.concat_ws(" ", t0, t2),
        "pre3(t0)": F.substring(t0, 1, 3),
        "wild(t0)": F.concat(F.substring(t0, 1, 1), F.lit("?"), F.substring(t0, 3, 1 << 20), F.lit("*")),
        "re2(t0)": F.concat(F.substring(t0, 1, 2), F.lit("[a-z]*")),
    }
    rows = []
    for i, (occur, kind, what, boost, slop, field) in enumerate(CLAUSE_SETS[variant], start=1):
        rows.append(q.where(F.size("_t") > 0).select(
            "query_id", F.lit(i).alias("clause_id"), F.lit(occur).alias("occur"), F.lit(kind).alias("kind"),
            vals[what].alias("text"), F.lit(boost).alias("boost"), F.lit(slop).alias("slop"),
            F.lit(field).alias("field")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
