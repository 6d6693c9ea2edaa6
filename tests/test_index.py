"""The stored index, block bounds, and keyed collections."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import analysis, retrieval
from quire.operators.index import Index
from quire.sinks import collection
from quire.sinks.buckets import BucketStore


def corpus(n=400, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [(i * 7, " ".join(r.choices(words, weights=[1 / (j + 1) for j in range(60)], k=r.randint(0, 40)))) for i in range(n)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def counted(rows):
    post = {}
    for d, t in rows:
        for w in (t or "").split():
            post[d, w] = post.get((d, w), 0) + 1
    return post


def test_additions_add_up(spark, tmp_dir):
    rows = corpus() + [(5000, None), (5001, "")]
    index = Index(spark, tmp_dir + "/ix")
    for part in (rows[:100], rows[100:101], rows[101:]):
        index = Index(spark, tmp_dir + "/ix").add(docs_of(spark, part), buckets=4)
    index = Index(spark, tmp_dir + "/ix")
    post = counted(rows)
    assert {(r.doc_id, r.term): r.tf for r in index.postings().collect()} == post
    df = {}
    for d, w in post:
        df[w] = df.get(w, 0) + 1
    got = {r.term: (r.df, r.cf) for r in index.term_stats().collect()}
    assert got == {w: (n, sum(c for (_, x), c in post.items() if x == w)) for w, n in df.items()}
    t = index.totals()
    assert (t.max_doc, t.doc_count) == (len(rows), sum(bool((x or "").split()) for _, x in rows))
    assert (t.sum_doc_freq, t.sum_total_term_freq) == (len(post), sum(post.values()))
    one = rows[42][0]
    assert {r.term: r.tf for r in index.document(one).collect()} == {w: c for (d, w), c in post.items() if d == one}
    assert {r.doc_id for r in index.documents().collect()} == {d for d, _ in rows}
    assert index.totals("other").max_doc == 0


def test_positions_and_keywords(spark, tmp_dir):
    d = spark.createDataFrame([(1, "a b a", "x y"), (2, "b", None)], "doc_id long, text string, k string")
    index = Index(spark, tmp_dir + "/ix").add(d, keywords=["k"], buckets=2)
    got = {(r.term, tuple(r.docs), tuple(map(tuple, r.places))) for r in index.blocks().collect()}
    flat = {(t, i, p) for t, ds, ps in got for i, p in zip(ds, ps)}
    assert flat == {("a", 1, (0, 2)), ("b", 1, (1,)), ("b", 2, (0,))}
    assert [(r.doc_id, r.term) for r in index.postings("k").collect()] == [(1, "x y")]


@pytest.mark.parametrize("model", ["tfidf", "jm"])
def test_block_bounds_lose_no_hit(spark, tmp_dir, model):
    rows = corpus(900) + [(9000 + i, "w40 w41 w42") for i in range(15)]   # ties at the cut
    index = Index(spark, tmp_dir + "/ix").add(docs_of(spark, rows), buckets=4, positions=False)
    q = spark.createDataFrame([(1, "w40 w41 w42 w0"), (2, "w3 w50"), (3, "nothing"), (4, "w59 w59 w1")], "query_id long, text string")
    terms = analysis.query_terms(q)
    want = retrieval.top_k(retrieval.score(index, terms, model), 10)
    hits, report = retrieval.best_hits(index, terms, 10, model)
    key = lambda df: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.collect())
    assert key(hits) == key(want)
    read = {r.query_id: (r.postings, r.postings_read) for r in report.collect()}
    df = {}
    for _, w in counted(rows):
        df[w] = df.get(w, 0) + 1
    assert {k: v[0] for k, v in read.items()} == {1: df["w40"] + df["w41"] + df["w42"] + df["w0"], 2: df["w3"] + df["w50"], 4: df["w59"] + df["w1"]}
    assert all(b <= a for a, b in read.values())
    if model == "tfidf":
        assert read[1][1] < read[1][0] / 2   # the long documents' blocks are left out


def test_upsert_rewrites_one_bucket(spark, tmp_dir):
    path = tmp_dir + "/c"
    d = spark.createDataFrame([(f"p{i}", i) for i in range(200)], "path string, v int")
    collection.save(d, path, "create", key="path", buckets=8)
    before = BucketStore(spark, path)
    collection.save(spark.createDataFrame([("p7", -7), ("p999", 9)], "path string, v int").limit(1), path, "append", update=True)
    after = BucketStore(spark, path)
    changed = [b for b in range(8) if list(before.tables["docs"].live[b]) != list(after.tables["docs"].live[b])]
    assert len(changed) == 1
    got = {r.path: r.v for r in collection.load(spark, path).collect()}
    assert got == {f"p{i}": -7 if i == 7 else i for i in range(200)}
    assert after.vacuum() == 1
    assert {r.path: r.v for r in collection.load(spark, path).collect()} == got


def test_failed_write_leaves_the_old_rows(spark, tmp_dir):
    path = tmp_dir + "/c"
    collection.save(spark.createDataFrame([("a", 1), ("b", 2)], "path string, v int"), path, "create", key="path", buckets=4)
    bad = spark.createDataFrame([("a", 5)], "path string, v int").select("path", F.raise_error(F.lit("no")).cast("int").alias("v"))
    with pytest.raises(Exception):
        collection.save(bad, path, "append", update=True)
    assert sorted(tuple(r) for r in collection.load(spark, path).collect()) == [("a", 1), ("b", 2)]
    # a writer that began at the same version cannot switch after another one
    one, two = BucketStore(spark, path), BucketStore(spark, path)
    one.upsert("docs", spark.createDataFrame([("a", 3)], "path string, v int"))
    with pytest.raises(Exception):
        two.upsert("docs", spark.createDataFrame([("a", 4)], "path string, v int"))
    assert {r.path: r.v for r in collection.load(spark, path).collect()}["a"] == 3


def test_modes_of_collections(spark, tmp_dir):
    d = spark.createDataFrame([("a", 1)], "path string, v int")
    with pytest.raises(FileNotFoundError):
        collection.save(d, tmp_dir + "/none", "append")
    collection.save(d, tmp_dir + "/plain", "create")
    with pytest.raises(ValueError):
        collection.save(d, tmp_dir + "/plain", "append", key="path", update=True)
    collection.save(d, tmp_dir + "/keyed", "create_or_append", key="path")
    collection.save(d, tmp_dir + "/keyed", "append")
    assert collection.load(spark, tmp_dir + "/keyed").count() == 2
    with pytest.raises(ValueError):
        collection.save(d, tmp_dir + "/keyed", "append", key="v")
    collection.save(d.limit(0), tmp_dir + "/keyed", "append", update=True)
    assert collection.load(spark, tmp_dir + "/keyed").count() == 2
    collection.save(d, tmp_dir + "/keyed", "create")
    assert collection.load(spark, tmp_dir + "/keyed").count() == 1
    assert not collection.exists(spark, tmp_dir + "/none") and collection.exists(spark, tmp_dir + "/keyed")
    assert os.path.isdir(tmp_dir + "/keyed/live") and math.isfinite(1)


def test_a_block_of_many_tokens_is_built_in_parts(spark, tmp_dir, monkeypatch):
    """Tasks hold a bounded number of tokens, and the rows of a bucket come
    from more than one task."""
    from quire.operators import index as module
    monkeypatch.setattr(module, "HELD", 50)
    rows = [(i, " ".join(random.Random(i % 9).choices("abcdefgh", k=i % 30))) for i in range(0, 60000, 37)] + [(7, None), (37, "a b")]
    index = Index(spark, tmp_dir + "/ix").add(docs_of(spark, rows), buckets=2)
    want = sorted((d, w, (t or "").split().count(w)) for d, t in rows for w in set((t or "").split()))
    assert sorted((r.doc_id, r.term, r.tf) for r in index.postings().collect()) == want
    places = index.blocks().selectExpr("term", "inline(arrays_zip(docs, places))").collect()
    texts = {d: t.split() for d, t in rows if t and d != 37}
    assert all([texts[r.docs][p] for p in r.places] == [r.term] * len(r.places) for r in places if r.docs in texts)
    assert index.totals().max_doc == len(rows)
    per_block = index.blocks().groupBy("block", "term").count()
    assert per_block.where("count > 1").count() > 0
