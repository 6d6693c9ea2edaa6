"""Hand-made cases for the edge rules (FIXTURES.md, "Small hand-made cases")."""

import math
import os

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import analysis, cluster, compare, evaluate, retrieval, stats, vectors
from quire.sources import records


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_tf_df_idf_and_empty_doc(spark):
    d = docs_of(spark, [(1, "a b a"), (2, "b c"), (3, "")])
    p = stats.postings(d)
    tf = {(r.doc_id, r.term): r.tf for r in p.collect()}
    assert tf == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1, (2, "c"): 1}
    idf = {r.term: (r.df, r.idf) for r in stats.with_idf(stats.term_stats(p), stats.doc_count(d)).collect()}
    assert idf["b"][0] == 2 and idf["b"][1] == pytest.approx(math.log10(3 / 2))
    assert idf["a"][1] == pytest.approx(math.log10(3))
    fs = stats.field_stats(p, d).first()
    assert (fs.max_doc, fs.doc_count, fs.sum_doc_freq, fs.sum_total_term_freq) == (3, 2, 4, 5)


def test_token_rule(spark):
    d = docs_of(spark, [(1, "Gerstmann's i.e. 3.5 X-ray")])
    toks = [r.term for r in analysis.tokens(d).orderBy("pos").collect()]
    assert toks == ["gerstmann's", "i.e", "3.5", "x", "ray"]
    pos = analysis.token_positions(d).orderBy("pos").collect()
    assert [(r.start, r.end) for r in pos][:2] == [(0, 11), (12, 15)]


def test_identical_docs_tie_by_doc_id(spark):
    d = docs_of(spark, [(5, "alpha beta"), (3, "alpha beta"), (9, "gamma")])
    q = spark.createDataFrame([(1, "alpha")], "query_id long, text string")
    hits = retrieval.top_k(retrieval.score(d, analysis.query_terms(q)), 10).orderBy("rank").collect()
    assert [h.doc_id for h in hits] == [3, 5]
    assert hits[0].score == hits[1].score


def test_term_in_every_doc_zero_norm_null_cosine(spark):
    d = docs_of(spark, [(1, "x y"), (2, "x"), (3, "x z")])
    v = vectors.vectorise(d, "tfxidf")
    w = {(r.doc_id, r.term): r.w for r in v.collect()}
    assert w[(2, "x")] == 0.0
    t = spark.createDataFrame([(1,)], "target long")
    cos = {r.doc_id: r.cosine for r in vectors.cosine_table(d, t, "tfxidf").collect()}
    assert cos[2] is None and cos[3] == 0.0
    top = vectors.similar_docs(d, t, 5, "tfxidf").orderBy("rank").collect()
    assert [r.doc_id for r in top] == [3, 2]  # null cosine ranks last


def test_queries_without_hits_or_judgements(spark):
    d = docs_of(spark, [(1, "apple pie"), (2, "apple tart"), (3, "cherry")])
    q = spark.createDataFrame([(1, "apple"), (2, "banana"), (3, "cherry")], "query_id long, text string")
    qrels = spark.createDataFrame([(1, 2), (2, 1)], "query_id long, doc_id long")
    s = retrieval.score(d, analysis.query_terms(q))
    m = {r.query_id: r for r in evaluate.metrics(q, s, qrels, 10).collect()}
    assert set(m) == {1, 2}                      # query 3 has no judgements: skipped
    assert m[1].p == pytest.approx(0.5)          # 1 relevant of min(10, 2 hits)
    assert m[1].recall == 1.0 and m[1].ap == pytest.approx(0.5)
    assert (m[2].p, m[2].recall, m[2].ap) == (0.0, 0.0, 0.0)   # judged, no hits: stays in the mean
    mm = evaluate.mean_metrics(evaluate.metrics(q, s, qrels, 10)).first()
    assert mm.mean_p == pytest.approx(0.25)
    empty = evaluate.mean_metrics(evaluate.metrics(q, s, qrels.limit(0), 10)).first()
    assert (empty.mean_p, empty.map) == (0.0, 0.0)


def test_lambda_one_scores_zero_rank_by_doc_id(spark):
    d = docs_of(spark, [(4, "a b"), (2, "a a a"), (7, "a c")])
    q = spark.createDataFrame([(1, "a")], "query_id long, text string")
    s = retrieval.score(d, analysis.query_terms(q), model="jm", lam=1.0)
    hits = retrieval.top_k(s, 10).orderBy("rank").collect()
    assert [h.doc_id for h in hits] == [2, 4, 7]
    assert all(h.score == 0.0 for h in hits)
    with pytest.raises(ValueError):
        retrieval.score(d, analysis.query_terms(q), model="jm", lam=0.0)


def test_line_slices(spark):
    rows = [(1, "l1\nl2\nl3\n\n\n"), (2, "only"), (3, "a\r\nb\r\nc\r\n"), (4, "")]
    d = docs_of(spark, rows).select("doc_id", T.normalise_lines("text").alias("t"))
    out = {r.doc_id: (r.top, r.bottom, r.zero) for r in d.select(
        "doc_id", T.top_lines("t", 2).alias("top"), T.bottom_lines("t", 2).alias("bottom"),
        T.top_lines("t", 0).alias("zero")).collect()}
    assert out[1] == ("l1\nl2", "l2\nl3", "")     # trailing blank lines do not count
    assert out[2] == ("only", "only", "")           # fewer lines than the limit
    assert out[3] == ("a\nb", "b\nc", "")           # CR/LF ends
    assert out[4] == ("", "", "")


def test_read_qrels_rules(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rel.txt")
    with open(path, "w") as f:
        f.write("1 0 13 1 \n1 0 14\n2 0 x 1\n1    15    0    0.000000\n3 0 16 1\n")
    got = sorted((r.query_id, r.doc_id) for r in records.read_qrels(spark, path).collect())
    assert got == [(1, 13), (3, 16)]


def test_read_records_rules(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rec.txt")
    with open(path, "w") as f:
        f.write(".I 1\n.W\nfirst text\nmore\n.I 2\nno w line\n.I 3\n.W\nold\n.W\n  last  ")
    got = {r.doc_id: r.text for r in records.read_records(spark, path).collect()}
    assert got == {1: "first text\nmore", 2: "no w line", 3: "last"}


def test_align_refuses_missing_queries(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "query_id long, value double")
    b = spark.createDataFrame([(1, 0.3)], "query_id long, value double")
    with pytest.raises(compare.RunMismatch):
        compare.align(a, b)
    with pytest.raises(compare.RunMismatch):
        compare.check_names("m.jm.training.1-20.test.21-30.map10.test.csv",
                            "m.tfidf.training.null.test.21-31.map10.test.csv")


def _points(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, term string, w double")


def test_kmeans_edges(spark):
    pts = _points(spark, [(1, "a", 1.0), (2, "a", 1.2), (3, "b", 5.0), (4, "b", 5.5)])
    r0 = cluster.fit(pts, 0)
    assert r0.assignment.count() == 0 and r0.centroids.count() == 0
    r_big = cluster.fit(pts, 6, init="points")   # k above the number of points: 4 distinct starts
    assert r_big.assignment.count() == 4
    r = cluster.fit(pts, 2, init="points", max_iter=10)
    got = {row.doc_id: row.cluster for row in r.assignment.collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[1] != got[3]
    # distance tie: a point equally far from both centroids goes to the lowest cluster
    tie = _points(spark, [(1, "a", 0.0), (2, "a", 2.0), (3, "a", 1.0)])
    c = spark.createDataFrame([(0, "a", 0.0), (1, "a", 2.0)], "cluster int, term string, w double")
    a = {row.doc_id: row.cluster for row in cluster.assign(tie, c, 2).collect()}
    assert a[3] == 0
    # empty cluster keeps its centroid
    c3 = spark.createDataFrame([(0, "a", 0.0), (1, "a", 2.0), (2, "a", 100.0)], "cluster int, term string, w double")
    asg = cluster.assign(tie, c3, 3)
    new = cluster.update(tie, asg, c3)
    cents = {(row.cluster, row.term): row.w for row in new.collect()}
    assert cents[(2, "a")] == 100.0
    st = {row.cluster: (row.empty, row.changed) for row in cluster.status(new, c3, asg).collect()}
    assert st[2] == (True, False)


def test_negative_boost_rejected(spark):
    from quire.operators import predicates
    d = docs_of(spark, [(1, "a b")])
    cl = spark.createDataFrame([(1, 1, "should", "term", "a", -1.0, 0, "text")],
                               "query_id long, clause_id int, occur string, kind string, text string, boost double, slop int, field string")
    with pytest.raises(ValueError):
        predicates.search(d, cl)


def test_phrase_and_slop(spark):
    from quire.operators import predicates
    d = docs_of(spark, [(1, "new york city"), (2, "york new"), (3, "new big york")])
    cl = spark.createDataFrame(
        [(1, 1, "must", "phrase", "new york", 1.0, 0, "text"),
         (2, 1, "must", "phrase", "new york", 1.0, 1, "text")],
        "query_id long, clause_id int, occur string, kind string, text string, boost double, slop int, field string")
    got = {(r.query_id, r.doc_id) for r in predicates.search(d, cl).collect()}
    assert got == {(1, 1), (2, 1), (2, 3)}
