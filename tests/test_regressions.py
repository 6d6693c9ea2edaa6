"""Cases that once gave wrong results: each is pinned with its right one."""

import math

import pytest
from pyspark.sql import functions as F

from quire.operators import analysis, cluster, compare, predicates, tune
from quire.plans import binding
from quire.sinks import collection


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_token_offsets_with_letters_outside_the_base_plane(spark):
    got = analysis.token_positions(docs_of(spark, [(1, "x \U00031350 y z"), (2, None), (3, ""), (4, "Don't, stop")]))
    rows = sorted((r.doc_id, r.pos, r.term, r.start, r.end) for r in got.collect())
    assert [r for r in rows if r[2] in ("x", "y", "z")] == [
        (1, rows[0][1], "x", 0, 1), *[(1, p, t, s, s + 1) for p, t, s in [(rows[-4][1], "y", 4), (rows[-3][1], "z", 6)]]]
    assert rows[-2:] == [(4, 0, "don't", 0, 5), (4, 1, "stop", 7, 11)] and all(r[2] for r in rows)


def test_sweep_keeps_the_given_lambdas(spark):
    docs = docs_of(spark, [(1, "a b c"), (2, "a a d"), (3, "b d e")])
    queries = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    qrels = spark.createDataFrame([(1, 1)], "query_id long, doc_id long")
    rows = tune.sweep(docs, queries, qrels, 2, [0.15, 0.25, 0.2, 0.04]).collect()
    assert sorted(r["lambda"] for r in rows) == [0.04, 0.15, 0.2, 0.25]
    assert all(0 <= r.ap <= 1 and 0 <= r.recall <= 1 for r in rows)


def test_best_lambda_ignores_the_last_bit(spark):
    rows = [(0.2, 1, 0.1 + 0.2), (0.1, 1, 0.3), (0.3, 1, 0.25)]
    m = spark.createDataFrame([(x, q, v, v, v) for x, q, v in rows], "lambda double, query_id long, p double, recall double, ap double")
    assert tune.best_lambda(m).first()["best_lambda"] == 0.1


def test_upsert_takes_the_last_row_of_a_key(spark):
    base = spark.createDataFrame([("x", 1, 0), ("y", 2, 0)], "k string, v int, seq int")
    delta = spark.createDataFrame([("x", 5, 1), ("x", 6, 2)], "k string, v int, seq int")
    got = collection.upsert(base, delta, "k", order="seq")
    assert sorted((r.k, r.v) for r in got.collect()) == [("x", 6), ("y", 2)]
    with pytest.raises(ValueError):
        collection.upsert(base, delta, "k")


def test_document_tree_holds_documents_without_a_language(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "one", "en", "s"), (2, "two", None, "s"), (3, "three", "de", "s")],
                                 "doc_id long, text string, lang string, source string")
    binding.write_doc_tree(docs, tmp_dir)
    texts = {r.value for r in spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(tmp_dir).collect()}
    assert {"one", "two", "three"} <= texts


def clauses(spark, rows):
    return spark.createDataFrame(rows, "query_id long, clause_id int, occur string, kind string, text string, boost double, slop int, field string")


def test_a_clause_without_words_is_not_required(spark):
    docs = docs_of(spark, [(1, "red fox"), (2, "blue")])
    got = predicates.search(docs, clauses(spark, [(1, 1, "must", "term", "red", 1.0, 0, "text"), (1, 2, "must", "term", "--", 1.0, 0, "text")]))
    assert [r.doc_id for r in got.collect()] == [1]


def test_fuzzy_edits_and_pattern_blocks(spark):
    docs = docs_of(spark, [(1, "cat"), (2, "cart"), (3, "carts"), (4, "dog"), (5, "act")])

    def found(kind, text, slop):
        rows = predicates.search(docs, clauses(spark, [(1, 1, "should", kind, text, 1.0, slop, "text")])).collect()
        return sorted(r.doc_id for r in rows)

    assert found("fuzzy", "cat", 0) == [1]
    assert found("fuzzy", "cat", 1) == [1, 2]
    assert found("fuzzy", "cat", None) == [1, 2, 3, 5]
    assert found("wildcard", "*at", 0) == [1] and found("wildcard", "c?r*", 0) == [2, 3] and found("wildcard", "*", 0) == [1, 2, 3, 4, 5]
    assert found("regex", "ca?r?t", 0) == [1, 2] and found("regex", "c*at|dog", 0) == [1, 4] and found("regex", "c?at", 0) == [1]
    assert found("prefix", "car", 0) == [2, 3] and found("prefix", "", 0) == [1, 2, 3, 4, 5]


def test_a_cluster_that_does_not_exist_takes_no_points(spark):
    points = spark.createDataFrame([(1, "a", 0.1), (2, "a", 5.0), (3, "b", 4.0)], "doc_id long, term string, w double")
    centroids = spark.createDataFrame([(0, "a", 5.0), (1, "b", 4.0)], "cluster int, term string, w double")
    assert {r.cluster for r in cluster.assign(points, centroids, 3).collect()} <= {0, 1}
    near = {r.doc_id: r.cluster for r in cluster.assign(points, centroids, 3, clusters=[0, 1, 2]).collect()}
    assert near == {1: 2, 2: 0, 3: 1}   # a listed cluster without weights lies at the origin


def test_box_start_does_not_depend_on_partitions(spark):
    points = spark.createDataFrame([(d, f"t{t}", float((d * t) % 7 + 1)) for d in range(20) for t in range(5)], "doc_id long, term string, w double")
    one, two = ({(r.cluster, r.term): r.w for r in cluster.init_box(points.repartition(n), 3).collect()} for n in (2, 8))
    assert one == two and len(set(one.values())) > 10


def test_fit_ends_at_the_fixed_point(spark):
    points = spark.createDataFrame([(d, t, float(w)) for d in range(40) for t, w in (("x", (d * d) % 17), ("y", d % 5))], "doc_id long, term string, w double")
    r = cluster.fit(points, 3)
    again = cluster.update(points, r.assignment, r.centroids)
    new = {(x.cluster, x.term): x.w for x in again.where("w <> 0").collect()}
    old = {(x.cluster, x.term): x.w for x in r.centroids.collect()}
    assert set(new) == set(old) and all(math.isclose(new[k], old[k], abs_tol=1e-9) for k in old)
    nearest = {x.doc_id: x.cluster for x in cluster.assign(points, r.centroids, 3).collect()}
    assert nearest == {x.doc_id: x.cluster for x in r.assignment.collect()}
    total = r.objective().first()[0]
    assert math.isclose(total, sum(x.dist for x in r.assignment.collect()))
    once = cluster.fit(points, 3, stop="once")
    assert once.iterations <= r.iterations


def exact_tail(n, w):
    ways = [1] + [0] * (n * (n + 1) // 2)
    for r in range(1, n + 1):
        for s in range(len(ways) - 1, r - 1, -1):
            ways[s] += ways[s - r]
    return min(1.0, 2 * sum(ways[math.ceil(w):]) / 2 ** n)


@pytest.mark.parametrize("n", [5, 59, 62, 100])
def test_signed_rank_is_exact_at_any_size(spark, n):
    d = [((i * 37) % n + 1) * (1 if i % 5 < 3 else -1) for i in range(n)]
    rows = spark.createDataFrame([(i, float(x), 0.0) for i, x in enumerate(d)], "query_id long, x double, y double")
    up = sum(abs(x) for x in d if x > 0)
    got = compare.wilcoxon(rows).first()
    assert (got.n, got.w_plus) == (n, up) and abs(got.p_value - exact_tail(n, max(up, n * (n + 1) / 2 - up))) < 1e-9


def test_halves_cover_all_queries(spark):
    q = spark.createDataFrame([(i, "x") for i in range(7, 30)], "query_id long, text string")
    a, b = tune.split(q, *tune.halves(q))
    assert a.count() + b.count() == 23 and a.join(b, "query_id").isEmpty() and not a.isEmpty() and not b.isEmpty()
    assert q.where(F.lit(False)).count() == 0 and tune.halves(q.limit(0)) == ((0, 0), (0, 0))


def test_doc_tree_is_that_of_the_partitioned_writer(spark, tmp_dir):
    """Folders and texts as Spark's partitioned writer makes them, odd ids,
    sources and languages included, and files added to a folder; without its
    commit, which leaves a mark."""
    import os
    from quire.plans import binding
    from quire.sources import files
    rows = [(1, "a\r\nb", "en", "web"), (1, "a\r\nb", "en", "web"), (2, None, "en", "x=y/z #é"), (3, "c", "en", None), (4, "d", None, "web"),
            (5, "", "de", "web"), (5, "", "de", "web"), (None, "f", "fr", ""), (6, "g", "en", ""), (-7, "ü", "en", "a%b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    en = F.col("lang") == "en"
    for summary in (True, False):
        binding.write_doc_tree(docs, tmp_dir + "/tree", summary=summary)
        docs.where(en).select("source", "doc_id", "text").write.mode("append").partitionBy("source", "doc_id").text(tmp_dir + "/spark")
        docs.where(~en | F.col("lang").isNull()).select("doc_id", "text").write.mode("append").partitionBy("doc_id").text(tmp_dir + "/spark")

    def texts(name):
        t = files.scan_tree(spark, f"{tmp_dir}/{name}", exts=[".txt"])
        return sorted((os.path.dirname(r.rel_path), r.contents) for r in t.select("rel_path", "contents").collect())
    assert texts("tree") == texts("spark") and len(texts("tree")) == 16


@pytest.mark.parametrize("sent", [0, 100])
def test_kmeans_over_many_cells(spark, monkeypatch, sent):
    """Parts of the terms and chunks of the points, with the centroids sent or
    dealt, give Lloyd's steps of a plain version; repeated elements add up."""
    import random
    monkeypatch.setattr(cluster, "PART_TERMS", 7)
    monkeypatch.setattr(cluster, "SENT_PARTS", sent)
    r = random.Random(5)
    rows = [(i * 3, f"t{r.randrange(40)}", float(r.randint(1, 5))) for i in range(600) for _ in range(r.randint(1, 6))]
    vecs, pp = {}, {}
    for i, t, w in rows:
        vecs.setdefault(i, {})
        vecs[i][t] = vecs[i].get(t, 0.0) + w
        pp[i] = pp.get(i, 0.0) + w * w
    cents = [dict(vecs[i]) for i in sorted(vecs)[:3]]
    mem = None
    while True:
        cc = [sum(w * w for w in c.values()) for c in cents]
        dist = {i: [math.sqrt(max(pp[i] - 2 * sum(w * c.get(t, 0.0) for t, w in v.items()) + n, 0.0)) for c, n in zip(cents, cc)] for i, v in vecs.items()}
        new = {i: min(range(3), key=lambda j: (round(d[j], 9), j)) for i, d in dist.items()}
        if new == mem:
            break
        mem = new
        for j in range(3):
            own = [i for i in mem if mem[i] == j]
            cents[j] = {}
            for i in own:
                for t, w in vecs[i].items():
                    cents[j][t] = cents[j].get(t, 0.0) + w / len(own)
    got = cluster.fit(spark.createDataFrame(rows, "doc_id long, term string, w double"), 3)
    assert {x.doc_id: (x.cluster, round(x.dist, 6)) for x in got.assignment.collect()} == {i: (mem[i], round(dist[i][mem[i]], 6)) for i in mem}
    assert {(x.cluster, x.term): round(x.w, 9) for x in got.centroids.collect()} == {
        (j, t): round(w, 9) for j in range(3) for t, w in cents[j].items()}
