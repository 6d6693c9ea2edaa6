"""Pattern and phrase clauses against brute force, trees, rank sums, k-means."""

import os
import random
import re
import time
from datetime import datetime, timezone

import pytest

from quire.operators import cluster, compare, predicates, tune
from quire.sinks import reports
from quire.sources import files

CLAUSES = "query_id long, clause_id int, occur string, kind string, text string, boost double, slop int, field string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_patterns_meet_all_their_terms_and_few_others(spark):
    r = random.Random(2)
    terms = sorted({"".join(r.choice("abcé1.'") for _ in range(r.randint(1, 8))) for _ in range(900)} | {"a", "ab", "ba", "abcabc"})
    given = [("fuzzy", t, s) for s in (0, 1, 2, 3) for t in r.sample(terms, 6)] + [("fuzzy", "", 1), ("fuzzy", "zz", 2)]
    given += [("prefix", t, 0) for t in ("a", "ab", "abc", "", "é1")]
    given += [("wildcard", t, 0) for t in ("a*", "*a", "*bc*", "a?c*", "?b*", "*", "??", "a*b*c", "ab", "*.1*")]
    given += [("regex", t, 0) for t in ("ab.*", "a[bc]+.*", ".*bc", "a|b.*", "ab?c*", "(ab)+c?", "a+b+.*", "b{2}.*", "[abc]+", "ab*?c", "a\\.b.*", ".*", "abc.?", "ab+[c1]*")]
    pats = spark.createDataFrame([(i, 1, "f", k, t, s) for i, (k, t, s) in enumerate(given)],
                                 "query_id long, clause_id int, field string, kind string, text string, slop int")
    words = spark.createDataFrame([("f", t) for t in terms] + [("g", "abc")], "field string, term string")
    pairs = predicates.candidate_pairs(words, pats)
    from pyspark.sql import functions as F
    match = predicates._pattern_match(F.col("term"), F.col("kind"), F.col("text"), F.col("slop"))
    rows = pairs.withColumn("ok", match).collect()
    got = {(x.query_id, x.term) for x in rows if x.ok}

    def fits(k, t, s, w):
        if k == "fuzzy":
            return edits(w, t) <= s
        if k == "prefix":
            return w.startswith(t)
        if k == "regex":
            return re.fullmatch(t, w) is not None
        return re.fullmatch("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in t), w) is not None

    assert got == {(i, w) for i, (k, t, s) in enumerate(given) for w in terms if fits(k, t, s, w)}
    seen = {}
    for x in rows:
        seen.setdefault(x.query_id, set()).add(x.term)
    compared = {i: len(v) for i, v in seen.items()}
    for i, (k, t, s) in enumerate(given):
        if k == "fuzzy" and s <= 2 and len(t) > 4:
            assert compared.get(i, 0) < len(terms) / 3
        if (k, t) in (("wildcard", "*bc*"), ("prefix", "abc"), ("regex", "ab.*"), ("regex", ".*bc"), ("regex", "ab+[c1]*")):
            assert compared.get(i, 0) < len(terms) / 4


def sloppy(tokens, words, slop):
    at = [[i - k for i, t in enumerate(tokens) if t == w] for k, w in enumerate(words)]
    freq = 0.0
    for p in at[0]:
        adj = [p]
        for other in at[1:]:
            near = [(abs(q - p), q) for q in other if abs(q - p) <= slop]
            if not near:
                break
            adj.append(min(near)[1])
        else:
            if slop == 0 or max(adj) - min(adj) <= slop:
                freq += 1 / (1 + max(adj) - min(adj))
    return freq


def test_phrases_against_brute_force(spark):
    r = random.Random(4)
    docs = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 30)))) for i in range(60)]
    phrases = [("a b", 0), ("a a", 0), ("a b c", 0), ("a b", 1), ("a c", 2), ("a a", 3), ("a b c", 2), ("c b a", 4), ("a", 2), ("b a b a", 1)]
    cl = spark.createDataFrame([(i, 1, "should", "phrase", t, 1.0, s, "text") for i, (t, s) in enumerate(phrases)], CLAUSES)
    got = {(x.query_id, x.doc_id): x.score for x in predicates.search(spark.createDataFrame(docs, "doc_id long, text string"), cl).collect()}
    import math
    toks = {d: t.split() for d, t in docs}
    n = sum(bool(t) for t in toks.values())
    idf = {w: 1 + math.log((n + 1) / (sum(w in t for t in toks.values()) + 1)) for w in "abc"}
    want = {}
    for i, (t, s) in enumerate(phrases):
        words = t.split()
        for d, tok in toks.items():
            f = sloppy(tok, words, s if len(words) > 1 else 0)
            if f:
                want[i, d] = math.sqrt(f) * sum(idf[w] for w in words) / math.sqrt(len(tok))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_only_named_fields_are_indexed(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "a b", "k1"), (2, "b", None)], "doc_id long, text string, k string")
    boom = F.raise_error(F.lit("not asked for")).cast("string")
    cl = spark.createDataFrame([(1, 1, "must", "term", "k1", 1.0, 0, "k")], CLAUSES)
    assert [r.doc_id for r in predicates.search(docs, cl, {"text": boom}, ["k"]).collect()] == [1]
    none = spark.createDataFrame([(1, 1, "must", "term", "a", 1.0, 0, "absent")], CLAUSES)
    assert predicates.search(docs, none).collect() == []


def test_tree_levels_and_times(spark, tmp_dir):
    for rel in ("a.txt", "b.csv", "x/c.txt", "x/d", "x/y/e.txt", "x/y/z/f.txt", "x.txt/g.txt"):
        os.makedirs(os.path.dirname(f"{tmp_dir}/t/{rel}"), exist_ok=True)
        with open(f"{tmp_dir}/t/{rel}", "w") as f:
            f.write(rel)
    root = f"{tmp_dir}/t"
    for exts in ([".txt"], [".txt", ".csv"], None, [""], [".none"]):
        for depth in (0, 1, 2, 3, 9, None):
            got = {r.rel_path for r in files.scan_tree(spark, root, depth, exts).collect()}
            every = {"a.txt", "b.csv", "x/c.txt", "x/d", "x/y/e.txt", "x/y/z/f.txt", "x.txt/g.txt"}
            assert got == {p for p in every if (depth is None or p.count("/") <= depth)
                           and (exts is None or re.search(r"(\.[^./]*)?$", p.rsplit("/", 1)[-1]).group() in exts)}, (depth, exts)
    moment = files.last_modified(spark, root)
    old, new = 1_000_000_000, 1_600_000_000
    os.utime(f"{root}/a.txt", (old, old))
    os.utime(f"{root}/x/c.txt", (new, new))
    cut = datetime.fromtimestamp(1_300_000_000, timezone.utc)
    names = lambda **k: {r.rel_path for r in files.scan_tree(spark, root, **k).collect()}
    assert names(modified_before=cut) == {"a.txt"}
    assert "x/c.txt" in names(modified_after=cut) and "a.txt" not in names(modified_after=cut)
    assert names(modified_after=moment) == set() and moment.timestamp() >= time.time() - 3600
    with pytest.raises(Exception):
        files.scan_tree(spark, f"{tmp_dir}/absent", 1, [".txt"])


def test_rank_sums_of_ties(spark):
    r = random.Random(1)
    rows = [(i, r.randint(0, 6) / 4, r.randint(0, 6) / 4) for i in range(50)]
    got = compare.wilcoxon(spark.createDataFrame(rows, "query_id long, x double, y double")).first()
    d = sorted((x - y for _, x, y in rows if x != y), key=abs)
    size = [abs(v) for v in d]
    rank = [sum(s < v for s in size) + (size.count(v) + 1) / 2 for v in size]
    assert got.n == len(d) and got.w_plus == sum(k for k, v in zip(rank, d) if v > 0)


def test_bounds_give_the_same_clusters(spark):
    r = random.Random(8)
    pts = [(i, t, float(r.randint(1, 9))) for i in range(80) for t in r.sample("abcdefgh", r.randint(0, 6))]
    got = cluster.fit(spark.createDataFrame(pts, "doc_id long, term string, w double"), 4)
    vec = {}
    for i, t, w in pts:
        vec.setdefault(i, [0.0] * 8)["abcdefgh".index(t)] = w
    ids = sorted(vec)
    cents = [vec[i] for i in ids[:4]]
    far = lambda p, c: sum((x - y) ** 2 for x, y in zip(p, c)) ** 0.5
    before = None
    while True:
        own = {i: min((round(far(vec[i], c), 9), j) for j, c in enumerate(cents))[1] for i in ids}
        if own == before:
            break
        before = own
        for j in range(4):
            m = [vec[i] for i in ids if own[i] == j]
            if m:
                cents[j] = [sum(x) / len(m) for x in zip(*m)]
    rows = {x.doc_id: (x.cluster, x.dist) for x in got.assignment.collect()}
    assert {i: c for i, (c, _) in rows.items()} == own
    assert all(d == pytest.approx(far(vec[i], cents[c])) for i, (c, d) in rows.items())


def test_negative_ids_and_lambda_heads(spark):
    assert tune.parse_range("-3-1") == (-3, 1) and tune.parse_range("-3--1") == (-3, -1) and tune.parse_range("-4") == (-4, -4)
    with pytest.raises(ValueError):
        tune.parse_range("1--1")
    q = spark.createDataFrame([(-3, "a"), (5, "b")], "query_id long, text string")
    one, two = tune.split(q, *tune.halves(q))
    assert [r.query_id for r in one.collect()] == [-3] and [r.query_id for r in two.collect()] == [5]
    m = spark.createDataFrame([(1, 0.5)], "query_id long, ap double")
    assert {r.lambda_head for r in reports.test_report(m, 0.25).collect()} == {"0.25"}
