"""URL classes and exact top-k search."""

import numpy as np

from quire.llm import topk, urls
from quire.llm.components import components

PAGES = "page_id long, url string, html string, host string, rule string, node string"


def pages(spark, given):
    return spark.createDataFrame([(i, u, h, "h", "r", "n") for i, u, h in given], PAGES)


def verdicts(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_rules_and_malformed(spark):
    got = verdicts(urls.judge(pages(spark, [
        (1, "http://A.Example.com/en/x?q#f", ""), (2, "https://www.example.com/en/x", None), (3, "http://b.www.example.com/en/", ""),
        (4, "http://x.net/es/1", ""), (5, "http://x.net/de/1", ""), (6, None, ""), (7, "no scheme", ""), (8, "http://example.com", ""),
        (9, "http://notexample.com/en/", ""), (10, "http://", ""), (11, "a://b://c/d", ""), (11, "a://b://c/d", "")])))
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[2][2:] == ("www.example.com/en/", "allow") and got[3][2:] == ("www.example.com/en/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == (None, "allow")
    assert got[6] == got[7] == ("", "", None, "allow") and got[10] == ("", "", None, "allow")
    assert got[8] == ("example.com", "", None, "allow") and got[9][2:] == ("com/", "allow")
    assert got[11] == ("b:", "//c/d", None, "allow")


def test_links_carry_blocks_and_allow_wins(spark):
    link = '<link rel="canonical" href="{}">'.format
    got = verdicts(urls.judge(pages(spark, [
        (1, "http://a.org/1", link("http://x.net/es/1")),                                  # alias of a blocked url
        (2, "http://b.org/2", '<META HTTP-EQUIV="refresh" content="0; url=http://a.org/1">'),   # two hops away
        (3, "http://c.org/3", link("http://x.net/fr/3") + link("http://ok.com/3")),        # block and allow: allow
        (4, "http://x.net/fr/3", ""), (5, "http://d.org/5", link("/other")), (6, "http://a.org/1/", ""),
    ])))
    assert [got[i][3] for i in range(1, 7)] == ["block", "block", "allow", "block", "allow", "block"]
    extra = spark.createDataFrame([("http://d.org/5", "http://z.net/es/")], "src string, dst string")
    assert verdicts(urls.judge(pages(spark, [(5, "http://d.org/5", None)]), redirects=extra))[5][3] == "block"
    assert urls.judge(pages(spark, [])).collect() == []


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(200)} | {1000 + i: 1000 for i in range(61)}


def brute(vectors, k):
    ok = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in vectors
          if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    v = [(i, [float(x) for x in np.round(rng.normal(0, 0.3, 6), 1)]) for i in range(700)]
    v += [(i, [0.5, 0.5, 0.0, 0.0, -0.5, 0.1]) for i in range(700, 900)]      # many ties
    v += [(1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (1100, [0.0] * 6), (1200, []), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in v], "vec_id long, embedding array<float>, label int, v int")
    v = [(i, None if x is None else [None if y is None else float(np.float32(y)) for y in x]) for i, x in v]
    q = topk.quantised(df)
    for block in (64, 8192):
        got = topk.top_k(q, q.where("vec_id % 100 = 0"), block=block, chunk=3)
        assert sorted(tuple(r) for r in got.collect()) == brute(v, 10)


def test_top_k_stops_early_and_small_tables(spark):
    ids, rows = np.arange(5000), np.random.default_rng(1).integers(-5, 5, (5000, 4))
    rows[17] = [900, 900, 900, 900]
    got, score, depth = topk.Block(ids, rows).top(np.array([3, 2, 1, 1]), -1, 1)
    assert got.tolist() == [17] and score.tolist() == [6300] and depth < 5000
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    q = topk.quantised(few)
    assert [tuple(r) for r in topk.top_k(q, q.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    none = topk.quantised(few.limit(0))
    assert topk.top_k(none, none).collect() == []
