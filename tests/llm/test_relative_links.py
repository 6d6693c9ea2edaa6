"""Link targets that are relative to the page."""

from quire.llm import urls
from tests.llm.test_urls_topk import pages, verdicts


def test_page_relative_targets(spark):
    link = '<link rel="canonical" href="{}">'.format
    refresh = '<meta http-equiv="refresh" content="{}">'.format
    cases = [("http://a.org/d/e/p.html?x=1", link("other.html"), "a.org/d/e/other.html"), ("http://a.org/d/e/p", link("../x"), "a.org/d/x"),
             ("http://a.org/d/e/p", link("?id=2"), "a.org/d/e/p?id=2"), ("http://a.org/d/e/p", link("./x/./y/"), "a.org/d/e/x/y/"),
             ("http://a.org/d/e/p", link("../../../x?q=a/../b#f"), "a.org/x?q=a/../b"), ("http://a.org", link("x"), "a.org/x"),
             ("http://a.org/d/e/p", link(".."), "a.org/d/"), ("http://a.org/d/p", refresh("0; url=q"), "a.org/d/q"),
             ("http://a.org/d/p", refresh("5"), None), ("http://a.org/d/p", link("#top"), None), ("http://a.org/d/p", link("mailto:x"), None),
             ("http://a.org/d/p", link(""), None), ("http://a.org/d/p", link("/r"), "a.org/r"), ("http://a.org/d/p", link("//b.org/r"), "b.org/r")]
    for i, (u, html, to) in enumerate(cases):
        cases[i] = (i, u.replace("a.org", f"a{i}.org"), html, None if to is None else to.replace("a.org", f"a{i}.org"))
    got = {(r.a, r.b) for r in urls.alias_edges(pages(spark, [c[:3] for c in cases])).collect()}
    want = {(u.split("://")[1], to) for _, u, _, to in cases if to is not None}
    plain = {(r.a, r.b) for r in urls.alias_edges(pages(spark, [(i, u, "") for i, u, *_ in cases])).collect()}
    ends = spark.createDataFrame([(f"http://{to}",) for *_, to in cases if to is not None], "u string")
    ends = {tuple(r) for r in ends.select(urls.node(urls.F.col("u")), urls.canonical(urls.F.col("u"))).collect()}
    assert got == want | plain | {(a, b) for a, b in ends if a != b}


def test_relative_links_carry_a_block(spark):
    got = verdicts(urls.judge(pages(spark, [
        (1, "http://a.org/d/1.html", '<link rel="canonical" href="../e/2">'), (2, "http://a.org/e/2", '<link rel="canonical" href="http://x.net/es/1">')])))
    assert got[1][3] == got[2][3] == "block"
