"""URL filter with redirect equivalence.

Explicit rules ``(action, host, path)`` judge a URL by its own host and path;
the longest fitting rule wins. A URL that no rule fits takes the decision of
its equivalence class: the connected component over canonical-link and
redirect edges. Edges come from

* ``<link rel="canonical" href=...>`` and ``<meta property="og:url" content=...>``,
* ``<meta http-equiv="refresh" content="0; url=...">``,
* the canonical form of the URL itself (no scheme, ``www.`` or ``m.`` label,
  fragment, ``utm_*``/``ref`` parameters, ``.html`` or final slash),
* any further ``(src, dst)`` table of known redirects.

Within a class an explicit allow takes precedence over any block; a class
without a rule is allowed. Everything is built-in functions: rules are a short
literal list, and components run over the distinct edges only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.llm.tables import read

# The rules of the query's contract, as (action, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAGS = r"(?i)<(?:link|meta)\s[^>]*>"
LINKING = r"""(?i)(rel\s*=\s*["']?canonical|property\s*=\s*["']?og:url|http-equiv\s*=\s*["']?refresh)"""
TARGET = r"""(?i)(?:\shref\s*=\s*|\scontent\s*=\s*["']?[0-9]+\s*[;,]\s*url\s*=\s*|\scontent\s*=\s*)["']?([^"'\s>]+)"""


REFRESH = r"""(?i)http-equiv\s*=\s*["']?refresh"""
REFRESH_TO = r"""(?i)\scontent\s*=\s*["']?[0-9]+\s*[;,]\s*url\s*="""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null when there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    """Host of a URL, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """Path of a URL up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _query(url: Column) -> Column:
    """Query string without tracking parameters, with its question mark."""
    q = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_join(F.filter(F.split(q, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_[^=]*|ref)(=|$)")), "&")
    return F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")


def node(url: Column) -> Column:
    """A URL without scheme and fragment; null when it has no host."""
    q = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.when(host(url) != "", F.concat(host(url), path(url), q))


def canonical(url: Column) -> Column:
    """Canonical form of a URL's node; null when it has no host."""
    h = F.regexp_replace(host(url), r"^(www|m)\.", "")
    p = F.regexp_replace(path(url), r"(/index)?\.html?$|/+$", "")
    return F.when(host(url) != "", F.concat(h, p, _query(url)))


def rule_of(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``struct(n, allow, rule, action)`` of the longest fitting rule (allow
    before block at one length), else null."""
    fits = [F.when(((h == rh) | h.endswith("." + rh)) & p.startswith(rp),
                   F.struct(F.lit(len(rh + rp)).alias("n"), F.lit(a == "allow").alias("allow"), F.lit(rh + rp).alias("rule"), F.lit(a).alias("action")))
            for a, rh, rp in rules]
    if not fits:
        return F.lit(None).cast("struct<n:int,allow:boolean,rule:string,action:string>")
    return F.array_max(F.array(*fits))


def relative(url: Column, ref: Column) -> Column:
    """The URL that a page-relative reference (``x``, ``../x``, ``?q``) names on
    the page ``url``; null for other schemes, fragments and empty references."""
    to, tail = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    folder = F.when(path(url) == "", "/").otherwise(F.regexp_replace(path(url), r"[^/]*$", ""))
    whole = F.regexp_replace(F.concat(folder, to), r"/(\.\.?)$", "/$1/")
    up = lambda a, s: F.when(s != "..", F.concat(a, F.array(s))).when(F.size(a) > 1, F.slice(a, 1, F.size(a) - 1)).otherwise(a)
    parts = F.aggregate(F.filter(F.split(whole, "/"), lambda s: s != "."), F.array().cast("array<string>"), up)
    there = F.when(to == "", path(url)).otherwise(F.array_join(parts, "/"))
    return F.when((ref != "") & ~ref.startswith("#") & ~ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(F.lit("http://"), host(url), there, tail))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Distinct ``(a, b)`` alias edges with the URL of both ends as nodes."""
    u = F.col("url")
    tags = F.filter(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TAGS), F.lit(0)), lambda t: t.rlike(LINKING))
    # a refresh without a target holds nothing but its delay
    to = F.transform(tags, lambda t: F.struct(F.regexp_extract(t, TARGET, 1).alias("t"), (~t.rlike(REFRESH) | t.rlike(REFRESH_TO)).alias("named")))
    full = F.transform(to, lambda x: F.when(x["t"].contains("://"), x["t"])
                       .when(x["t"].startswith("//"), F.concat(F.lit("http:"), x["t"]))
                       .when(x["t"].startswith("/"), F.concat(F.lit("http://"), host(u), x["t"]))
                       .when(x["named"], relative(u, x["t"])))
    links = pages.where(host(u) != "").select("url", F.explode(F.array_compact(full)).alias("dst"))
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("src").alias("url"), "dst"))
    d = F.col("dst")
    own = pages.select(node(u).alias("a"), canonical(u).alias("b"))
    hops = links.select(node(u).alias("a"), node(d).alias("b"))
    ends = links.select(node(d).alias("a"), canonical(d).alias("b"))
    return own.unionByName(hops).unionByName(ends).where("a <> b").distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: ``page_id, url, host,
    path, rule, verdict, alias_class``.

    Null or malformed URLs have an empty host, fit no rule, belong to no class
    and are allowed. Repeated rows stay repeated. Other columns are ignored.
    An empty table gives no rows.
    """
    p = pages.select("page_id", "url", "html")
    edges = alias_edges(p, redirects)
    of = components(edges, "url-classes")
    u = F.col("url")
    judged = p.select("page_id", "url", host(u).alias("host"), path(u).alias("path"), node(u).alias("node"))
    judged = judged.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    # decisions of all members of a class: the URLs of pages and of link targets
    cut = F.regexp_extract("node", r"^([^/?#]*)([^?#]*)", 1), F.regexp_extract("node", r"^([^/?#]*)([^?#]*)", 2)
    act = rule_of(cut[0], cut[1], rules)["action"]
    votes = of.groupBy("component").agg(F.max(act == "allow").alias("allow"), F.max(act == "block").alias("block"))
    of = of.join(votes, "component")
    out = judged.join(of, "node", "left")
    by_class = F.when(F.col("allow"), "allow").when(F.col("block"), "block").otherwise("allow")
    return out.select("page_id", "url", "host", "path", F.col("r.rule").alias("rule"),
                      F.coalesce("r.action", by_class).alias("verdict"),
                      F.coalesce("component", "node").alias("alias_class"))


def op1_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of ``pages`` judged under ``RULES`` and its alias class."""
    return judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "alias_class")
