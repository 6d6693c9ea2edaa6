"""DuckDB SQL for the operators whose results SQL can express.

Every statement reads whole tables; the fixed values (rules, window sizes,
thresholds) are those of the operators' contracts.
"""

from __future__ import annotations

_TAGS = r"<(?:link|meta)\s[^>]*>"
_LINKING = r"""(rel\s*=\s*["']?canonical|property\s*=\s*["']?og:url|http-equiv\s*=\s*["']?refresh)"""
_TARGET = r"""(?:\shref\s*=\s*|\scontent\s*=\s*["']?[0-9]+\s*[;,]\s*url\s*=\s*|\scontent\s*=\s*)["']?([^"'\s>]+)"""


def _q(s: str) -> str:
    return s.replace("'", "''")


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rest(u: str) -> str:
    return f"(CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) END)"


def _host(u: str) -> str:
    return f"coalesce({_lower(f'regexp_extract({_rest(u)}, $$^([^/?#]*)$$, 1)')}, '')"


def _path(u: str) -> str:
    return f"coalesce(regexp_extract({_rest(u)}, '^[^/?#]*([^?#]*)', 1), '')"


def _node(u: str) -> str:
    return (f"(CASE WHEN {_host(u)} <> '' THEN {_host(u)} || {_path(u)} || "
            f"coalesce(regexp_extract({_rest(u)}, '^[^?#]*(\\?[^#]*)', 1), '') END)")


def _canonical(u: str) -> str:
    q = f"coalesce(regexp_extract({_rest(u)}, '^[^?#]*\\?([^#]*)', 1), '')"
    kept = (f"array_to_string(list_filter(string_split({q}, '&'), lambda x: x <> '' AND NOT "
            f"regexp_matches(x, '^(utm_[^=]*|ref)(=|$)')), '&')")
    return (f"(CASE WHEN {_host(u)} <> '' THEN regexp_replace({_host(u)}, '^(www|m)\\.', '') || "
            f"regexp_replace({_path(u)}, '(/index)?\\.html?$|/+$', '') || "
            f"(CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END) END)")


def _rule(h: str, p: str) -> str:
    """Longest fitting rule; the five rules nest, so the longest comes first."""
    def fits(rh, rp):
        return f"(({h} = '{rh}' OR ends_with({h}, '.{rh}')) AND starts_with({p}, '{rp}'))"
    return ("(CASE WHEN " + fits("www.example.com", "/en/") + " THEN 'www.example.com/en/' WHEN "
            + fits("example.com", "/en/") + " THEN 'example.com/en/' WHEN "
            + fits("net", "/es/") + " THEN 'net/es/' WHEN " + fits("net", "/fr/") + " THEN 'net/fr/' WHEN "
            + fits("com", "/") + " THEN 'com/' END)")


_ACTION = "(CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END)"

OP1 = f"""
WITH RECURSIVE link AS (
  SELECT url, unnest(list_filter(regexp_extract_all(coalesce(html, ''), '{_q(_TAGS)}', 0, 'i'),
                                 lambda t: regexp_matches(t, '{_q(_LINKING)}', 'i'))) AS tag
  FROM pages WHERE {_host('url')} <> ''),
target AS (SELECT url, regexp_extract(tag, '{_q(_TARGET)}', 1, 'i') AS t FROM link),
hop AS (
  SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
                   WHEN starts_with(t, '/') THEN 'http://' || {_host('url')} || t END AS dst FROM target),
edge AS (
  SELECT DISTINCT a, b FROM (
    SELECT {_node('url')} AS a, {_canonical('url')} AS b FROM pages
    UNION ALL SELECT {_node('url')}, {_node('dst')} FROM hop
    UNION ALL SELECT {_node('dst')}, {_canonical('dst')} FROM hop) WHERE a <> b),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(n, m) AS (
  SELECT DISTINCT a, a FROM both_ways
  UNION SELECT r.n, e.b FROM reach r JOIN both_ways e ON r.m = e.a),
class AS (SELECT n AS node, min(m) AS component FROM reach GROUP BY n),
member AS (
  SELECT component, {_ACTION} AS action FROM (
    SELECT component, {_rule("regexp_extract(node, '^([^/?#]*)', 1)", "regexp_extract(node, '^[^/?#]*([^?#]*)', 1)")} AS rule
    FROM class)),
vote AS (
  SELECT component, CASE WHEN bool_or(action = 'allow') THEN 'allow' WHEN bool_or(action = 'block') THEN 'block'
                         ELSE 'allow' END AS verdict FROM member GROUP BY component),
judged AS (
  SELECT page_id, {_host('url')} AS host, {_path('url')} AS path, {_node('url')} AS node FROM pages),
ruled AS (SELECT *, {_rule('host', 'path')} AS rule FROM judged)
SELECT page_id, host, path, rule, coalesce({_ACTION}, vote.verdict, 'allow') AS verdict,
       coalesce(component, node) AS alias_class
FROM ruled LEFT JOIN class USING (node) LEFT JOIN vote USING (component)
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""


def _cheapest(*options: str) -> str:
    """Smallest of several ``{c, a}`` structs: cost, then audit."""
    return f"list_min([{', '.join(options)}])"


def _more(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


def _inserts(s: list[str]) -> str:
    """The four states, closed under insertions."""
    two = _cheapest(s[2], _more(s[0], "2", "I"), _more(s[1], "2", "I"), _more(s[3], "2", "I"))
    three = _cheapest(s[3], _more(s[2], "2", "I"), _more(s[0], "4", "II"), _more(s[1], "4", "II"))
    return f"[{s[0]}, {s[1]}, {two}, {three}]"


def _written(before: list[str], to: str) -> str:
    """A row written as ``to``: kept where its initial fits, else with another role."""
    cost = f"CASE WHEN f IN ('b', 'd') THEN {_NEVER} WHEN f = 't' THEN 1 ELSE 0 END"
    keep = f"(CASE WHEN i = '{to}' THEN 0 ELSE {_NEVER} END + {cost})"
    out = [_more(s, keep, "K") for s in before]
    return ", ".join(out + ([] if to == "s" else [_more(s, f"(2 + {cost})", "R") for s in before]))


_NEVER = 1 << 40
_ST = [f"s[{i}]" for i in range(1, 5)]
_OP11_STEP = "[" + ", ".join([
    _cheapest(_more(_ST[0], "3", "D")),
    _cheapest(_more(_ST[1], "3", "D"), _written(_ST[:1], "s")),
    _cheapest(_more(_ST[2], "3", "D"), _written([_ST[0], _ST[1], _ST[3]], "u")),
    _cheapest(_more(_ST[3], "3", "D"), _written([_ST[2]], "a"))]) + "]"

OP11 = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda acc, b: list_reduce(range(8), lambda t, j: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END, xor(acc, b)),
      4294967295), 4294967295) % 20 AS kind FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS time FROM placed),
lines AS (
  SELECT conv_id, n, turn, role, text, substr(role, 1, 1) AS i,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN time > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS f,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM seen),
counts AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
         count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM lines GROUP BY conv_id),
walk(conv_id, n, s) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), [{{'c': CAST(0 AS BIGINT), 'a': ''}}, {{'c': {_NEVER}, 'a': ''}}, {{'c': 2, 'a': 'I'}}, {{'c': 4, 'a': 'II'}}]
  FROM conversations
  UNION ALL
  SELECT conv_id, n, {_inserts(_ST)} FROM (
    SELECT w.conv_id, l.n, {_OP11_STEP} AS s FROM walk w JOIN lines l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.n + 1)),
best AS (
  SELECT w.conv_id, list_min([w.s[1], w.s[4]]) AS b FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.n = coalesce(c.rows, 0)),
edits AS (
  SELECT conv_id, unnest(string_split(b.a, '')) AS e, generate_subscripts(string_split(b.a, ''), 1) AS pos FROM best WHERE b.a <> ''),
done AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS n, count(*) FILTER (e <> 'D') OVER w AS o FROM edits
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kept AS (
  SELECT d.conv_id, d.o, d.e, l.role, CASE WHEN d.e = 'I' THEN '' ELSE l.text END AS text,
         max(CASE WHEN d.o = 1 AND d.e = 'K' AND l.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY d.conv_id) AS system
  FROM done d LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM d.conv_id AND l.n = d.n WHERE d.e <> 'D'),
told AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY o) AS t FROM kept GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(b.b.c AS BIGINT) AS cost, b.b.a AS audit,
       sha256(coalesce(t.t, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM b.conv_id
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM scored WHERE same) WHERE n <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

_WORDS = "'[^\\x20\\x09-\\x0D]+'"

OP7 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM (
    SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w WHERE len(ws) >= 50)),
seen AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN seen USING (k) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORDS}) AS ws FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS k FROM (
    SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(n, m) AS (SELECT DISTINCT a, a FROM ways UNION SELECT r.n, e.b FROM reach r JOIN ways e ON r.m = e.a),
class AS (SELECT n AS doc_id, min(m) AS component FROM reach GROUP BY n)
SELECT w.doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN size USING (doc_id) LEFT JOIN class USING (doc_id)
"""
