"""DuckDB reference SQL for the registered queries.

These strings are the independent check of the Spark plans: they recompute
every result from the raw driver tables with plain SQL (no shared code with
the Spark side). Fragments are composed as CTE chains.
"""

from __future__ import annotations

from quire.functions.text import TOKEN_PATTERN, WORD_PATTERN


def _q(s: str) -> str:
    return s.replace("'", "''")


TOK = _q(TOKEN_PATTERN)
WORD = _q(WORD_PATTERN)

# documents -> tokens, postings, lengths
DOCS = f"""
dt AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '{TOK}', 0), []::VARCHAR[]) AS toks FROM documents),
tok AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM dt),
post AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
dl AS (SELECT doc_id, CAST(len(toks) AS BIGINT) AS dl FROM dt),
ndocs AS (SELECT count(*) AS n_docs FROM documents),
tstat AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM post GROUP BY term),
idf AS (SELECT term, df, cf, log10(n_docs / df) AS idf FROM tstat, ndocs)"""


def queries_cte(where: str = "TRUE") -> str:
    """``qsel(query_id, text)`` and ``qt(query_id, term, qtf)``."""
    return f"""
qsel AS (SELECT item_id AS query_id, text FROM benchmark WHERE {where}),
qt AS (SELECT query_id, term, count(*) AS qtf FROM (
        SELECT query_id, unnest(regexp_extract_all(lower(replace(replace(text, '(', ''), ')', '')), '{TOK}', 0)) AS term
        FROM qsel) GROUP BY query_id, term)"""


QRELS = f"""
bw AS (SELECT item_id AS query_id, regexp_extract_all(lower(text), '{WORD}', 0) AS w FROM benchmark),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}', 0) AS w FROM documents),
bs AS (SELECT DISTINCT query_id, array_to_string(w[i:i+2], ' ') AS shingle FROM (
        SELECT query_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM bw WHERE len(w) >= 3)),
ds AS (SELECT doc_id, array_to_string(w[i:i+2], ' ') AS shingle FROM (
        SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM dw WHERE len(w) >= 3)),
qrels AS (SELECT DISTINCT query_id, doc_id FROM bs JOIN ds USING (shingle))"""


def scores_cte(model: str = "tfidf", lambdas: list[float] | None = None, add_one: bool = False) -> str:
    """``sc(query_id, doc_id, score)`` (plus ``lambda`` for JM) over matching
    docs; needs DOCS and queries_cte."""
    common = """
ctot AS (SELECT count(*) AS n_f, CAST(sum(dl) AS BIGINT) AS t_f FROM dl WHERE dl > 0),
qts AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM post WHERE term IN (SELECT term FROM qt) GROUP BY term)"""
    if model == "tfidf":
        return common + """,
sc AS (SELECT q.query_id, p.doc_id,
              sum(q.qtf * (1 + ln((ctot.n_f + 1) / (s.df + 1))) * sqrt(p.tf) / sqrt(d.dl)) AS score
       FROM qt q JOIN post p ON p.term = q.term JOIN qts s ON s.term = q.term
            JOIN dl d ON d.doc_id = p.doc_id, ctot
       GROUP BY q.query_id, p.doc_id)"""
    lams = ", ".join(repr(float(x)) for x in (lambdas or [0.5]))
    prob = "(s.cf + 1) / (ctot.t_f + 1)" if add_one else "s.cf / ctot.t_f"
    return common + f""",
lam AS (SELECT unnest([{lams}]::DOUBLE[]) AS lam_v),
sc AS (SELECT round(l.lam_v, 1) AS lam_v, q.query_id, p.doc_id,
              sum(q.qtf * ln(1 + ((1 - l.lam_v) * (p.tf / d.dl)) / (l.lam_v * {prob}))) AS score
       FROM qt q JOIN post p ON p.term = q.term JOIN qts s ON s.term = q.term
            JOIN dl d ON d.doc_id = p.doc_id, ctot, lam l
       GROUP BY l.lam_v, q.query_id, p.doc_id)"""


def hits_cte(k: int, run_cols: str = "") -> str:
    """``hits(run_cols.., query_id, doc_id, score, rank)`` top ``k`` and
    ``th`` total hits; needs ``sc``."""
    part = f"{run_cols}, query_id" if run_cols else "query_id"
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sc),
hits AS (SELECT * FROM ranked WHERE rank <= {k}),
th AS (SELECT {part}, count(*) AS total_hits FROM sc GROUP BY {part})"""


def metrics_cte(k: int, run_cols: str = "", run_values: str = "") -> str:
    """``m(run_cols.., query_id, p, recall, ap)``; needs ``hits``, ``th``,
    ``qrels`` and ``qsel``. ``run_values`` is a FROM item listing the run
    keys (e.g. the lambda table) when ``run_cols`` is set."""
    part = f"{run_cols}, query_id" if run_cols else "query_id"
    grid_from = f"jq CROSS JOIN {run_values}" if run_cols else "jq"
    using = f"{run_cols}, query_id" if run_cols else "query_id"
    return f"""
jq AS (SELECT query_id, count(*) AS n_rel FROM qrels WHERE query_id IN (SELECT query_id FROM qsel) GROUP BY query_id),
jh AS (SELECT h.*, (r.doc_id IS NOT NULL) AS rel FROM hits h LEFT JOIN qrels r USING (query_id, doc_id)),
jr AS (SELECT *, sum(CAST(rel AS BIGINT)) OVER (PARTITION BY {part} ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM jh),
pq AS (SELECT {part}, CAST(sum(CAST(rel AS BIGINT)) AS BIGINT) AS vp,
              sum(CASE WHEN rel THEN so_far / rank ELSE 0.0 END) AS ap_sum FROM jr GROUP BY {part}),
m AS (SELECT {part},
             coalesce(vp / least({k}, total_hits), 0.0) AS p,
             coalesce(vp / n_rel, 0.0) AS recall,
             coalesce(ap_sum / n_rel, 0.0) AS ap
      FROM {grid_from} LEFT JOIN pq USING ({using}) LEFT JOIN th USING ({using}))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes if c.strip())


def kmeans_ctes(points: str, k: int, iters: int, prefix: str = "km") -> tuple[str, str, str]:
    """CTEs unrolling ``iters`` k-means steps from the first ``k`` points by
    doc_id; returns (ctes, last assignment name, last centroid name).
    ``points`` names a CTE ``(doc_id, term, w)``."""
    p = prefix
    parts = [f"""
{p}pn AS MATERIALIZED (SELECT doc_id, sum(w * w) AS pp FROM {points} GROUP BY doc_id),
{p}c0 AS MATERIALIZED (SELECT r.cluster, x.term, x.w FROM {points} x JOIN (
          SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER) AS cluster
          FROM (SELECT DISTINCT doc_id FROM {points}) ORDER BY doc_id LIMIT {k}) r USING (doc_id))"""]
    for i in range(1, iters + 1):
        c, a = f"{p}c{i - 1}", f"{p}a{i}"
        parts.append(f"""
{p}cn{i} AS (SELECT cluster, sum(w * w) AS cc FROM {c} GROUP BY cluster),
{p}dt{i} AS (SELECT x.doc_id, c.cluster, sum(x.w * c.w) AS dot FROM {points} x JOIN {c} c USING (term) GROUP BY x.doc_id, c.cluster),
{p}dd{i} AS (SELECT g.doc_id, g.cluster, sqrt(greatest(g.pp - 2 * coalesce(d.dot, 0) + coalesce(n.cc, 0), 0)) AS dist
        FROM (SELECT doc_id, pp, CAST(unnest(range(0, {k})) AS INTEGER) AS cluster FROM {p}pn) g
        LEFT JOIN {p}dt{i} d USING (doc_id, cluster) LEFT JOIN {p}cn{i} n USING (cluster)),
{a} AS MATERIALIZED (SELECT doc_id, cluster, dist FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(dist, 9), cluster) AS o
        FROM {p}dd{i}) WHERE o = 1),
{p}sz{i} AS (SELECT cluster, count(*) AS size FROM {a} GROUP BY cluster),
{p}c{i} AS MATERIALIZED (SELECT a.cluster, x.term, sum(x.w) / s.size AS w FROM {points} x JOIN {a} a USING (doc_id) JOIN {p}sz{i} s USING (cluster)
        GROUP BY a.cluster, x.term, s.size
        UNION ALL SELECT cluster, term, w FROM {c} WHERE cluster NOT IN (SELECT cluster FROM {p}sz{i}))""")
    return ",".join(x.strip("\n") for x in parts), f"{p}a{iters}", f"{p}c{iters}"


def kmeans_once_ctes(iters: int, prefix: str = "km") -> str:
    """After ``kmeans_ctes``: ``settled(cluster, i)``, the first step in which
    a cluster's centroid stayed as it was (an empty cluster's does), and
    ``steps(i, doc_id, cluster)``."""
    p = prefix
    same = " UNION ALL ".join(
        f"SELECT coalesce(x.cluster, y.cluster) AS cluster, {i} AS i, max(abs(coalesce(x.w, 0) - coalesce(y.w, 0))) AS far "
        f"FROM {p}c{i} x FULL JOIN {p}c{i - 1} y ON x.cluster = y.cluster AND x.term = y.term GROUP BY 1" for i in range(1, iters + 1))
    steps = " UNION ALL ".join(f"SELECT {i} AS i, doc_id, cluster FROM {p}a{i}" for i in range(1, iters + 1))
    return f"""
settled AS (SELECT cluster, min(i) AS i FROM ({same}) WHERE far <= 1e-12 GROUP BY cluster),
steps AS ({steps})"""
