"""Sums by span inside a task: ranking and similarity against plain Python."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from quire.operators import analysis, retrieval, spans, vectors
from quire.operators.index import SPAN, Index

LAMS = [0.3, 0.7, 1.0]


def texts(n, seed=5):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [(i * 11 - 900, " ".join(r.choices(words, weights=[1 / (j + 1) for j in range(40)], k=r.randint(0, 60)))) for i in range(n)]
    return rows + [(20_000 + i, "w38 w39") for i in range(12)]   # ties


@pytest.fixture
def index(spark, tmp_dir):
    docs = spark.createDataFrame(texts(300), "doc_id long, text string")
    return Index(spark, tmp_dir + "/ix").add(docs, buckets=4, positions=False)


def test_only_the_best_of_a_query_leave_a_task(spark, index):
    q = spark.createDataFrame([(1, "w0 w1 w2"), (-2, "w38 w39 w38"), (3, "w7 w20"), (4, "nothing")], "query_id long, text string")
    terms = analysis.query_terms(q)
    for model, lam, keys in (("tfidf", 0.5, ["query_id"]), ("jm", LAMS, ["lambda", "query_id"])):
        every = retrieval.score(index, terms, model, lam)
        some = retrieval.score(index, terms, model, lam, best=4)
        got, want = ({(*(r[c] for c in keys), r["rank"], r.doc_id, round(r.score, 9)) for r in retrieval.top_k(x, 4, keys).collect()} for x in (some, every))
        assert got == want and len(want) == 3 * 4 * (1 if model == "tfidf" else 3)
        tasks = max(some.rdd.getNumPartitions(), 8)
        assert some.count() <= len(want) * tasks < every.count() * tasks


@pytest.mark.parametrize("small", [False, True])
def test_sums_of_a_span_in_parts(monkeypatch, small):
    if small:
        for name, value in (("QUERIES", 2), ("PAIRS", 7), ("PENDING", 5)):
            monkeypatch.setattr(spans, name, value)
    r, rows, want = random.Random(1), [], {}
    for unit in (-1, 0, 3):
        for term in range(9):
            docs = sorted(r.sample(range(unit * SPAN, unit * SPAN + 20), r.randint(1, 8)))
            tfs, asked = [r.randint(1, 4) for _ in docs], sorted(r.sample(range(5), r.randint(1, 5)))
            ws = [r.choice([0.5, 1.0, 0.0]) for _ in asked]
            rows.append({"unit": unit, "docs": docs, "tfs": tfs, "dls": [9] * len(docs), "queries": asked, "ws": ws, "p": 0.25})
            for q, w in zip(asked, ws):
                for d, tf in zip(docs, tfs):
                    for run, part in enumerate((tf, tf / 9 * 0.25)):
                        want[run, q, d] = want.get((run, q, d), 0.0) + w * part
    schema = pa.schema([("unit", pa.int64()), ("docs", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int64())), ("dls", pa.list_(pa.int64())),
                        ("queries", pa.list_(pa.int64())), ("ws", pa.list_(pa.float64())), ("p", pa.float64())])
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=4)

    def run(k):
        out = spans._runner(lambda tf, dl, p: [tf, tf / dl * p], k, False, False)(iter(batches))
        return {(x["run"], x["query_id"], x["doc_id"]): x["score"] for b in out for x in b.to_pylist()}

    got = run(None)
    assert got.keys() == want.keys() and np.allclose([got[x] for x in want], list(want.values()))
    first = {}
    for run_, q, d in sorted(want, key=lambda x: (x[0], x[1], -np.rint(want[x] * 1e9), x[2])):
        first.setdefault((run_, q), []).append((run_, q, d))
    assert run(3).keys() == {x for v in first.values() for x in v[:3]}


@pytest.mark.parametrize("rep", ["bin", "tf", "tfxidf"])
def test_similar_documents_against_plain_python(spark, tmp_dir, rep):
    rows = [(d, t + " all") for d, t in texts(120)] + [(30_000, "all"), (30_001, None)]   # a vector of only zeros, none at all
    ix = Index(spark, tmp_dir + "/ix").add(spark.createDataFrame(rows, "doc_id long, text string"), buckets=4, positions=False)
    targets = [-900, 20_003, 30_000]
    if rep == "tfxidf":
        rows = rows[:-1]
        ix = Index(spark, tmp_dir + "/all").add(spark.createDataFrame(rows, "doc_id long, text string"), buckets=4, positions=False)
    vec, df = {}, {}
    for d, t in rows:
        for w in (t or "").split():
            vec.setdefault(d, {}).setdefault(w, 0)
            vec[d][w] += 1
    for v in vec.values():
        for w in v:
            df[w] = df.get(w, 0) + 1
    weight = {"bin": lambda w, c: 1.0, "tf": lambda w, c: float(c), "tfxidf": lambda w, c: c * math.log10(len(rows) / df[w])}[rep]
    vec = {d: {w: weight(w, c) for w, c in v.items()} for d, v in vec.items()}
    norm = {d: math.sqrt(sum(x * x for x in v.values())) for d, v in vec.items()}
    want, ranked = {}, set()
    for t in targets:
        cos = {d: sum(x * vec[t].get(w, 0.0) for w, x in v.items()) / (norm[t] * norm[d]) if norm[t] * norm[d] else None for d, v in vec.items() if d != t}
        want |= {(t, d): c for d, c in cos.items()}
        if norm[t]:
            best = sorted(cos, key=lambda d: (cos[d] is None, -round(cos[d] or 0, 9), d))[:6]
            ranked |= {(t, i, d) for i, d in enumerate(best, 1)}
    asked = spark.createDataFrame([(t,) for t in targets], "target long")
    got = {(r.target, r.doc_id): r.cosine for r in vectors.cosine_table(ix, asked, rep).collect()}
    assert got.keys() == want.keys()
    assert all((got[x] is None) == (want[x] is None) and math.isclose(got[x] or 0, want[x] or 0, abs_tol=1e-9) for x in want)
    top = vectors.similar_docs(ix, asked, 6, rep).collect()
    assert {(r.target, r["rank"], r.doc_id) for r in top if norm[r.target]} == ranked
    moved = vectors._norms_by_block(ix, rep, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in moved   # postings stay where they are read
