"""Judgements from shared runs of words are found among a text's words, and
equal the join of all shingles."""
import random

import pytest
from pyspark.sql import functions as F

from quire.plans import binding
from quire.plans.binding import shingle_qrels, shingles


def _rows(spark):
    rng = random.Random(3)
    words = ["été", "the", "Of", "x_1", "naïve", "don't", "3.5", "ß", "名前", "l’an", "", "--"]
    text = lambda n: rng.choice([" ", "\n", ", "]).join(rng.choice(words) for _ in range(n))
    texts = [text(n) for n in range(60)] + [None, "", "the of", " the  of-x_1 ", "THE OF X_1"]
    docs = [(i if i != 7 else None, t) for i, t in enumerate(texts)] + [(3, texts[20])]
    queries = [(i, text(8)) for i in range(12)] + [(99, None), (98, "of"), (None, "the of x_1"), (5, "été the of")]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, text string"))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_same_pairs_as_the_join_of_all_shingles(spark, monkeypatch, n):
    monkeypatch.setattr(binding, "SLICE", 200)
    docs, queries = _rows(spark)
    want = shingles(docs, "doc_id", n=n).join(shingles(queries, "query_id", n=n), "shingle").select("query_id", "doc_id").distinct()
    got = shingle_qrels(docs, queries, n)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert got.count() > 20


def test_document_shingles_are_no_rows(spark, monkeypatch):
    """Only runs that a query has become rows of a join."""
    docs, queries = _rows(spark)
    seen = []
    monkeypatch.setattr(binding, "materialize", lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    shingle_qrels(docs, queries).collect()
    documents = [line for line in seen[0].splitlines() if "Generate explode" in line]
    assert len(documents) == 1   # the queries' own


def test_no_shingles_give_no_pairs(spark):
    docs, queries = _rows(spark)
    assert shingle_qrels(docs, queries.where(F.col("query_id") == 98)).count() == 0
    assert shingle_qrels(docs.limit(0), queries).count() == 0
