"""A search's rows of a document are put together where its span lies."""

import re

from pyspark.sql import functions as F

from quire.operators import predicates
from quire.operators.index import Index


def test_only_stored_blocks_move(spark, tmp_dir):
    rows = [(1, "red fox runs"), (2, "fox red"), (3000, "the red fox"), (-5, "redder foxes"), (7, None)]
    ix = Index(spark, tmp_dir + "/ix").add(spark.createDataFrame(rows, "doc_id long, text string"), {"text": F.col("text")}, buckets=2)
    clauses = spark.createDataFrame([(1, 1, "must", "phrase", "red fox"), (1, 2, "should", "prefix", "run"), (2, 1, "should", "regex", "fox.*"),
                                     (2, 2, "must_not", "term", "the")], "query_id long, clause_id int, occur string, kind string, text string")
    found = predicates.search(ix, clauses)
    got = {(r.query_id, r.doc_id): round(r.score, 6) for r in found.collect()}
    assert got.keys() == {(1, 1), (1, 3000), (2, 1), (2, 2), (2, -5)}
    assert got[1, 1] == round(got[1, 3000] + 1, 6) and got[2, 1] == 1.0
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString())
    assert any(x.startswith("span") for x in dealt)
    assert [x for x in dealt if "doc_id" in x and not x.startswith("span")] == []


def test_pattern_clauses_move_places_only(spark, tmp_dir):
    """A pattern's score is constant: neither frequencies nor lengths move, and
    a document is one row however many terms of a clause it holds."""
    docs = spark.createDataFrame([(i, f"abc abd abe{i % 3} xyz{i}") for i in (-5, 0, 1, 1023, 1024, 5000, 1 << 40)] + [(7, None)], "doc_id long, text string")
    ix = Index(spark, tmp_dir + "/ix").add(docs, buckets=2)
    clauses = spark.createDataFrame(
        [(1, 1, "should", "prefix", "ab", 2.0), (1, 2, "should", "regex", "abe[12]", 3.0), (2, 1, "must", "wildcard", "xyz*", 1.0), (2, 2, "must_not", "prefix", "abe1", 1.0)],
        "query_id long, clause_id int, occur string, kind string, text string, boost double")
    found = predicates.search(ix, clauses)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "docs#" in plan and "arrays_zip" not in plan
    ids = (-5, 0, 1, 1023, 1024, 5000, 1 << 40)
    assert sorted((r.query_id, r.doc_id, r.score) for r in found.collect()) == sorted(
        [(1, i, 2.0 + 3.0 * (i % 3 > 0)) for i in ids] + [(2, i, 0.0 + 1.0) for i in ids if i % 3 != 1])
