"""Report tables."""

import pytest

from quire.operators.retrieval import LAMBDAS
from quire.sinks import reports


def test_training_report_keeps_close_lambdas_apart(spark):
    lams = [0.15, 0.2, 0.25]
    rows = [(x, q, 10 * x + q) for x in lams for q in (1, 2)]
    sweep = spark.createDataFrame(rows, "lambda double, query_id long, ap double")
    for given in (lams, None):
        rep = reports.training_report(sweep, "ap", given)
        assert rep.columns == ["query", "0.15", "0.20", "0.25"]
        got = {r["query"]: list(r)[1:] for r in rep.collect()}
        assert got["1"] == pytest.approx([2.5, 3.0, 3.5]) and got["2"] == pytest.approx([3.5, 4.0, 4.5])
        assert got["mean"] == pytest.approx([3.0, 3.5, 4.0])


def test_lambda_names():
    assert reports.lambda_names(list(LAMBDAS)) == [f"{x:.1f}" for x in LAMBDAS]
    assert reports.lambda_names([0.1 + 0.2, 0.5]) == ["0.3", "0.5"] and reports.lambda_names([0.125]) == ["0.125"]
