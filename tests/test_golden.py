"""
run through the evaluation, tuning and comparison layers."""

import pytest

from quire.operators import compare, evaluate, tune
from quire.sinks import reports

# --- Fixed values: published AP@10 of test queries 21-30 -------------------
JM_TEST = [0.10185, 0.05333, 0.20228, 0.39949, 0.36100, 0.00357, 0.27826, 0.15873, 0.23416, 0.21429]
TFIDF_TEST = [0.09894, 0.05600, 0.20228, 0.38732, 0.33977, 0.01913, 0.28413, 0.15232, 0.24054, 0.25510]
# Published training sweep means (lambda 0.1 .. 1.0).
TRAIN_MEANS = [0.23726, 0.23472, 0.24214, 0.24745, 0.24943, 0.24959, 0.25260, 0.25748, 0.24788, 0.01694]
# ---------------------------------------------------------------------------


def _runs(spark):
    a = spark.createDataFrame([(21 + i, v) for i, v in enumerate(JM_TEST)], "query_id long, value double")
    b = spark.createDataFrame([(21 + i, v) for i, v in enumerate(TFIDF_TEST)], "query_id long, value double")
    return compare.align(a, b)


def test_paired_t(spark):
    r = compare.paired_t(_runs(spark)).first()
    assert r.n == 10 and r.df == 9
    assert r.t == pytest.approx(-0.536042, abs=1e-6)
    assert r.p_value == pytest.approx(0.604922, abs=1e-6)


def test_wilcoxon_drop_and_keep(spark):
    d = compare.wilcoxon(_runs(spark), zeros="drop").first()
    assert d.n == 9 and sorted([d.w_plus, d.w_minus]) == [21.0, 24.0]
    assert d.p_value == pytest.approx(0.910156, abs=1e-6)
    k = compare.wilcoxon(_runs(spark), zeros="keep").first()
    assert (k.n, k.w_plus, k.w_minus) == (10, 25.0, 30.0)
    assert k.p_value == pytest.approx(0.845703, abs=1e-6)


def test_decide(spark):
    r = compare.decide(compare.paired_t(_runs(spark)), 0.05).first()
    assert r.reject is False


def test_best_lambda_from_published_means(spark):
    rows = [(round(0.1 * (i + 1), 1), 1, m) for i, m in enumerate(TRAIN_MEANS)]
    sw = spark.createDataFrame(rows, "lambda double, query_id long, ap double")
    b = tune.best_lambda(sw, "map").first()
    assert b.best_lambda == 0.8 and b.best_value == pytest.approx(0.25748)
    tie = spark.createDataFrame([(0.3, 1, 0.5), (0.2, 1, 0.5)], "lambda double, query_id long, ap double")
    assert tune.best_lambda(tie).first().best_lambda == 0.2   # lowest lambda wins a tie


def test_test_report_mean(spark):
    m = spark.createDataFrame([(21 + i, v) for i, v in enumerate(JM_TEST)], "query_id long, ap double")
    rep = {r.query: r.value for r in reports.test_report(m, 0.8).collect()}
    assert rep["mean"] == pytest.approx(0.20070, abs=1e-5)
    m2 = spark.createDataFrame([(21 + i, v) for i, v in enumerate(TFIDF_TEST)], "query_id long, ap double")
    assert {r.query: r.value for r in reports.test_report(m2, None).collect()}["mean"] == pytest.approx(0.20355, abs=1e-5)


def test_query_ranges():
    assert tune.parse_range("all") == (None, None)
    assert tune.parse_range("3") == (3, 3)
    assert tune.parse_range("1-20") == (1, 20)
    with pytest.raises(ValueError):
        tune.parse_range("20-1")


def test_metrics_report_mean_row(spark):
    m = spark.createDataFrame([(1, 1.0, 0.27, 0.27), (2, 0.6, 0.375, 0.314)], "query_id long, p double, recall double, ap double")
    rep = {r.query: r for r in reports.metrics_report(m, 10).collect()}
    assert rep["mean"]["P@10"] == pytest.approx(0.8)
    assert set(rep) == {"1", "2", "mean"}
