"""Comparing two runs: alignment and paired significance tests.

Both tests reduce the aligned per-query values to one row with plain
aggregates; the tails are closed-form column expressions
(``quire.functions.stats_math``), so no data reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.stats_math import signed_rank_exact_p, t_two_sided_p
from quire.session import written


class RunMismatch(ValueError):
    """Two runs cover different test ranges, metrics or query sets."""


def check_names(name_a: str, name_b: str) -> None:
    """Result names carry parameters split on ``.``: part 6 is the test range,
    part 7 the metric and cut; both must agree."""
    first, second = (x.split(".") for x in (name_a, name_b))
    if min(len(first), len(second)) < 7:
        raise RunMismatch("a result name has seven parts or more, divided by dots")
    for part, what in ((5, "test range"), (6, "metric and cut")):
        if first[part] != second[part]:
            raise RunMismatch(f"the runs differ in {what}: {first[part]!r} against {second[part]!r}")


def align(a: DataFrame, b: DataFrame, check: bool = True) -> DataFrame:
    """``(query_id, x, y)`` joined on ``query_id`` (inputs are
    ``(query_id, value)``). With ``check`` the two query sets must be equal
    (one small count read back); otherwise a full outer join would hide the
    mismatch. The joined rows, one a query, are then written once: both runs
    would be ranked again after the check."""
    x = a.select("query_id", F.col("value").alias("x"))
    y = b.select("query_id", F.col("value").alias("y"))
    full = x.join(y, "query_id", "full")
    if check:
        full = written(full, "aligned")
        bad = full.where(F.col("x").isNull() | F.col("y").isNull()).limit(1).count()
        if bad:
            raise RunMismatch("the two runs cover different queries")
    return full.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def paired_t(aligned: DataFrame) -> DataFrame:
    """One row ``(n, mean_diff, t, df, p_value)``: two-sided paired t-test on
    d = x - y. n < 2 gives null t and p; sd = 0 gives p = 1 when the mean is
    0 and 0 otherwise."""
    d = aligned.select((F.col("x") - F.col("y")).alias("d"))
    s = d.agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("sd"))
    t = F.try_divide(F.col("mean_diff"), F.col("sd") / F.sqrt(F.col("n").cast("double")))
    dfree = (F.col("n") - 1).cast("int")
    p = (F.when(F.col("n") < 2, F.lit(None).cast("double"))
          .when(F.col("sd") == 0, F.when(F.col("mean_diff") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(t_two_sided_p(t, dfree)))
    return s.select("n", "mean_diff",
                    F.when(F.col("n") >= 2, t).alias("t"),
                    F.when(F.col("n") >= 2, dfree.cast("long")).alias("df"),
                    p.alias("p_value"))


def wilcoxon(aligned: DataFrame, zeros: str = "drop") -> DataFrame:
    """One row ``(n, w_plus, w_minus, p_value)``: signed-rank test on
    d = x - y with average ranks of |d|.

    ``zeros='drop'`` removes zero differences first; ``'keep'`` ranks them
    and counts their ranks in W-. The p-value is exact for any n (the
    distribution of rank sums over all subsets of 1..n).
    """
    if zeros not in ("drop", "keep"):
        raise ValueError("zeros must be 'drop' or 'keep'")
    d = aligned.select((F.col("x") - F.col("y")).alias("d"))
    if zeros == "drop":
        d = d.where(F.col("d") != 0)
    # differences of one size share their rank: they are counted first, so
    # only distinct sizes are put in order
    sizes = d.groupBy(F.abs("d").alias("size")).agg(F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("d") > 0).alias("up"))
    below = F.coalesce(F.sum("cnt").over(Window.partitionBy("part").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # ranges of sizes lie in order over the partitions: a size's rank is the
    # count of the partitions before, one row each, and of the sizes before it
    # in its own partition
    parts = written(sizes.repartitionByRange("size").withColumn("part", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.groupBy("part").agg(F.sum("cnt").alias("c")).select("part", before.alias("start"))
    ranked = parts.join(F.broadcast(starts), "part").select("cnt", "up", (F.col("start") + below + (F.col("cnt") + 1) / 2.0).alias("_r"))
    s = ranked.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"),
                   F.coalesce(F.sum(F.col("up") * F.col("_r")), F.lit(0.0)).alias("w_plus"))
    n = F.col("n")
    total = n * (n + 1) / 2.0
    wmax = F.greatest(F.col("w_plus"), total - F.col("w_plus"))
    p = F.when(n == 0, F.lit(1.0)).otherwise(signed_rank_exact_p(wmax, n))
    return s.select("n", "w_plus", (total - F.col("w_plus")).alias("w_minus"), p.alias("p_value"))


def decide(test_row: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds ``alpha`` and ``reject`` (p < alpha)."""
    return test_row.select("*", F.lit(alpha).alias("alpha"),
                           F.coalesce(F.col("p_value") < F.lit(alpha), F.lit(False)).alias("reject"))
