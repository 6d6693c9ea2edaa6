"""Closed-form test statistics as Spark column expressions (no UDF).

* Student's t two-sided tail for an integer number of degrees of freedom:
  the finite cosine series of the t distribution (Abramowitz & Stegun
  26.7.3-4), folded with ``aggregate`` over ``sequence``.
* Exact Wilcoxon signed-rank tail: the subset-sum distribution of the ranks
  1..n built by dynamic programming over an array (``aggregate`` +
  ``transform``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def t_two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t with integer ``df`` >= 1."""
    theta = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    c = F.cos(theta)
    s = F.sin(theta)
    c2 = c * c
    # even df: A = s * sum_{k=0}^{(df-2)/2} a_k c^(2k),  a_0 = 1, a_k = a_{k-1} (2k-1)/(2k)
    even_sum = F.aggregate(
        F.sequence(F.lit(1), F.greatest((df - 2) / 2, F.lit(0)).cast("int") + 1),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("acc")),
        lambda acc, k: F.struct(
            (acc["term"] * c2 * (2 * k - 1) / (2 * k)).alias("term"),
            (acc["acc"] + acc["term"]).alias("acc")),
        lambda acc: acc["acc"])
    # odd df >= 3: A = 2/pi (theta + s * sum_{k=0}^{(df-3)/2} b_k c^(2k+1)), b_0 = 1, b_k = b_{k-1} (2k)/(2k+1)
    odd_sum = F.aggregate(
        F.sequence(F.lit(1), F.greatest((df - 3) / 2, F.lit(0)).cast("int") + 1),
        F.struct(c.alias("term"), F.lit(0.0).alias("acc")),
        lambda acc, k: F.struct(
            (acc["term"] * c2 * (2 * k) / (2 * k + 1)).alias("term"),
            (acc["acc"] + acc["term"]).alias("acc")),
        lambda acc: acc["acc"])
    a_even = s * even_sum
    a_one = F.lit(2.0 / math.pi) * theta
    a_odd = F.lit(2.0 / math.pi) * (theta + s * odd_sum)
    a = (F.when(df % 2 == 0, a_even)
         .when(df == 1, a_one)
         .otherwise(a_odd))
    return F.greatest(F.least(F.lit(1.0) - a, F.lit(1.0)), F.lit(0.0))


def signed_rank_chances(n: Column) -> Column:
    """``array<double>`` c where c[s+1] is the chance that a random subset of
    {1..n} has sum s (s = 0 .. n(n+1)/2): each rank is in with one half."""
    n = n.cast("int")
    top = (n * (n + 1) / 2).cast("int")
    init = F.transform(F.sequence(F.lit(0), top), lambda s: F.when(s == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        init,
        lambda acc, r: F.when(r > n, acc).otherwise(F.transform(
            acc, lambda p, i: (p + F.when(i >= r, F.element_at(acc, F.greatest(i - r + 1, F.lit(1)))).otherwise(F.lit(0.0))) / 2)))


def signed_rank_exact_p(w_max: Column, n: Column) -> Column:
    """Two-sided exact p = min(1, 2 * P(W >= w_max)) for n ranks 1..n."""
    tail = F.aggregate(
        F.transform(signed_rank_chances(n), lambda p, i: F.when(i >= F.ceil(w_max), p).otherwise(F.lit(0.0))),
        F.lit(0.0), lambda a, b: a + b)
    return F.least(F.lit(1.0), F.lit(2.0) * tail)
