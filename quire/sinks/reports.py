"""Report tables: term rankings, hits, metrics, the training sweep and the
test result, in the row layouts of the reference's CSV and text reports.
Each function returns a DataFrame; ``write_csv`` stores one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.evaluate import judge, mean_metrics
from quire.session import bounded_broadcast, written


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a report with a header. ``single_file`` is only for reports of a
    bounded size (a query set, a top-n list)."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", "true").csv(path)


def terms_report(best: DataFrame) -> DataFrame:
    """``(doc_id, rank, term, tf, df, idf, tfxidf)`` ordered for output."""
    return best.select("doc_id", "rank", "term", "tf", "df", "idf", "tfxidf").orderBy("doc_id", "rank")


def hits_report(hits: DataFrame, docs: DataFrame, qrels: DataFrame, top: int,
                totals: DataFrame, text_col: str = "text") -> DataFrame:
    """Top ``top`` hits per query with rank, doc id, score, relevance mark,
    contents and the query's total hits. ``hits`` has to reach down to
    ``top``. The hits are written once and, if they pass the size check, sent
    to the documents, so that no text is moved."""
    h = written(judge(hits.where(F.col("rank") <= top), qrels).join(totals, "query_id", "left"), "hits")
    return (docs.select("doc_id", F.col(text_col).alias("contents")).join(bounded_broadcast(h), "doc_id")
             .select("query_id", "rank", "doc_id", "score", "relevant", "contents", "total_hits"))


def metrics_report(m: DataFrame, cut: int) -> DataFrame:
    """Rows ``(query, P@cut, Recall@cut, AP@cut)`` per query then a
    ``mean`` row (one aggregate, unioned)."""
    detail = m.select(F.col("query_id").cast("string").alias("query"),
                      F.col("p").alias(f"P@{cut}"), F.col("recall").alias(f"Recall@{cut}"),
                      F.col("ap").alias(f"AP@{cut}"))
    mean = mean_metrics(m).select(F.lit("mean").alias("query"), F.col("mean_p").alias(f"P@{cut}"),
                                  F.col("mean_recall").alias(f"Recall@{cut}"), F.col("map").alias(f"AP@{cut}"))
    return detail.unionByName(mean)


def lambda_names(lams: list[float]) -> list[str]:
    """Column names of distinct lambdas: one decimal, or as many as tell them
    apart and give their values."""
    for digits in range(1, 17):
        names = [f"{x:.{digits}f}" for x in lams]
        if len(set(names)) == len(lams) and all(abs(float(n) - x) < 1e-9 for n, x in zip(names, lams)):
            return names
    return [repr(x) for x in lams]


def training_report(sweep: DataFrame, metric_col: str = "ap", lambdas=None) -> DataFrame:
    """Metric by query (rows) x lambda (columns, one for each lambda), values
    rounded to 5 decimals, then a ``mean`` row."""
    lams = lambdas or [r["lambda"] for r in sweep.select("lambda").distinct().orderBy("lambda").collect()]
    lams = list(dict.fromkeys(float(x) for x in lams))
    names = lambda_names(lams)
    piv = sweep.groupBy("query_id").pivot("lambda", lams).agg(F.first(metric_col)).toDF("query_id", *names)
    detail = piv.select(F.col("query_id").cast("string").alias("query"),
                        *[F.round(F.col(f"`{n}`"), 5).alias(n) for n in names])
    means = sweep.groupBy().pivot("lambda", lams).agg(F.avg(metric_col)).toDF(*names)
    mean = means.select(F.lit("mean").alias("query"), *[F.round(F.col(f"`{n}`"), 5).alias(n) for n in names])
    return detail.unionByName(mean)


def test_report(m: DataFrame, lam: float | None, metric_col: str = "ap") -> DataFrame:
    """One metric per test query, then a ``mean`` row: ``(query, value,
    lambda_head)`` where ``lambda_head`` is the chosen lambda (``null`` for
    tf-idf) that heads the written file."""
    head = lambda_names([lam])[0] if lam is not None else "null"
    detail = m.select(F.col("query_id").cast("string").alias("query"), F.col(metric_col).alias("value"))
    mean = m.agg(F.coalesce(F.avg(metric_col), F.lit(0.0)).alias("value")).select(F.lit("mean").alias("query"), "value")
    return detail.unionByName(mean).withColumn("lambda_head", F.lit(head))


def write_result_csv(report: DataFrame, path: str, lam: float | None, metric_name: str, cut: int) -> None:
    """Write a test report in the result-file layout: header
    ``<lambda or null>,<metric>@<cut>``, one ``query,value`` row per query,
    the ``mean`` row last. The report is one row per query (bounded), so it
    is written as a single file."""
    head = lambda_names([lam])[0] if lam is not None else "null"
    out = (report.withColumn("_last", (F.col("query") == "mean").cast("int"))
                 .orderBy("_last", F.col("query").try_cast("long"))
                 .select(F.col("query").alias(head), F.col("value").alias(f"{metric_name}@{cut}")))
    write_csv(out, path, single_file=True)
