"""Summaries of findings, for events and feature matrices alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITIES = {"errors": "ERROR", "warnings": "WARNING", "info": "INFO"}


def _severity_counts() -> list[Column]:
    return [F.count_if(F.col("severity") == s).alias(name) for name, s in SEVERITIES.items()]


def verdict(errors: Column, warnings: Column, failed: str = "ERROR") -> Column:
    return F.when(errors > 0, F.lit(failed)).when(warnings > 0, F.lit("WARNING")).otherwise(F.lit("PASS"))


def issues_by_check(issues: DataFrame, checks: list[tuple[int, str]], failed: str = "ERROR") -> DataFrame:
    """One row per check, also for checks without findings."""
    spark = issues.sparkSession
    names = spark.createDataFrame(checks, "check_no int, check_group string")
    counts = issues.groupBy("check_group").agg(*_severity_counts())
    joined = names.join(counts, "check_group", "left").na.fill(0, list(SEVERITIES))
    return joined.select(
        "check_no", "check_group", *SEVERITIES,
        (F.col("errors") == 0).alias("pass"),
        verdict(F.col("errors"), F.col("warnings"), failed).alias("verdict"),
    )


def error_lines(issues: DataFrame, line: str = "line_number") -> DataFrame:
    return issues.where((F.col("severity") == "ERROR") & F.col(line).isNotNull()).select(line).distinct()


def valid_records(df: DataFrame, issues: DataFrame, line: str = "line_number") -> DataFrame:
    """Records that no ERROR finding names."""
    return df.join(error_lines(issues, line), line, "left_anti")


def issue_totals(df: DataFrame, issues: DataFrame, line: str = "line_number") -> DataFrame:
    """One row: total and valid records, findings by severity."""
    total = df.agg(F.count("*")).scalar()
    bad = error_lines(issues, line).agg(F.count("*")).scalar()
    names = ("error_count", "warning_count", "info_count")
    counts = issues.agg(*[c.alias(n) for n, c in zip(names, _severity_counts())])
    return counts.select(total.alias("total_records"), (total - bad).alias("valid_records"), *names)


def first_error_lines(issues: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` lines with an ERROR finding of each check."""
    lines = issues.where("severity = 'ERROR'").select("check_group", "line_number").distinct()
    # a ranking limit: each task keeps k rows per check before the shuffle
    rank = F.row_number().over(Window.partitionBy("check_group").orderBy("line_number"))
    return lines.withColumn("rank", rank).where(F.col("rank") <= k)


def top_recommendations(issues: DataFrame, order: list[str], by: str = "check_type", limit: int | None = None) -> DataFrame:
    """The first advice of each ``by`` value in finding order; by itself, the distinct advice."""
    position = F.struct(*order)
    firsts = issues.groupBy(F.col(by).alias("_by")).agg(
        F.min_by("recommended_action", position).alias("recommended_action"), F.min(position).alias("_at")
    )
    if limit is not None:
        firsts = firsts.orderBy("_at").limit(limit)
    if by != "recommended_action":
        firsts = firsts.withColumnRenamed("_by", by)
    return firsts.select(*dict.fromkeys([by, "recommended_action"]), "_at.*")


def json_summary(df: DataFrame, issues: DataFrame, checks: list[tuple[int, str]]) -> DataFrame:
    """One row with totals and a ``by_check`` map, ready for a JSON sink."""
    per_check = issues_by_check(issues, checks).agg(
        F.map_from_entries(F.array_agg(F.struct("check_group", F.struct(*SEVERITIES, "pass"))))
    )
    return issue_totals(df, issues).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
        "*",
        per_check.scalar().alias("by_check"),
    )
