"""Sinks for findings and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_event_issues(issues: DataFrame, path: str) -> None:
    """CSV in line order; findings of one line follow the order of the checks."""
    ordered = issues.orderBy("line_number", "check_no")
    ordered.select("line_number", "check_type", "severity", "description", "recommended_action").write.csv(
        path, header=True
    )


def write_feature_issues(issues: DataFrame, path: str) -> None:
    """CSV in check order; findings on the whole table have an empty line number."""
    ordered = issues.orderBy("check_no", "seq", "line_numbers")
    ordered.select(
        F.array_join("line_numbers", ",").alias("line_number"),
        "check_type", "severity", "description", "recommended_action",
    ).write.csv(path, header=True)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.option("ignoreNullFields", False).json(path)
