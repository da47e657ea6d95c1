"""Feature matrices as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.features import feature_names
from tidewatch.sources.logs import read_logs


def read_feature_csv(spark: SparkSession, path, schema=None) -> DataFrame:
    """A matrix with ``line_number``, the physical line in its file (the header is line 1).

    Without ``schema`` the types are inferred, which reads the data once more. NaN becomes null.
    """
    schema = schema or spark.read.csv(path, header=True, inferSchema=True).schema
    lines = read_logs(spark, path, numbered=True).where("line_number > 1")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    rows = lines.select("line_number", F.from_csv("value", ddl).alias("r")).select("line_number", "r.*")
    doubles = [f.name for f in schema if f.dataType.simpleString() in ("double", "float")]
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def write_features(matrix: DataFrame, csv_path: str, json_path: str, metadata_path: str) -> None:
    """CSV and JSON partitioned by hour, and a one-row table of record count and feature names."""
    # files of an hour side by side; large hours are split, small ones share a task
    by_hour = matrix.hint("rebalance", "hour")
    by_hour.write.partitionBy("hour").csv(csv_path, header=True)
    by_hour.write.partitionBy("hour").option("ignoreNullFields", False).json(json_path)
    names = F.array(*[F.lit(n) for n in feature_names(matrix)])
    matrix.agg(F.count("*").alias("record_count")).withColumn("features", names).write.json(metadata_path)
