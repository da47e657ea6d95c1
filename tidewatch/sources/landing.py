"""Raw files written as tables, with the counts of what was read taken in the same pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.log_parsing import FORMATS, parse_lines
from tidewatch.sources.telemetry import CORRUPT, normalize_telemetry, read_telemetry, timeless


def _written(df: DataFrame, counts: dict[str, Column], path: str, *partitions: str) -> dict[str, int]:
    """Write ``df`` and give the counts of its rows, which the tasks take while they write."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.partitionBy(*partitions).parquet(path)
    found = seen.get
    return {n: found.get(n) or 0 for n in counts}


def land_logs(lines: DataFrame, path: str, fmt: str | None = None, id_from: list[str] | None = None) -> DataFrame:
    """Parse lines into ``path``, events under ``parsed=true`` and rejects under ``parsed=false``.

    The result has the rows (log_type, outcome, n_lines) of those that occur, one per format and outcome.
    """
    parsed = parse_lines(lines, fmt, id_from).withColumn("parsed", F.col("reject_reason").isNull())
    kinds = [fmt] if fmt else list(FORMATS)
    outcomes = [(k, o) for k in kinds for o in ("parsed", f"malformed {k}")] + [(k, "unknown format") for k in [*kinds, "unknown"]]
    kind, outcome = F.coalesce("log_type", F.lit("unknown")), F.coalesce("reject_reason", F.lit("parsed"))
    counts = {f"n{i}": F.count_if((kind == k) & (outcome == o)) for i, (k, o) in enumerate(outcomes)}
    found = _written(parsed, counts, path, "parsed")
    rows = [(k, o, found[f"n{i}"]) for i, (k, o) in enumerate(outcomes) if found[f"n{i}"]]
    return lines.sparkSession.createDataFrame(rows, "log_type string, outcome string, n_lines bigint")


def landed_logs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events and rejected lines that ``land_logs`` wrote."""
    rows = spark.read.parquet(path)
    events = rows.where("parsed = 'true'").drop("parsed", "reject_reason")
    return events, rows.where("parsed = 'false'").select(F.col("original_line").alias("line"), "reject_reason")


def land_telemetry(spark: SparkSession, source, path: str) -> DataFrame:
    """Read telemetry files into a table by day; one row: lines read, malformed, without a readable time, and kept."""
    raw = read_telemetry(spark, source)
    bad = F.col(CORRUPT).isNotNull()
    counts = {"n_lines": F.count(F.lit(1)), "n_malformed": F.count_if(bad), "n_no_time": F.count_if(~bad & timeless())}
    seen = Observation()
    # the counts are of the rows before normalization drops any
    kept = normalize_telemetry(raw.observe(seen, *[c.alias(n) for n, c in counts.items()])).withColumn("day", F.to_date("timestamp"))
    n_kept = _written(kept, {"n_kept": F.count(F.lit(1))}, path, "day")["n_kept"]
    found = seen.get
    return spark.createDataFrame([(*(found.get(n) or 0 for n in counts), n_kept)], "n_lines bigint, n_malformed bigint, n_no_time bigint, n_kept bigint")
