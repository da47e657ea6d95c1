"""Raw telemetry (authentication, network and DNS events in one sparse table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.times import parse_telemetry_time

TELEMETRY_TYPES = {
    "timestamp": "timestamp", "event_type": "string", "user": "string", "source_ip": "string",
    "host": "string", "status": "string", "dest_ip": "string", "port": "int", "bytes": "bigint",
    "protocol": "string", "client_ip": "string", "query_domain": "string", "record_type": "string",
    "response": "string",
}
CORRUPT = "_corrupt_record"


def read_telemetry(spark: SparkSession, path) -> DataFrame:
    """Telemetry JSON lines; malformed lines keep their text in ``_corrupt_record``.

    Every field is read as text, so a value of the wrong type costs that value and not its row.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*TELEMETRY_TYPES, CORRUPT]])
    return spark.read.schema(schema).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def normalize_telemetry(df: DataFrame) -> DataFrame:
    """Typed telemetry with ``source_ip`` filled from ``client_ip`` and ``hour_bucket`` added.

    Absent columns become null, rows without a readable time are dropped.
    """
    present = dict(df.dtypes)
    rows = df.where(F.col(CORRUPT).isNull()) if CORRUPT in present else df

    def typed(name, wanted):
        if name not in present:
            return F.lit(None).cast(wanted)
        if wanted == "timestamp" and present[name] == "string":
            return parse_telemetry_time(F.col(name))
        return F.col(name) if present[name] == wanted else F.col(name).try_cast(wanted)

    wide = rows.select(*[typed(c, t).alias(c) for c, t in TELEMETRY_TYPES.items()])
    return (
        wide.where("timestamp IS NOT NULL")
        .withColumn("source_ip", F.coalesce("source_ip", "client_ip"))
        .withColumn("hour_bucket", F.date_trunc("hour", "timestamp"))
    )


def telemetry_counts(df: DataFrame) -> DataFrame:
    """One row: lines read, malformed, without a readable time, and kept."""
    bad = F.col(CORRUPT).isNotNull()
    return df.agg(
        F.count("*").alias("n_lines"),
        F.count_if(bad).alias("n_malformed"),
        F.count_if(~bad & timeless()).alias("n_no_time"),
        F.count_if(~bad & ~timeless()).alias("n_kept"),
    )


def timeless() -> Column:
    """Whether a raw row has no readable time."""
    return parse_telemetry_time(F.col("timestamp")).isNull()


def load_telemetry(spark: SparkSession, path) -> DataFrame:
    return normalize_telemetry(read_telemetry(spark, path))
