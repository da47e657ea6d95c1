"""Raw log lines in, normalized events out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.jsons import parse_strict
from tidewatch.functions.text import strip
from tidewatch.operators.ordering import number_blocks
from tidewatch.session import materialize


def read_logs(spark: SparkSession, path, numbered: bool = False) -> DataFrame:
    """Lines as ``value`` with ``file``; bytes that are not UTF-8 become U+FFFD.

    ``numbered`` adds ``line_number``, the physical line from 1 within each file. A file may be
    split over many tasks: lines keep their place within the split, and splits are counted in
    file order.
    """
    lines = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    if not numbered:
        return lines.drop("block_start")
    placed = materialize(lines.withColumn("place", F.monotonically_increasing_id()), "lines")
    return number_blocks(placed, ["file"], "block_start", "place", "line_number").drop(
        "block_start", "place"
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with null fields written out."""
    df.write.option("ignoreNullFields", False).json(path)


def read_events_jsonl(spark: SparkSession, path, schema) -> tuple[DataFrame, DataFrame]:
    """Records and malformed lines of a JSON-lines file.

    Both carry the physical ``line_number`` in the file. Blank lines are neither.
    """
    lines = read_logs(spark, path, numbered=True).where(strip(F.col("value")) != "")
    parsed = lines.withColumn("json", parse_strict(F.col("value")))
    bad = parsed.where("json IS NULL").select("file", "line_number", F.col("value").alias("line"))
    good = parsed.where("json IS NOT NULL").select(
        "file", "line_number", F.from_json("value", schema).alias("r")
    )
    return good.select("file", "line_number", "r.*"), bad


def file_fingerprints(spark: SparkSession, path) -> DataFrame:
    """Line count and an order-free checksum of the lines of each file, of any size."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.xxhash64("value").cast("decimal(38,0)").alias("h"))
    return lines.groupBy("file").agg(F.count("*").alias("n_lines"), F.sum("h").alias("fingerprint"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free checksum of all rows."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(row_hash).alias("fingerprint"))
