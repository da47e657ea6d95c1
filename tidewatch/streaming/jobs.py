"""Continuous versions of log normalization, hourly features and duplicate removal."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructField, StructType

from tidewatch.operators.features import mean_entropy, resolve_entity
from tidewatch.operators.log_parsing import parse_lines
from tidewatch.session import shared_dir


HOUR = 3_600_000_000  # microseconds


def stream_logs(spark: SparkSession, path: str, fmt: str | None = None, max_files: int | None = None) -> DataFrame:
    """Parsed lines of a folder as files arrive.

    An id is a hash of the line and of its place (file, start of the split, place within it), so equal
    lines have ids of their own and a replayed batch gives the same ids.
    """
    reader = spark.readStream.option("wholetext", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).select(
        F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    placed = lines.mapInArrow(_number_lines, "value string, file string, block_start bigint, place bigint")
    return parse_lines(placed, fmt, id_from=["file", "block_start", "place"]).drop("block_start", "place")


def _number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the place of each line within its split; the lines of a split come one after the other."""
    split, place = None, -1
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, start = batch.column("file"), batch.column("block_start")
        codes, starts = file.dictionary_encode().indices.to_numpy(), start.to_numpy()
        runs = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1]))))
        sizes = np.diff(np.append(runs, n))
        places = np.arange(n) - np.repeat(runs, sizes)
        if (file[0].as_py(), start[0].as_py()) == split:
            places[: sizes[0]] += place + 1
        split, place = (file[-1].as_py(), start[-1].as_py()), int(places[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "place"])


def _known(time: str):
    """Whether a row has an entity. It reads the time, so that it stays behind the watermark, which counts all rows."""
    return F.when(F.col(time).isNotNull(), F.col("entity_label")).isNotNull()


def hourly_features(events: DataFrame, window: str, delay: str = "1 hour", time: str = "timestamp") -> DataFrame:
    """Features per entity and hour that need no other bucket.

    An hour is given out once the watermark has passed it; later events of it are dropped. An event without an entity moves the
    watermark only, so ``ending`` closes all hours.
    Distinct counts are approximate, as exact ones would keep every value as state.
    """
    auth, network, dns = (F.col("event_type") == t for t in ("AUTH", "NETWORK", "DNS"))
    success = F.count_if(auth & (F.col("status") == "SUCCESS"))
    failure = F.count_if(auth & (F.col("status") == "FAILURE"))
    domain = F.when(dns, F.col("query_domain"))
    buckets = (
        events.withWatermark(time, delay)
        .withColumn("entity_label", resolve_entity(window))
        .where(_known(time))
        .groupBy(F.window(time, "1 hour"), "entity_label")
        .agg(
            F.count("*").alias("n_events"),
            success.alias("login_success_count"),
            failure.alias("login_failure_count"),
            F.approx_count_distinct("source_ip").alias("unique_source_ips"),
            F.approx_count_distinct(F.when(network, F.col("port"))).alias("unique_dest_ports"),
            mean_entropy(domain).alias("dns_query_entropy"),
            F.avg(F.length(domain)).alias("domain_length"),
            F.sum(F.when(network, F.col("bytes"))).alias("bytes_transferred"),
        )
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(F.col(top), bottom), F.lit(0.0))

    return buckets.select(
        F.col("window.start").alias("hour_bucket"), "entity_label", "n_events", "login_success_count",
        "login_failure_count", "unique_source_ips", "unique_dest_ports",
        ratio("login_failure_count", F.col("login_success_count") + F.col("login_failure_count")).alias("failure_ratio"),
        ratio("login_success_count", F.col("n_events")).alias("success_rate"),
        F.coalesce("dns_query_entropy", F.lit(0.0)).alias("dns_query_entropy"),
        F.coalesce("domain_length", F.lit(0.0)).alias("domain_length"),
        F.coalesce("bytes_transferred", F.lit(0)).alias("bytes_transferred"),
    )


def unique_events(events: DataFrame, event_id: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Events without repeats of an id that arrive within the delay; state older than that is freed."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Start an exactly-once file sink."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def use_state_store(spark: SparkSession) -> None:
    """Keep state in RocksDB, off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_available(df: DataFrame, tag: str, base: str | None = None) -> DataFrame:
    """Process all data that is there, and read the sink back. With the same ``base`` a later call goes on."""
    spark = df.sparkSession
    use_state_store(spark)
    base = base or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    query = write_stream(df, f"{base}/out", f"{base}/state", available_now=True)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def ending(spark: SparkSession, schema: StructType, time: str = "timestamp") -> DataFrame:
    """One event of no entity far in the future: where it lands after all others, the stream gives out what is still open."""
    late = datetime(9999, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame([tuple(late if f.name == time else None for f in schema)], StructType([StructField(f.name, f.dataType) for f in schema]))


def login_gaps(events: DataFrame, window: str, delay: str = "1 hour", time: str = "timestamp") -> DataFrame:
    """(hour_bucket, entity_label, logins, gap_min): the mean minutes between the logins of an hour, as the batch features have it.

    The first gap of an hour goes back to the last login of any hour before, which is kept as state of the entity across batches and restarts. An hour
    stays open, in any order of its rows, until the watermark has passed its end; then a timer gives it out. Logins are
    combined by hour where they are read, so an entity with a third of all rows sends some rows a batch.
    """
    login = (
        events.withColumn("entity_label", resolve_entity(window)).where("event_type = 'AUTH' OR entity_label IS NULL")
        .select("entity_label", F.unix_micros(time).alias("at"))
    )
    partial = login.mapInArrow(_combine_logins, "entity_label string, until timestamp, n long, first long, last long")
    # the watermark runs an hour behind that of the events, as ``until`` is the end of an hour
    timed = partial.withWatermark("until", f"{delay} 1 hour").where(_known("until"))
    return timed.groupBy("entity_label").applyInPandasWithState(
        _close_hours, "hour_bucket timestamp, entity_label string, logins long, gap_min double", "before long, hours array<long>, n array<long>, first array<long>, last array<long>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )


def _combine_logins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, first and last login of each entity and hour of a batch."""
    for batch in batches:
        at = batch.column("at")
        until = pc.multiply(pc.add(pc.divide(at, HOUR), 1), HOUR).cast(pa.timestamp("us", "UTC"))
        table = pa.table({"entity_label": batch.column("entity_label"), "until": until, "at": at}).group_by(["entity_label", "until"]).aggregate([("at", "count"), ("at", "min"), ("at", "max")])
        yield from table.select(["entity_label", "until", "at_count", "at_min", "at_max"]).rename_columns(["entity_label", "until", "n", "first", "last"]).to_batches()


def _close_hours(key, parts, state):
    """Add the rows of a batch to the open hours, and give out those that the watermark has passed."""
    before, *lists = state.get if state.exists else (None, [], [], [], [])
    hours = {h: (n, first, last) for h, n, first, last in zip(*lists, strict=True)}
    if not state.hasTimedOut:
        for part in parts:
            for row in part.itertuples():
                h = row.until.value // 1000
                n, first, last = hours.get(h, (0, row.first, row.last))
                hours[h] = (n + row.n, min(first, row.first), max(last, row.last))
    passed = state.getCurrentWatermarkMs() * 1000
    out = []
    for h in sorted(h for h in hours if h <= passed):
        n, first, last = hours.pop(h)
        gap = (last - before) / n if before is not None else (last - first) / (n - 1) if n > 1 else None
        out.append((pd.Timestamp(h - HOUR, unit="us", tz="UTC"), key[0], n, None if gap is None else gap / 6e7))
        before = last
    kept = sorted(hours)
    state.update((before, kept, *([hours[h][i] for h in kept] for i in range(3))))
    if kept:
        state.setTimeoutTimestamp(max(kept[0] // 1000, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["hour_bucket", "entity_label", "logins", "gap_min"]).astype({"logins": "int64", "gap_min": "float64"})
