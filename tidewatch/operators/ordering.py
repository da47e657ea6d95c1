"""Order-dependent operators without a single-task sort.

Rows are range-partitioned by their order into blocks. Work inside a block is local; what crosses
blocks is one small row per block (and group), carried forward and broadcast back. The carried
table has at most ``spark.sql.shuffle.partitions`` rows per group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize


def number_blocks(
    df: DataFrame, group: list[str], block: str, place: str, name: str
) -> DataFrame:
    """Number rows from 1 per group, given blocks in order and an increasing place inside them.

    ``place`` must be contiguous within a block, and ``df`` must not change between reads.
    """
    blocks = df.groupBy(*group, block).agg(
        F.count("*").alias("_n"), F.min(place).alias("_first")
    )
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    if not group:
        before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    keys = [*group, block]
    return (
        df.join(starts, keys)
        .withColumn(name, F.col("_base") + F.col(place) - F.col("_first") + 1)
        .drop("_base", "_first")
    )


def with_line_numbers(df: DataFrame, order: list, name: str = "line_number") -> DataFrame:
    """Contiguous numbers from 1 over the whole table in the given order.

    Ties in ``order`` are broken by a hash of the row, which also lets the range partitioning cut
    through a value that many rows share.
    """
    df = materialize(df, "unnumbered")  # the ranges are sampled from the rows, which are made once
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = (
        df.withColumn("_tie", tie)
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_block", F.spark_partition_id())
    )
    placed = materialize(ranged, "numbered")
    blocks = placed.groupBy("_block").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, so no more than spark.sql.shuffle.partitions rows
    starts = blocks.select(
        "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    return (
        placed.join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_shift") + F.col("_place"))
        .drop("_shift", "_place", "_block")
    )


def running_totals(df: DataFrame, group: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``cum_<c>``, the total up to and including the row, and ``tot_<c>``, that of the group.

    Rows must be unique by (group, order), which the callers get by counting per value first; so
    a value that a third of the input shares is one row here.
    """
    ranged = df.repartitionByRange(*group, *order).withColumn("_block", F.spark_partition_id())
    placed = materialize(ranged, "ranged")
    totals = placed.groupBy(*group, "_block").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    carry = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    bases = totals.select(
        *group, "_block",
        *[F.coalesce(F.sum(f"_t_{c}").over(carry), F.lit(0)).alias(f"_b_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(f"tot_{c}") for c in sums],
    )
    inside = Window.partitionBy("_block", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in sums])
    joined = local.join(bases, [*group, "_block"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_l_{c}") + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"tot_{c}" for c in sums],
    )


def order_statistics(df: DataFrame, group: list[str], value: str, ranks: DataFrame, rank: str) -> DataFrame:
    """The exact ``rank``-th smallest value (from 1) of each group.

    ``ranks`` has the group columns and ``rank``; the result adds ``value`` to it.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    placed = running_totals(counts, group, [value], ["_n"])
    return (
        placed.join(ranks, group)
        .where((F.col("cum__n") - F.col("_n") < F.col(rank)) & (F.col(rank) <= F.col("cum__n")))
        .select(*ranks.columns, value)
    )


def _brackets(df: DataFrame, columns: list[str], probs: list[float]) -> list[tuple]:
    """For each column and quantile a range that holds it: (column, prob, low, high, n, rank, part).

    Approximate quantiles a little below and above give the range; counting the values before and
    inside it proves it. A range that fails the proof is opened to the whole column. ``rank`` is
    the place within the range of the value at or below the quantile, ``part`` the distance to the
    value after it.
    """
    margin, accuracy = 0.001, 5000
    around = [min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)]
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    first = df.agg(
        *[F.percentile_approx(v, around, accuracy).alias(f"q{i}") for i, v in enumerate(value.values())],
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(value.values())],
    ).first()
    jobs = [
        (c, p, first[f"q{i}"][2 * k], first[f"q{i}"][2 * k + 1], first[f"n{i}"])
        for i, c in enumerate(columns) if first[f"n{i}"]
        for k, p in enumerate(probs)
    ]
    if not jobs:
        return []
    counts = df.agg(
        *[F.count_if(value[c] < F.lit(lo)).alias(f"b{j}") for j, (c, _, lo, _, _) in enumerate(jobs)],
        *[F.count_if(value[c].between(lo, hi)).alias(f"i{j}") for j, (c, _, lo, hi, _) in enumerate(jobs)],
    ).first()
    found = []
    for j, (c, p, lo, hi, n) in enumerate(jobs):
        place = p * (n - 1)
        rank, below = math.floor(place) + 1, counts[f"b{j}"]
        last = min(rank + 1, n)
        if below < rank and last <= below + counts[f"i{j}"]:
            found.append((c, p, lo, hi, n, rank - below, place - math.floor(place)))
        else:
            found.append((c, p, float("-inf"), float("inf"), n, rank, place - math.floor(place)))
    return found


def quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows of (feature, prob, n, quantile).

    Only values in a narrow range around each quantile are ordered; the rest is counted.
    """
    spark = df.sparkSession
    brackets = _brackets(df, columns, probs)
    schema = "job int, feature string, prob double, n bigint, rank bigint, part double"
    rows = [(j, c, float(p), n, rank, part) for j, (c, p, _, _, n, rank, part) in enumerate(brackets)]
    jobs = spark.createDataFrame(rows, schema)
    if not rows:
        return jobs.select("feature", "prob", "n", F.col("part").alias("quantile"))
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    near = [value[c].between(lo, hi) for c, _, lo, hi, _, _, _ in brackets]
    entries = F.array(
        *[
            F.when(hit, F.struct(F.lit(j).alias("job"), value[b[0]].alias("value")))
            for j, (hit, b) in enumerate(zip(near, brackets))
        ]
    )
    # most rows are in no range and go no further than the filter
    inside = df.where(reduce(Column.__or__, near)).select(F.inline(F.filter(entries, lambda e: e.isNotNull())))
    counts = inside.groupBy("job", "value").agg(F.count("*").alias("_n"))
    placed = running_totals(counts, ["job"], ["value"], ["_n"]).join(F.broadcast(jobs), "job")
    before, upto = F.col("cum__n") - F.col("_n"), F.col("cum__n")

    def at(rank):
        return F.max(F.when((before < rank) & (rank <= upto), F.col("value")))

    low, high = at(F.col("rank")), F.coalesce(at(F.col("rank") + 1), at(F.col("rank")))
    return placed.groupBy("feature", "prob", "n").agg((low + F.max("part") * (high - low)).alias("quantile"))


def unpivot(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows of (keep…, feature, value double)."""
    kept = [F.col(f"`{c}`") for c in keep or []]
    wide = df.select(*kept, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return wide.unpivot(kept, [F.col(f"`{c}`") for c in columns], "feature", "value")


GROUP_BLOCKS = 1000


def previous_row(
    df: DataFrame, line: str, present: Column, carried: list[str], block_rows: int = 1_000_000
) -> DataFrame:
    """Rows where ``present`` holds, with ``prev_<c>`` of the row before by line number.

    Lines are unique, so a block of ``block_rows`` lines is a bounded sort. One row per block is carried
    over the block borders, and one per ``GROUP_BLOCKS`` blocks over the borders of these groups.
    """
    kept = df.where(present).withColumn("_block", F.floor((F.col(line) - 1) / block_rows))
    last = kept.groupBy("_block").agg(
        F.max_by(F.struct(*carried), line).alias("_last")
    )
    last = last.withColumn("_group", F.floor(F.col("_block") / GROUP_BLOCKS))
    ends = last.groupBy("_group").agg(F.max_by("_last", "_block").alias("_end"))
    # a row per block_rows * GROUP_BLOCKS lines
    before = ends.select("_group", F.lag("_end").over(Window.orderBy("_group")).alias("_before"))
    within = F.lag("_last").over(Window.partitionBy("_group").orderBy("_block"))
    carry = last.withColumn("_within", within).join(before, "_group").select(
        "_block", F.coalesce("_within", "_before").alias("_carry")
    )
    inside = Window.partitionBy("_block").orderBy(line)
    local = kept.withColumn("_prev", F.lag(F.struct(*carried)).over(inside))
    joined = local.join(carry, "_block").withColumn("_prev", F.coalesce("_prev", "_carry"))
    return joined.select(*df.columns, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in carried])
