"""Seeded, exact sampling: splits, folds and samples that do not depend on the partitioning.

Rows are ordered by a 64-bit hash of their key. A split needs only the hash values at a few ranks;
once these are known, assigning rows is a comparison and moves no data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ordering import order_statistics


def seeded_hash(seed: int, *keys: str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def seeded_uniform(seed: int, *keys: str) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), 11) + F.lit(0.5)) / F.lit(2.0**53)


def hash_ranks(df: DataFrame, group: str, value: str, ranks: DataFrame, rank: str) -> DataFrame:
    """``order_statistics`` for hash values, ordering only the few rows around the wanted ranks.

    A histogram over the first 16 bits finds the interval of each rank.
    """
    interval = F.shiftright(F.col(value), 48)
    counts = df.groupBy(group, interval.alias("_interval")).agg(F.count("*").alias("_n"))
    # at most 65,536 intervals per class
    upto = Window.partitionBy(group).orderBy("_interval").rowsBetween(Window.unboundedPreceding, 0)
    places = counts.withColumn("_cum", F.sum("_n").over(upto))
    wanted = (
        ranks.join(places, group)
        .where((F.col("_cum") - F.col("_n") < F.col(rank)) & (F.col(rank) <= F.col("_cum")))
        .select(*ranks.columns, "_interval", (F.col(rank) - F.col("_cum") + F.col("_n")).alias("_rank"))
    )
    near = df.select(group, interval.alias("_interval"), value).join(
        wanted.select(group, "_interval").distinct(), [group, "_interval"]
    )
    found = order_statistics(near, [group, "_interval"], value, wanted, "_rank")
    return found.select(*ranks.columns, value)


def assign_by_rank(df: DataFrame, group: str, value: Column, cuts: dict[str, Column], name: str) -> DataFrame:
    """Add ``name``: how many of the cut ranks of its group a row lies beyond, null without a group.

    ``cuts`` maps names to expressions over ``n``, the group size, in ascending order.
    """
    hashed = df.withColumn("_hash", value)
    grouped = hashed.where(F.col(group).isNotNull())
    sizes = grouped.groupBy(group).agg(F.count("*").alias("n"))
    ranks = sizes.select(
        group,
        F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in cuts]), F.array(*[e.cast("bigint") for e in cuts.values()]))).alias("cut", "rank"),
    ).where("rank >= 1")
    found = hash_ranks(grouped.select(group, "_hash"), group, "_hash", ranks, "rank").withColumnRenamed("_hash", "_cut")
    per_group = found.groupBy(group).agg(
        *[F.max(F.when(F.col("cut") == c, F.col("_cut"))).alias(f"_c_{i}") for i, c in enumerate(cuts)]
    )
    joined = hashed.join(per_group, group, "left")
    beyond = sum(
        (F.when(F.col(f"_c_{i}").isNull() | (F.col("_hash") > F.col(f"_c_{i}")), 1).otherwise(0) for i in range(len(cuts))),
        F.lit(0),
    )
    return joined.withColumn(name, F.when(F.col(group).isNotNull(), beyond)).drop("_hash", *[f"_c_{i}" for i in range(len(cuts))])


def _rounded(share: float) -> Column:
    return F.floor(F.col("n") * share + 0.5)


def stratified_split(
    df: DataFrame, label: str, keys: list[str], val: float = 0.15, test: float = 0.15, seed: int = 42,
    order: Column | None = None,
) -> DataFrame:
    """Add ``split`` (train, val or test) with exact shares in every class; rows without a label have none.

    ``order`` replaces the hash of the keys: a bigint with few ties.
    """
    value = seeded_hash(seed, *keys) if order is None else order
    cuts = {"test": _rounded(test), "val": _rounded(test) + _rounded(val)}
    placed = assign_by_rank(df, label, value, cuts, "_part")
    names = F.array(F.lit("test"), F.lit("val"), F.lit("train"))
    return placed.withColumn("split", F.get(names, F.col("_part"))).drop("_part")


def stratified_folds(
    df: DataFrame, label: str, keys: list[str], k: int, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add ``fold`` from 0 to k-1, of equal size in every class; rows without a label have none."""
    cuts = {f"c{i}": F.floor(F.col("n") * i / k) for i in range(1, k)}
    return assign_by_rank(df, label, seeded_hash(seed, *keys), cuts, name)


def seeded_sample(df: DataFrame, keys: list[str], n: int = 500, seed: int = 42) -> DataFrame:
    """A sample of n rows without replacement."""
    return df.orderBy(seeded_hash(seed, *keys), *keys).limit(n)


def shuffle_rows(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    return df.orderBy(seeded_hash(seed, *keys), *keys)
