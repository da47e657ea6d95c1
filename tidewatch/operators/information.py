"""Mutual information of continuous columns and a class, estimated from nearest neighbours.

For every point the distance to its ``k``-th neighbour of the same class is taken, and the points of all classes closer than that are counted; the estimate
is digamma(rows) + mean digamma(k) - mean digamma(rows of the class) - mean digamma(points counted), at least 0.

Values are counted per column and class first, so a value that many rows share is one row of the runs. Runs are sorted by range partitions; only the
``k`` values at either end of a partition cross its border, and the points inside a distance are a difference of two running totals.

Defined results: rows without a class, and values that are null or not finite, are left out for their column; so are classes with one value of
a column, as they have no neighbour. Where the ``k``-th neighbour is at distance 0, ``k`` is the number of equal values of the class, and the equal values
of all classes are counted, so columns of few values get the estimate of their table of counts. A column without any class left has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ordering import running_totals, unpivot
from tidewatch.session import materialize


def digamma(n: Column) -> Column:
    """The digamma function of numbers from 1 on: the recurrence up to where the asymptotic series is exact to twelve digits."""
    y = n + 8
    series = F.ln(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6) + 1 / (240 * y**8)
    return series - sum((1 / (n + i) for i in range(8)), F.lit(0.0))


def _around(counts: DataFrame, k: int) -> DataFrame:
    """Each value of a (feature, class) with those up to ``k`` places before and after it: ``_l1``, ``_r1`` and so on are their distances, ``_ln1``, ``_rn1`` their counts."""
    group = ["feature", "_y"]
    ranged = counts.repartitionByRange(*group, "value").withColumn("_block", F.spark_partition_id()).sortWithinPartitions(*group, "value")
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "runs")
    pair = F.struct("value", "n")
    spans = placed.groupBy(*group, "_block").agg(F.min("_place").alias("_start"), F.max("_place").alias("_end"))  # one row a block and group
    first, last = F.col("_place") - F.col("_start") < k, F.col("_end") - F.col("_place") < k
    ends = placed.join(spans, [*group, "_block"]).where(first | last).groupBy(*group, "_block").agg(
        F.sort_array(F.collect_list(F.when(first, pair))).alias("_first"), F.sort_array(F.collect_list(F.when(last, pair))).alias("_last")
    )
    # a block that has the group at all has a value of it, so k blocks are enough; one row a block and group
    blocks = Window.partitionBy(*group).orderBy("_block")
    before = F.slice(F.reverse(F.flatten(F.collect_list("_last").over(blocks.rowsBetween(-k, -1)))), 1, k)
    after = F.slice(F.flatten(F.collect_list("_first").over(blocks.rowsBetween(1, k))), 1, k)
    carried = ends.select(*group, "_block", F.concat(before, after).alias("_more")).select(*group, "_block", F.inline("_more"))
    # a block's rows and at most k carried ones on either side of a group
    both = placed.drop("_place").withColumn("_own", F.lit(True)).unionByName(carried.withColumn("_own", F.lit(False)))
    inside = Window.partitionBy("_block", *group).orderBy("value")
    near = [
        c
        for i in range(1, k + 1)
        for c in (
            (F.col("value") - F.lag("value", i).over(inside)).alias(f"_l{i}"), F.lag("n", i).over(inside).alias(f"_ln{i}"),
            (F.lead("value", i).over(inside) - F.col("value")).alias(f"_r{i}"), F.lead("n", i).over(inside).alias(f"_rn{i}"),
        )
    ]
    return both.select(*group, "value", "n", "_own", *near).where("_own").drop("_own")


def _reach(k: int, wanted: Column) -> Column:
    """The distance within which ``wanted`` other rows are: equal values first, then those around."""
    own = F.col("n") - 1
    found = [F.when(own >= wanted, F.lit(0.0))]
    for side, other in (("_l", "_r"), ("_r", "_l")):
        upto = own
        for i in range(1, k + 1):
            d = F.col(f"{side}{i}")
            upto = upto + F.coalesce(f"{side}n{i}", F.lit(0))
            across = sum((F.when(F.col(f"{other}{j}") <= d, F.col(f"{other}n{j}")).otherwise(0) for j in range(1, k + 1)), F.lit(0))
            found.append(F.when(upto + across >= wanted, d))
    return F.least(*found)  # leaves out nulls


def neighbour_information(df: DataFrame, columns: list[str], label: str, k: int = 3) -> DataFrame:
    """Rows of (feature, mutual_info) in nats."""
    long = unpivot(df.where(F.col(label).isNotNull()).withColumnRenamed(label, "_y"), columns, ["_y"])
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    counts = materialize(long.where(finite).withColumn("value", F.col("value") + 0.0).groupBy("feature", "_y", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    sizes = counts.groupBy("feature", "_y").agg(F.sum("n").alias("class_n")).where("class_n > 1")  # a row a column and class
    counts = materialize(counts.join(sizes, ["feature", "_y"]).drop("class_n"), "counts")

    wanted = F.least(F.lit(k), F.col("class_n") - 1)
    around = _around(counts, k).join(sizes, ["feature", "_y"]).select("feature", "_y", "value", "n", "class_n", _reach(k, wanted).alias("d"), wanted.alias("k"))
    around = around.withColumn("k", F.when(F.col("d") == 0, F.col("n")).otherwise(F.col("k")))
    # at an equal place, what asks for smaller values comes before them (0), what asks for these too behind them (2)
    low = F.struct((F.col("value") - F.col("d")).alias("place"), F.when(F.col("d") > 0, 2).otherwise(0).alias("turn"))
    high = F.struct((F.col("value") + F.col("d")).alias("place"), F.when(F.col("d") > 0, 0).otherwise(2).alias("turn"))
    asked = materialize(around.withColumn("_low", low).withColumn("_high", high), "reaches")
    points = counts.groupBy("feature", F.col("value").alias("place")).agg(F.sum("n").alias("n")).withColumn("turn", F.lit(1))
    bounds = asked.select("feature", F.explode(F.array("_low", "_high")).alias("_b")).select("feature", "_b.place", "_b.turn").distinct().withColumn("n", F.lit(0).cast("long"))
    totals = materialize(running_totals(points.select("feature", "place", "turn", "n").unionByName(bounds), ["feature"], ["place", "turn"], ["n"]).where("turn <> 1"), "ranks")

    def below(name: str) -> DataFrame:
        return totals.select(F.col("feature").alias(f"{name}_f"), F.struct("place", "turn").alias(f"{name}_b"), F.col("cum_n").alias(name))

    counted = asked
    for name in ("_low", "_high"):
        t = below(f"{name}_n")
        counted = counted.join(t, (F.col("feature") == F.col(f"{name}_n_f")) & (F.col(name) == F.col(f"{name}_n_b")))
    inner = F.col("_high_n") - F.col("_low_n")
    # a term for each value, weighted by its rows
    term = digamma(F.col("k")) - digamma(F.col("class_n")) - digamma(inner)
    sums = counted.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum((F.col("n") * term).cast("decimal(38,12)")).alias("s"))
    return sums.select("feature", F.greatest(F.lit(0.0), digamma(F.col("rows")) + F.col("s").cast("double") / F.col("rows")).alias("mutual_info"))
