"""Metrics of a scored table (row id, label, prediction, score of the positive class)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ordering import running_totals

# The threshold sweep and the recall floor of its recommendation.
THRESHOLDS = [0.1 + i * 0.05 for i in range(17)]
RECALL_FLOOR = 0.85
DETAIL = (0.3, 0.5, 0.7)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive=None
) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1; with ``positive`` also its cells."""
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    named = {}
    if positive is not None:
        actual, called = F.col("label") == F.lit(positive), F.col("prediction") == F.lit(positive)
        named = {"_tp": actual & called, "_fp": ~actual & called, "_fn": actual & ~called, "_tn": ~actual & ~called}
    # each cell counts for its actual and for its predicted class
    sides = F.array(
        F.struct(
            F.col("label").cast("string").alias("c"), F.col("n").alias("support"), hit.alias("tp"), none.alias("called"),
            *[F.when(c, F.col("n")).otherwise(0).alias(k) for k, c in named.items()],
        ),
        F.struct(
            F.col("prediction").cast(df.schema[label].dataType).cast("string").alias("c"), none.alias("support"),
            none.alias("tp"), F.col("n").alias("called"), *[none.alias(k) for k in named],
        ),
    )
    counts = ("support", "tp", "called", *named)
    per = cells.select(F.inline(sides)).groupBy("c").agg(*[F.sum(x).alias(x) for x in counts])
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("called")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = 2 * F.col("tp") / (F.col("support") + F.col("called"))
    total = F.sum("support")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(precision * F.col("support")) / total).alias("precision"),
        (F.sum(recall * F.col("support")) / total).alias("recall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"), *[F.sum(k).alias(k[1:]) for k in named],
    )


def curve_points(df: DataFrame, positive: Column, score: str) -> DataFrame:
    """Rows per distinct score: ``tp``, ``fp`` at that threshold and the totals ``p`` and ``n``.

    Scores are counted per value first; the order over them is a distributed running total.
    """
    counts = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    placed = running_totals(counts, [], ["score"], ["pos", "neg"])
    return placed.select(
        "score", "pos", "neg",
        (F.col("tot_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("tot_neg") - F.col("cum_neg") + F.col("neg")).alias("fp"),
        F.col("tot_pos").alias("p"),
        F.col("tot_neg").alias("n"),
    )


def roc_curve(points: DataFrame) -> DataFrame:
    return points.select(
        F.col("score").alias("threshold"), F.try_divide(F.col("fp"), F.col("n")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("p")).alias("tpr"),
    )


def pr_curve(points: DataFrame) -> DataFrame:
    return points.select(
        F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("p")).alias("recall"),
    )


def curve_areas(points: DataFrame) -> DataFrame:
    """One row: ROC-AUC and PR-AUC by trapezoids; the PR curve ends at recall 0, precision 1."""
    higher_pos = F.col("tp") - F.col("pos")
    higher = higher_pos + F.col("fp") - F.col("neg")
    before = F.when(higher > 0, higher_pos / higher).otherwise(F.lit(1.0))
    here = F.col("tp") / (F.col("tp") + F.col("fp"))
    return points.agg(
        F.try_divide(
            F.sum(F.col("neg") * (higher_pos + F.col("pos") / 2)), F.max(F.col("p") * F.col("n"))
        ).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * (before + here) / 2), F.max("p")).alias("pr_auc"),
    )


def security_metrics(
    df: DataFrame, positive, label: str = "label", prediction: str = "prediction", score: str | None = None
) -> DataFrame:
    """One row: weighted metrics, error rates and F1 of the positive class, curve areas with ``score``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def rate(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    row = weighted_metrics(df, label, prediction, positive).withColumns(
        {
            "false_positive_rate": rate(fp, fp + tn),
            "false_negative_rate": rate(fn, fn + tp),
            "f1_positive": rate(2 * tp, 2 * tp + fp + fn),
        }
    )
    if score is None:
        return row
    areas = curve_areas(curve_points(df, F.col(label) == F.lit(positive), score)).select(F.struct("roc_auc", "pr_auc"))
    return row.withColumn("_a", areas.scalar()).select("*", "_a.*").drop("_a")


def threshold_sweep(
    df: DataFrame, positive: Column, score: str, thresholds: list[float] | None = None, place: str | None = None
) -> DataFrame:
    """Rows of (threshold, tp, fp, fn, precision, recall, f1), all from one aggregate; ``place`` adds their place."""
    levels = THRESHOLDS if thresholds is None else thresholds
    wide = df.agg(
        F.count_if(positive).alias("p"),
        *[F.count_if(positive & (F.col(score) >= t)).alias(f"tp{i}") for i, t in enumerate(levels)],
        *[F.count_if(~positive & (F.col(score) >= t)).alias(f"fp{i}") for i, t in enumerate(levels)],
    )
    entries = [
        F.struct(
            F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
            (F.col("p") - F.col(f"tp{i}")).alias("fn"), *([F.lit(i).alias(place)] if place else []),
        )
        for i, t in enumerate(levels)
    ]
    zero = F.lit(0.0)
    return wide.select(F.inline(F.array(*entries))).withColumns(
        {
            "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), zero),
            "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), zero),
            "f1": F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero),
        }
    )


def _preference(recall_floor: float) -> list[Column]:
    eligible = (F.col("recall") >= recall_floor) & (F.col("f1") > 0)
    return [eligible.desc(), F.desc("f1"), F.col("threshold")]


def recommend_threshold(sweep: DataFrame, recall_floor: float = RECALL_FLOOR) -> DataFrame:
    """The threshold with the best F1 among those above the recall floor, else the best F1."""
    return sweep.orderBy(*_preference(recall_floor)).limit(1)


def threshold_analysis(df: DataFrame, positive: Column, score: str, recall_floor: float = RECALL_FLOOR) -> DataFrame:
    """The recommended threshold and the rows for 0.3, 0.5 and 0.7."""
    levels = [*THRESHOLDS, *DETAIL]
    sweep = threshold_sweep(df, positive, score, levels, place="_place")
    kind = F.when(F.col("_place") < len(THRESHOLDS), "recommended").otherwise("detail")
    # one row per level
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(*_preference(recall_floor)))
    ranked = sweep.withColumn("kind", kind).withColumn("_rank", rank)
    return ranked.where((F.col("kind") == "detail") | (F.col("_rank") == 1)).drop("_place", "_rank")


def confusion_cell(actual: Column, called: Column) -> Column:
    return (
        F.when(actual & called, F.lit("TP")).when(~actual & called, F.lit("FP"))
        .when(actual & ~called, F.lit("FN")).otherwise(F.lit("TN"))
    )


def example_rows(df: DataFrame, actual: Column, called: Column, row_id: str) -> DataFrame:
    """The first two true and false positives and the first false negative by row id."""
    cells = df.withColumn("cell", confusion_cell(actual, called)).where("cell <> 'TN'")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(row_id))
    # a ranking limit: tasks pass on two rows per cell
    return cells.withColumn("rank", rank).where("rank <= 2").where("cell <> 'FN' OR rank = 1")


def error_analysis(df: DataFrame, actual: Column, called: Column, features: list[str], k: int = 5) -> DataFrame:
    """Features by absolute difference of their mean in false positives and in true negatives."""
    cell = confusion_cell(actual, called)
    wide = df.withColumn("_cell", cell).agg(
        F.count_if(F.col("_cell") == "FP").alias("fp"),
        F.count_if(F.col("_cell") == "FN").alias("fn"),
        *[
            F.avg(F.when(F.col("_cell") == name, F.col(f).cast("double"))).alias(f"{name}{i}")
            for i, f in enumerate(features)
            for name in ("FP", "TN")
        ],
    )
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(f"FP{i}").alias("fp_mean"), F.col(f"TN{i}").alias("tn_mean"))
        for i, f in enumerate(features)
    ]
    rows = wide.select(
        F.col("fp").alias("false_positive_count"), F.col("fn").alias("false_negative_count"), F.inline(F.array(*entries))
    )
    return rows.withColumn("difference", F.abs(F.col("fp_mean") - F.col("tn_mean"))).orderBy(
        F.col("difference").desc_nulls_last(), "feature"
    ).limit(k)


def recommendations(analysis: DataFrame) -> DataFrame:
    """Advice from the rows of ``error_analysis``."""
    names = F.array_join(F.transform(F.array_sort(F.array_agg(F.struct(-F.col("difference"), "feature"))), lambda s: s["feature"]), ", ")
    one = analysis.groupBy("false_positive_count", "false_negative_count").agg(names.alias("drivers"))
    advice = F.array(
        F.when(
            F.col("false_positive_count") > 0,
            F.concat(F.lit("False positives often show unusual values in: "), F.col("drivers")),
        ),
        F.when(
            F.col("false_negative_count") > 0,
            F.lit("False negatives may indicate evasion — consider retraining with adversarial samples."),
        ),
        F.lit("Monitor feature drift monthly and retrain with new attack samples."),
    )
    return one.select(F.posexplode(F.filter(advice, lambda a: a.isNotNull())).alias("position", "recommendation"))
