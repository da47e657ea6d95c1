"""Attribution of scores to features and robustness of a model."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.evaluation import weighted_metrics
from tidewatch.operators.ordering import with_line_numbers
from tidewatch.operators.sampling import seeded_hash

# The wording of explanations.
OPENINGS = {
    "TP": "Correctly flagged as malicious because",
    "FP": "Incorrectly flagged as attack because",
    "FN": "Missed attack because",
}


def attribution(
    model: Model, rows: DataFrame, background: DataFrame, columns: list[str], row_id: str,
    permutations: int = 10, positive: int = 1, seed: int = 42, background_keys: list[str] | None = None,
) -> DataFrame:
    """Rows of (row_id, feature, phi, base): sampled Shapley values of the positive probability.

    For each row and permutation the features are switched one by one from a background row to the
    row's own values; a feature is credited with the change of the score when it is switched. The
    background row is drawn from the whole background by a hash; ``base`` is the mean score of
    those drawn for a row, so the values of a row add up to its score less ``base``.
    """
    d = len(columns)
    x = F.array(*[F.col(c).cast("double") for c in columns])
    keys = background_keys or [row_id]
    pool = with_line_numbers(background.select(*keys, x.alias("b")), keys, "_number").select("_number", "b")
    size = pool.count()
    jobs = (
        rows.select(row_id, x.alias("x"))
        .withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_number", F.pmod(seeded_hash(seed, row_id, "perm"), F.lit(size)) + 1)
        .join(pool, "_number").drop("_number")
    )
    order = F.transform(
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.lit(d - 1)),
                lambda j: F.struct(F.xxhash64(F.lit(seed), F.col(row_id), F.col("perm"), j).alias("h"), j.alias("j")),
            )
        ),
        lambda s: s["j"],
    )
    steps = jobs.withColumn("order", order).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mixed = F.transform(
        F.arrays_zip("x", "b"),
        lambda v, j: F.when(F.array_position("order", j) <= F.col("step"), v["x"]).otherwise(v["b"]),
    )
    scored = model.transform(steps.withColumn("features", array_to_vector(mixed)))
    p = vector_to_array("probability")[positive]
    # the steps of one row and permutation
    walk = Window.partitionBy(row_id, "perm").orderBy("step")
    change = scored.select(row_id, "perm", "step", "order", p.alias("p")).withColumns(
        {"_d": F.col("p") - F.lag("p").over(walk), "_b": F.first("p").over(walk)}
    )
    names = F.array(*[F.lit(c) for c in columns])
    return (
        change.where("step > 0")
        .withColumn("feature", F.get(names, F.get("order", F.col("step") - 1)))
        .groupBy(row_id, "feature")
        .agg(F.avg("_d").alias("phi"), F.avg("_b").alias("base"))
    )


def top_features(phi: DataFrame, k: int = 10) -> DataFrame:
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi")).orderBy(
        F.desc("mean_abs_phi"), "feature"
    ).limit(k)


def explain_examples(phi: DataFrame, examples: DataFrame, row_id: str, k: int = 3) -> DataFrame:
    """Examples (with ``cell`` and ``rank``) with their top features and a sentence."""
    order = Window.partitionBy(row_id).orderBy(F.abs("phi").desc(), "feature")
    # features of one row
    top = phi.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    lists = top.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("_r", "feature", "phi"))).alias("top"))
    parts = F.transform(
        "top",
        lambda t: F.format_string(
            "%s %s suspicion (SHAP=%.3f)",
            t["feature"], F.when(t["phi"] > 0, F.lit("increased")).otherwise(F.lit("decreased")), t["phi"],
        ),
    )
    opening = F.lit("Prediction driven by")
    for cell, text in OPENINGS.items():
        opening = F.when(F.col("cell") == cell, F.lit(text)).otherwise(opening)
    sentence = F.concat(opening, F.lit(" "), F.array_join(parts, "; "), F.lit("."))
    return examples.join(lists, row_id).select(
        "cell", "rank", row_id,
        F.transform("top", lambda t: F.struct(t["feature"], t["phi"])).alias("top_features"),
        sentence.alias("explanation"),
    )


def importance(model: Model, columns: list[str], spark, k: int = 15) -> DataFrame:
    """The features of a tree model by its own importance."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def seeded_normal(seed: int, *keys) -> Column:
    """A standard normal number from two hashes of the keys."""

    def uniform(salt):
        h = F.xxhash64(F.lit(seed), F.lit(salt), *keys)
        return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(2.0**53)

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * F.pi() * uniform(2))


def noise_robustness(
    model: Model, df: DataFrame, columns: list[str], keys: list[str], label: str, sd: float = 0.05, seed: int = 42
) -> DataFrame:
    """One row: accuracy on clean and on noisy scaled features, and the relative drop in percent."""
    ids = [F.col(k) for k in keys]

    def score(noisy):
        values = [
            F.col(c).cast("double") + (F.lit(sd) * seeded_normal(seed, F.lit(i), *ids) if noisy else F.lit(0.0))
            for i, c in enumerate(columns)
        ]
        scored = model.transform(df.select(label, array_to_vector(F.array(*values)).alias("features")))
        return weighted_metrics(scored, label).select(F.col("accuracy").alias("a"))

    both = score(False).select(F.col("a").alias("accuracy_clean")).withColumn("accuracy_noisy", score(True).scalar())
    drop = (F.col("accuracy_clean") - F.col("accuracy_noisy")) / F.greatest("accuracy_clean", F.lit(1e-9)) * 100
    return both.select(
        F.round("accuracy_clean", 4).alias("accuracy_clean"), F.round("accuracy_noisy", 4).alias("accuracy_noisy"),
        F.round(drop, 2).alias("robustness_drop_pct"),
    )
