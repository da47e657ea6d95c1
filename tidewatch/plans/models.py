"""Queries on sampling, neighbours, scored tables and models."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.operators import boosting, chain, evaluation, explanation, neighbours, neural, preparation, profile, sampling, training
from tidewatch.plans import inputs
from tidewatch.plans.inputs import round6, sql6
from tidewatch.session import materialize, shared_dir

_WIDTH = 16
_COLUMNS = [f"f{i}" for i in range(_WIDTH)]


def _scored(spark, sf):
    """Labelled documents with a made-up score: quality is the label, the score comes from the id."""
    rows = inputs.table(spark, sf, "labels")
    score = (F.pmod(F.col("doc_id") * 37, F.lit(100)) / 100 + F.col("quality") * 0.1)
    return rows.select(
        "doc_id", F.col("quality").alias("label"), score.alias("score"), (score >= 0.5).cast("int").alias("prediction"),
        F.pmod(F.col("doc_id") * 7, F.lit(11)).cast("double").alias("a"), F.pmod(F.col("doc_id"), F.lit(5)).cast("double").alias("b"),
    )


_SCORED_SQL = """
base AS (SELECT doc_id, quality AS label, (doc_id * 37) % 100 / 100.0::DOUBLE + quality * 0.1::DOUBLE AS score,
  CAST((doc_id * 7) % 11 AS DOUBLE) AS a, CAST(doc_id % 5 AS DOUBLE) AS b FROM labels),
scored AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM base)"""


def stratified_split(spark, sf):
    """Split sizes per class, by an order both engines share."""
    labels = inputs.table(spark, sf, "labels")
    order = F.col("doc_id") * 2654435761 % 4294967296 * 2147483648 + F.col("doc_id")
    split = sampling.stratified_split(labels, "quality", ["doc_id"], order=order)
    return split.select("doc_id", "quality", "split")


def stratified_folds(spark, sf):
    """Rows per class and fold; which rows depends on the hash."""
    folds = sampling.stratified_folds(inputs.table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], 5)
    return folds.groupBy("l_returnflag", "fold").agg(F.count("*").alias("n"))


def seeded_sample(spark, sf):
    """Five hundred rows without repetition, all from the table."""
    events = inputs.events(spark, sf)
    sample = sampling.seeded_sample(events, ["event_id"], 500)
    return sample.join(events.select("event_id"), "event_id", "left_semi").agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("n_distinct")
    )


def _vectors(spark, sf):
    e = inputs.table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))


def _asked(spark, sf):
    """The stated query set: every twentieth id, against all rows."""
    points = _vectors(spark, sf).select(F.col("vec_id").alias("pid"), "x")
    return points.where("pid % 20 = 0"), points


def nearest_neighbours(spark, sf):
    found = neighbours.exact_neighbours(*_asked(spark, sf), 5)
    return found.select(F.col("pid").alias("vec_id"), F.col("nb").alias("neighbour"), "rank")


def neighbour_recall(spark, sf):
    """The index over all rows, held against the exact neighbours of the query set."""
    asked, points = _asked(spark, sf)
    found = neighbours.nearest_neighbours(points, 5)
    row = neighbours.recall(found, neighbours.exact_neighbours(asked, points, 5))
    full = found.groupBy("pid").count().agg(F.count("*").alias("n_points"), F.min("count").alias("fewest"))
    return row.select("n_pairs", (F.col("recall") >= 0.95).alias("good")).crossJoin(full)


def _training_table(spark, sf):
    v = _vectors(spark, sf)
    return v.select("vec_id", (F.col("label") < 3).cast("double").alias("y"), *[F.col("x")[i].alias(c) for i, c in enumerate(_COLUMNS)])


def smote_counts(spark, sf):
    """Rows by class, and how many synthetic ones lie between two different rows of the table of that class."""
    table = _training_table(spark, sf)
    made = materialize(neighbours.smote(table, _COLUMNS, "y", ["vec_id"], trace=True), "balanced")
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in _COLUMNS])
    known = table.select(F.col("y").alias("_y"), x.alias("_v")).distinct()
    ends = [made.where("synthetic").select("y", F.col(c).alias("_v"), F.col("_x") != F.col("_target")) for c in ("_x", "_target")]
    strange = sum(e.join(known, (e["y"] == known["_y"]) & (e["_v"] == known["_v"]), "left_anti").count() for e in ends)
    y = F.array(*[F.col(c).cast("double") for c in _COLUMNS])
    whole = F.aggregate(F.zip_with("_x", "_target", lambda p, q: (q - p) * (q - p)), F.lit(0.0), lambda s, v: s + v)
    parts = [F.sqrt(F.aggregate(F.zip_with(y, e, lambda p, q: (q - p) * (q - p)), F.lit(0.0), lambda s, v: s + v)) for e in ("_x", "_target")]
    between = F.abs(parts[0] + parts[1] - F.sqrt(whole)) < 1e-6
    return made.groupBy("y", "synthetic").agg(
        F.count("*").alias("n"), F.count_if(F.col("synthetic") & between).alias("n_between"), F.lit(strange == 0).alias("ends_known")
    )


def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(_scored(spark, sf))


def weighted_metrics(spark, sf):
    m = evaluation.weighted_metrics(_scored(spark, sf))
    return m.select(*[round6(c).alias(c) for c in m.columns])


def security_metrics(spark, sf):
    m = evaluation.security_metrics(_scored(spark, sf), 1, score="score")
    names = ["false_positive_rate", "false_negative_rate", "f1_positive", "roc_auc", "pr_auc"]
    return m.select("tp", "fp", "fn", "tn", *[round6(c).alias(c) for c in names])


def roc_curve(spark, sf):
    points = evaluation.curve_points(_scored(spark, sf), F.col("label") == 1, "score")
    return evaluation.roc_curve(points).select(*[round6(c).alias(c) for c in ("threshold", "fpr", "tpr")])


def pr_curve(spark, sf):
    points = evaluation.curve_points(_scored(spark, sf), F.col("label") == 1, "score")
    return evaluation.pr_curve(points).select(*[round6(c).alias(c) for c in ("threshold", "precision", "recall")])


def threshold_sweep(spark, sf):
    sweep = evaluation.threshold_sweep(_scored(spark, sf), F.col("label") == 1, "score")
    return sweep.select("tp", "fp", "fn", *[round6(c).alias(c) for c in ("threshold", "precision", "recall", "f1")])


def threshold_choice(spark, sf):
    sweep = evaluation.threshold_sweep(_scored(spark, sf), F.col("label") == 1, "score")
    best = evaluation.recommend_threshold(sweep)
    return best.select(round6("threshold").alias("threshold"), round6("recall").alias("recall"), round6("f1").alias("f1"))


def error_drivers(spark, sf):
    found = evaluation.error_analysis(_scored(spark, sf), F.col("label") == 1, F.col("prediction") == 1, ["a", "b"])
    return found.select(
        "false_positive_count", "false_negative_count", "feature", *[round6(c).alias(c) for c in ("fp_mean", "tn_mean", "difference")]
    )


def example_rows(spark, sf):
    return evaluation.example_rows(_scored(spark, sf), F.col("label") == 1, F.col("prediction") == 1, "doc_id").select("doc_id", "cell", "rank")


def _model_tables(spark, sf):
    """Split, scaled and assembled tables of a two-class problem."""
    split = materialize(sampling.stratified_split(_training_table(spark, sf), "y", ["vec_id"]), "split")
    scaler = preparation.fit_scaler(split.where("split = 'train'"), _COLUMNS)
    return materialize(training.assembled(preparation.scale(split, scaler), _COLUMNS), "assembled")


def _forest(table):
    return RandomForestClassifier(labelCol="y", seed=42, numTrees=20, maxDepth=5).fit(table.where("split = 'train'"))


def model_scores(spark, sf):
    """A forest scored on the held-out rows at a threshold of 0.4: by class the rows, those with a chance for a score, wrong alerts."""
    table = _model_tables(spark, sf)
    scored = training.score_batch(_forest(table), table.where("split = 'test'"))
    return scored.groupBy("y").agg(
        F.count("*").alias("n"), F.count_if(F.col("score").between(0, 1)).alias("n_scored"), F.count_if(F.col("alert") != (F.col("score") >= 0.4)).alias("n_wrong")
    )


def model_comparison(spark, sf):
    """Three model kinds with one setting each, searched over two folds and compared on the test part."""
    table = _model_tables(spark, sf)
    train = sampling.stratified_folds(table.where("split = 'train'"), "y", ["vec_id"], 2)
    spaces = {
        "random_forest": {"numTrees": [10], "maxDepth": [4]},
        "gradient_boosting": {"maxIter": [5], "maxDepth": [3]},
        "neural_network": {"maxIter": [30]},
    }
    results = training.train_models(train, table.where("split = 'val'"), "y", _COLUMNS, spaces=spaces, folds=dict.fromkeys(spaces, 2))
    models = {n: r["model"] for n, r in results.items()}
    compared = training.compare_models(models, table.where("split = 'test'"), "y")
    chances = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")]
    return compared.select("model", reduce(Column.__and__, chances).alias("in_range"), (F.col("recall") == F.col("accuracy")).alias("recall_is_accuracy"))


def model_attribution(spark, sf):
    """All rows of the test part explained; the values of a row must add up to its score less that of its background."""
    table = _model_tables(spark, sf)
    model, rows = _forest(table), table.where("split = 'test'")
    phi = explanation.attribution(model, rows, table.where("split = 'train'"), _COLUMNS, "vec_id", permutations=4)
    sums = phi.groupBy("vec_id").agg(F.sum("phi").alias("s"), F.max("base").alias("base"), F.count("*").alias("n"))
    scored = training.with_score(model.transform(rows)).select("vec_id", "score")
    exact = F.abs(F.col("s") + F.col("base") - F.col("score")) < 1e-9
    return sums.join(scored, "vec_id").agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_values"), F.count_if(exact).alias("n_exact"))


def model_explanations(spark, sf):
    table = _model_tables(spark, sf)
    model = _forest(table)
    scored = model.transform(table)
    examples = evaluation.example_rows(scored, F.col("y") == 1, F.col("prediction") == 1, "vec_id")
    chosen = materialize(examples.select("cell", "rank", "vec_id", *_COLUMNS), "examples")
    phi = explanation.attribution(model, chosen, table.where("split = 'train'"), _COLUMNS, "vec_id", permutations=4)
    told = explanation.explain_examples(phi, chosen, "vec_id")
    opening = F.col("explanation").rlike("^(Correctly flagged as malicious|Incorrectly flagged as attack|Missed attack) because f")
    return told.agg(
        F.count_if(~opening).alias("n_strange"), F.count_if(F.size("top_features") != 3).alias("n_short"),
        F.count_if(F.size(F.regexp_extract_all("explanation", F.lit("SHAP="), F.lit(0))) != 3).alias("n_untold"), (F.count("*") <= 5).alias("few"),
    )


def model_importance(spark, sf):
    found = explanation.importance(_forest(_model_tables(spark, sf)), _COLUMNS, spark, k=_WIDTH)
    return found.agg(F.count("*").alias("n"), round6(F.sum("importance")).alias("total"), F.count_if(~F.col("importance").between(0, 1)).alias("n_wrong"))


def model_robustness(spark, sf):
    table = _model_tables(spark, sf)
    r = explanation.noise_robustness(_forest(table), table.where("split = 'train'"), _COLUMNS, ["vec_id"], "y", sd=1.0)
    return r.select(
        (F.col("accuracy_noisy") <= F.col("accuracy_clean")).alias("noise_hurts"), F.col("accuracy_clean").between(0.5, 1).alias("learned"),
        (F.col("robustness_drop_pct") >= 0).alias("drop"),
    )


def own_classifiers(spark, sf):
    """The net and the softmax boosting next to a forest on the held-out rows: whether the weighted F1 is within 0.01 of the forest's, or above."""
    table = _model_tables(spark, sf)
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    net = neural.ReluNetClassifier(labelCol="y", hidden=[32, 16], maxIter=20, batchSize=32, learningRate=0.01, shards=2).fit(train)
    trees = boosting.SoftmaxBoostingClassifier(labelCol="y", maxIter=8, maxDepth=3, stepSize=0.5).fit(train)
    least = evaluation.weighted_metrics(_forest(table).transform(test), "y").first().f1 - 0.01
    found = [(n, evaluation.weighted_metrics(m.transform(test), "y").first().f1 >= least, test.count()) for n, m in (("relu_network", net), ("softmax_boosting", trees))]
    return spark.createDataFrame(found, "model string, as_good boolean, n bigint")


def named_chain(spark, sf):
    """Raw rows with text labels through the saved and loaded chain: by label the rows, those whose score is that of the chain in memory, and those named by a known label."""
    raw = _training_table(spark, sf).withColumn("label", F.when(F.col("y") == 1, "Attack").otherwise("Benign")).withColumn("f0", F.when(F.col("vec_id") % 9 != 0, F.col("f0")))
    split = materialize(sampling.stratified_split(raw, "label", ["vec_id"]), "split")
    forest = RandomForestClassifier(labelCol="label_index", seed=42, numTrees=5)
    balanced = lambda df, columns, label: neighbours.smote(df, columns, label, ["vec_id"]).select(*columns, label)
    fitted = chain.fit_chain(split.where("split = 'train'"), _COLUMNS, "label", forest, "Attack", k=8, balance=balanced)
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/chain-{uuid.uuid4().hex}"
    fitted.write().save(folder)
    test = split.where("split = 'test'").select("vec_id", "label", *_COLUMNS)
    there = PipelineModel.load(folder).transform(test)
    both = there.join(fitted.transform(test).select("vec_id", F.col("score").alias("_score")), "vec_id")
    return both.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("score") == F.col("_score")).alias("n_equal"), F.count_if(F.col("predicted_label").isin("Attack", "Benign")).alias("n_named"))


def threshold_detail(spark, sf):
    """The recommended threshold and the rows of the three fixed ones."""
    found = evaluation.threshold_analysis(_scored(spark, sf), F.col("label") == 1, "score")
    return found.select("kind", "tp", "fp", "fn", *[round6(c).alias(c) for c in ("threshold", "precision", "recall", "f1")])


def error_advice(spark, sf):
    """What the errors of the scored rows recommend."""
    found = evaluation.error_analysis(_scored(spark, sf), F.col("label") == 1, F.col("prediction") == 1, ["a", "b"])
    return evaluation.recommendations(found)


def search_folds(spark, sf):
    """Two settings searched over two folds: the mean F1 counted again from the predictions of each fold, which no other setting's exceeds."""
    table = _model_tables(spark, sf)
    folded = materialize(sampling.stratified_folds(table.where("split = 'train'"), "y", ["vec_id"], 2), "folds")
    model, settings = RandomForestClassifier(labelCol="y", seed=42, numTrees=10), [{"maxDepth": 1}, {"maxDepth": 6}]
    best, score = training.search(model, settings, folded, "y", "fold", 2)
    means = {}
    for s in settings:
        each = []
        for fold in range(2):
            scored = training._with_settings(model, s).fit(folded.where(F.col("fold") != fold)).transform(folded.where(F.col("fold") == fold))
            counts = scored.groupBy("y", "prediction").agg(F.count("*").alias("n"))
            own = materialize(counts, "fold-counts")
            by = [own.where(F.col("y") == c).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("prediction") == c, F.col("n")).otherwise(0)).alias("tp")).withColumn("c", F.lit(float(c))) for c in (0, 1)]
            called = own.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("called"))
            classes = by[0].unionByName(by[1]).join(called, "c", "left").fillna(0, ["called"])
            each.append(classes.agg((F.sum(2 * F.col("tp") / (F.col("n") + F.col("called")) * F.col("n")) / F.sum("n")).alias("f1")).first().f1)
        means[s["maxDepth"]] = sum(each) / 2
    rows = [(d, abs(m - score) < 1e-9 if best["maxDepth"] == d else m < score + 1e-9) for d, m in means.items()]
    return spark.createDataFrame(rows, "max_depth int, mean_agrees boolean")


def load_gate(spark, sf):
    """A table that is checked before training: what is wrong with it, if anything, when it lacks the label, columns or rows."""
    table = inputs.table(spark, sf, "labels")
    n = table.count()
    cases = {"as it is": (table, "quality", n, 2), "no label": (table, "verdict", n, 2), "few columns": (table.select("doc_id", "quality"), "quality", n, 2), "few rows": (table, "quality", n + 1, 2)}
    rows = []
    for name, (df, label, least, width) in cases.items():
        try:
            profile.check_dataset(df, label, least, width, {"quality"})
            rows.append((name, None))
        except ValueError as e:
            rows.append((name, str(e)))
    return spark.createDataFrame(rows, "case string, complaint string")


QUERIES = {
    f.__name__: f
    for f in (
        stratified_split, stratified_folds, seeded_sample, nearest_neighbours, neighbour_recall, smote_counts, confusion_matrix,
        weighted_metrics, security_metrics, roc_curve, pr_curve, threshold_sweep, threshold_choice, error_drivers,
        example_rows, model_scores, model_comparison, model_attribution, model_explanations, model_importance, model_robustness, own_classifiers, named_chain,
        threshold_detail, error_advice, search_folds, load_gate,
    )
}

_SWEEP = ", ".join(f"({t!r}::DOUBLE)" for t in evaluation.THRESHOLDS)
_SWEEP_CTE = f"""
levels AS (SELECT * FROM (VALUES {_SWEEP}) v(threshold)),
counts AS (SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
  count(*) FILTER (label = 1 AND score < threshold) AS fn FROM scored, levels GROUP BY 1),
sweep AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM counts)"""
_POINTS_CTE = """
points AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg FROM (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1) WINDOW w AS (ORDER BY score DESC)),
curve AS (SELECT *, (SELECT count(*) FROM scored WHERE label = 1) AS p, (SELECT count(*) FROM scored WHERE label = 0) AS n FROM points)"""
_TEST_SQL = "SELECT CAST(label < 3 AS DOUBLE) AS y, CAST(floor(count(*) * 0.15::DOUBLE + 0.5) AS BIGINT) AS n FROM embeddings GROUP BY 1"
_CELL = "CASE WHEN label = 1 AND prediction = 1 THEN 'TP' WHEN label = 0 AND prediction = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END"

ORACLES = {
    "model_scores": f"SELECT y, n, n AS n_scored, 0 AS n_wrong FROM ({_TEST_SQL})",
    "model_comparison": """SELECT unnest(['Random Forest', 'Gradient Boosting', 'Neural Network']) AS model, true AS in_range, true AS recall_is_accuracy""",
    "model_attribution": f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(16 * sum(n) AS BIGINT) AS n_values, CAST(sum(n) AS BIGINT) AS n_exact FROM ({_TEST_SQL})",
    "model_explanations": "SELECT 0 AS n_strange, 0 AS n_short, 0 AS n_untold, true AS few",
    "model_importance": f"SELECT {_WIDTH} AS n, {sql6('1.0')} AS total, 0 AS n_wrong",
    "threshold_detail": f"""WITH {_SCORED_SQL}, {_SWEEP_CTE},
        d AS (SELECT t AS threshold, count(*) FILTER (label = 1 AND score >= t) AS tp, count(*) FILTER (label = 0 AND score >= t) AS fp, count(*) FILTER (label = 1 AND score < t) AS fn
          FROM scored, (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE)) v(t) GROUP BY 1),
        rows AS (SELECT 'detail' AS kind, threshold, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
          CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM d
          UNION ALL (SELECT 'recommended', threshold, tp, fp, fn, precision, recall, f1 FROM sweep ORDER BY (recall >= 0.85 AND f1 > 0) DESC, f1 DESC, threshold LIMIT 1))
        SELECT kind, tp, fp, fn, {sql6('threshold')} AS threshold, {sql6('precision')} AS precision, {sql6('recall')} AS recall, {sql6('f1')} AS f1 FROM rows""",
    "error_advice": f"""WITH {_SCORED_SQL}, cells AS (SELECT *, {_CELL} AS cell FROM scored),
        m AS (SELECT 'a' AS f, abs(avg(a) FILTER (cell = 'FP') - avg(a) FILTER (cell = 'TN')) AS d FROM cells UNION ALL SELECT 'b', abs(avg(b) FILTER (cell = 'FP') - avg(b) FILTER (cell = 'TN')) FROM cells),
        advice AS (SELECT 0 AS o, 'False positives often show unusual values in: ' || string_agg(f, ', ' ORDER BY d DESC, f) AS recommendation, (SELECT count(*) FROM cells WHERE cell = 'FP') AS n FROM m
          UNION ALL SELECT 1, 'False negatives may indicate evasion — consider retraining with adversarial samples.', (SELECT count(*) FROM cells WHERE cell = 'FN')
          UNION ALL SELECT 2, 'Monitor feature drift monthly and retrain with new attack samples.', 1)
        SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS INTEGER) AS position, recommendation FROM advice WHERE n > 0""",
    "search_folds": "SELECT * FROM (VALUES (1, true), (6, true)) v(max_depth, mean_agrees)",
    "load_gate": """SELECT * FROM (VALUES ('as it is', NULL), ('no label', 'label column ''verdict'' not found'), ('few columns', '1 features, expected at least 2'),
        ('few rows', 'fewer than ' || (SELECT count(*) + 1 FROM labels) || ' rows')) v("case", complaint)""",
    "own_classifiers": f"SELECT unnest(['relu_network', 'softmax_boosting']) AS model, true AS as_good, CAST((SELECT sum(n) FROM ({_TEST_SQL})) AS BIGINT) AS n",
    "named_chain": f"SELECT CASE WHEN y = 1 THEN 'Attack' ELSE 'Benign' END AS label, n, n AS n_equal, n AS n_named FROM ({_TEST_SQL})",
    "model_robustness": "SELECT true AS noise_hurts, true AS learned, true AS drop",
    "stratified_split": """WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id * 2654435761 % 4294967296 * 2147483648 + doc_id) AS rn,
        count(*) OVER (PARTITION BY quality) AS n FROM labels)
        SELECT doc_id, quality, CASE WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
          WHEN rn <= 2 * floor(n * 0.15::DOUBLE + 0.5) THEN 'val' ELSE 'train' END AS split FROM r""",
    "stratified_folds": """WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_returnflag, CAST(i AS INTEGER) AS fold, CAST((i + 1) * n // 5 - i * n // 5 AS BIGINT) AS n FROM c, range(5) r(i)""",
    "seeded_sample": "SELECT least(count(*), 500) AS n, least(count(*), 500) AS n_distinct FROM events",
    "nearest_neighbours": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        d AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.x, b.x) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0),
        r AS (SELECT vec_id, neighbour, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour) AS INTEGER) AS rank FROM d)
        SELECT * FROM r WHERE rank <= 5""",
    "neighbour_recall": """SELECT least(5, (SELECT count(*) FROM embeddings) - 1) * count(*) FILTER (vec_id % 20 = 0) AS n_pairs, true AS good,
        count(*) AS n_points, CAST(5 AS BIGINT) AS fewest FROM embeddings""",
    "smote_counts": """WITH c AS (SELECT CAST(label < 3 AS DOUBLE) AS y, count(*) AS n FROM embeddings GROUP BY 1)
        SELECT y, false AS synthetic, n, 0 AS n_between, true AS ends_known FROM c
        UNION ALL SELECT y, true, (SELECT max(n) FROM c) - n, (SELECT max(n) FROM c) - n, true FROM c WHERE n < (SELECT max(n) FROM c)""",
    "confusion_matrix": f"WITH {_SCORED_SQL} SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2",
    "weighted_metrics": f"""WITH {_SCORED_SQL}, c AS (SELECT l AS class, count(*) FILTER (label = l) AS s, count(*) FILTER (prediction = l) AS q,
        count(*) FILTER (label = l AND prediction = l) AS tp FROM scored, (VALUES (0), (1)) k(l) GROUP BY 1)
        SELECT {sql6('sum(tp) / sum(s)')} AS accuracy, {sql6('sum(CASE WHEN q > 0 THEN tp / q ELSE 0 END * s) / sum(s)')} AS precision,
        {sql6('sum(CASE WHEN s > 0 THEN tp / s ELSE 0 END * s) / sum(s)')} AS recall, {sql6('sum(2 * tp / (s + q) * s) / sum(s)')} AS f1 FROM c WHERE s + q > 0""",
    "security_metrics": f"""WITH {_SCORED_SQL}, {_POINTS_CTE},
        m AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
          count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM scored),
        path AS (SELECT tp / p AS r, tp / (tp + fp) AS pr, tp / p AS tpr, fp / n AS fpr, score FROM curve UNION ALL SELECT 0, 1, 0, 0, 9),
        steps AS (SELECT *, lag(r) OVER w AS r0, lag(pr) OVER w AS pr0, lag(tpr) OVER w AS tpr0, lag(fpr) OVER w AS fpr0 FROM path WINDOW w AS (ORDER BY score DESC)),
        area AS (SELECT sum((r - r0) * (pr + pr0) / 2) AS pr_auc, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc FROM steps)
        SELECT tp, fp, fn, tn, {sql6('fp / (fp + tn)')} AS false_positive_rate, {sql6('fn / (fn + tp)')} AS false_negative_rate,
        {sql6('2 * tp / (2 * tp + fp + fn)')} AS f1_positive, {sql6('roc_auc')} AS roc_auc, {sql6('pr_auc')} AS pr_auc FROM m, area""",
    "roc_curve": f"WITH {_SCORED_SQL}, {_POINTS_CTE} SELECT {sql6('score')} AS threshold, {sql6('fp / n')} AS fpr, {sql6('tp / p')} AS tpr FROM curve",
    "pr_curve": f"WITH {_SCORED_SQL}, {_POINTS_CTE} SELECT {sql6('score')} AS threshold, {sql6('tp / (tp + fp)')} AS precision, {sql6('tp / p')} AS recall FROM curve",
    "threshold_sweep": f"""WITH {_SCORED_SQL}, {_SWEEP_CTE} SELECT tp, fp, fn, {sql6('threshold')} AS threshold, {sql6('precision')} AS precision,
        {sql6('recall')} AS recall, {sql6('f1')} AS f1 FROM sweep""",
    "threshold_choice": f"""WITH {_SCORED_SQL}, {_SWEEP_CTE} SELECT {sql6('threshold')} AS threshold, {sql6('recall')} AS recall, {sql6('f1')} AS f1
        FROM sweep ORDER BY (sweep.recall >= 0.85 AND sweep.f1 > 0) DESC, sweep.f1 DESC, sweep.threshold LIMIT 1""",
    "error_drivers": f"""WITH {_SCORED_SQL}, cells AS (SELECT *, {_CELL} AS cell FROM scored),
        m AS (SELECT 'a' AS feature, avg(a) FILTER (cell = 'FP') AS f, avg(a) FILTER (cell = 'TN') AS t FROM cells
          UNION ALL SELECT 'b', avg(b) FILTER (cell = 'FP'), avg(b) FILTER (cell = 'TN') FROM cells)
        SELECT (SELECT count(*) FROM cells WHERE cell = 'FP') AS false_positive_count, (SELECT count(*) FROM cells WHERE cell = 'FN') AS false_negative_count,
        feature, {sql6('f')} AS fp_mean, {sql6('t')} AS tn_mean, {sql6('abs(f - t)')} AS difference FROM m""",
    "example_rows": f"""WITH {_SCORED_SQL}, r AS (SELECT doc_id, {_CELL} AS cell, CAST(row_number() OVER (PARTITION BY {_CELL} ORDER BY doc_id) AS INTEGER) AS rank FROM scored)
        SELECT * FROM r WHERE cell <> 'TN' AND rank <= CASE WHEN cell = 'FN' THEN 1 ELSE 2 END""",
}
