"""Cases that were wrong once."""

import math

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import entropy_by_row, shannon_entropy
from tidewatch.operators import event_checks, evaluation, ordering, preparation, sampling, training
from tidewatch.operators.ordering import with_line_numbers
from tidewatch.plans import streams
from tidewatch.sources.logs import file_fingerprints
from tidewatch.streaming import jobs


def test_as_of_without_a_zone_is_utc(spark):
    row = ("e1", "2026-07-24T01:00:00Z", "203.0.113.1", None, "ALLOW", "success", "firewall", "x,1")
    names = "event_id string, timestamp string, source_ip string, target_ip string, action string, status string, log_type string, original_line string"
    df = with_line_numbers(spark.createDataFrame([row], names), ["event_id"])
    keep = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        found = event_checks.run_event_checks(df, dt.datetime(2026, 7, 24)).collect()
    finally:
        os.environ.pop("TZ") if keep is None else os.environ.update(TZ=keep)
        time.tzset()
    assert [r.description for r in found] == ["Timestamp '2026-07-24T01:00:00Z' is in the future (now=2026-07-24T00:00:00Z)."]


@pytest.fixture(scope="module")
def three(spark):
    rows = spark.range(300).selectExpr("id", "id % 3 AS y", "cast(id % 3 AS double) + rand(3) / 2 AS a", "rand(5) AS b", "1.0D + id % 2 AS w")
    return training.assembled(rows.withColumn("y", F.col("y").cast("double")), ["a", "b"]).cache()


def test_weighted_boosting_of_three_classes(three):
    model = training.base_model("gradient_boosting", 2, 3, "y", "w")
    model.getClassifier().setMaxIter(3)
    scored = model.fit(three).transform(three)
    metrics = training.validation_metrics(scored, "y", 3)
    assert metrics["roc_auc"] > 0.95 and metrics["accuracy"] > 0.9
    shares = [training.with_score(scored, c).select("id", F.col("score").alias(f"s{c}")) for c in range(3)]
    total = shares[0].join(shares[1], "id").join(shares[2], "id").select((F.col("s0") + F.col("s1") + F.col("s2")).alias("t"))
    assert total.where(F.abs(F.col("t") - 1) > 1e-9).count() == 0


def test_all_settings_of_the_search_act(three):
    two = three.where("y < 2")
    model = training.base_model("neural_network", 2, 2, "y").setMaxIter(2)
    weights = set()
    space = training.SEARCH_SPACE["neural_network"]
    assert len(training.draw_settings(space, training.DRAWS["neural_network"])) == training.DRAWS["neural_network"]
    for hidden in space["hidden"]:
        weights.add(training._with_settings(model, {"hidden": hidden}).fit(two).weights.size)
    assert len(weights) == 3
    iterations = [training._with_settings(model, {"maxIter": n, "hidden": (4,)}).fit(two).weights.toArray() for n in (1, 20)]
    assert (iterations[0] != iterations[1]).any()


def test_rows_without_a_label(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 > 0 THEN id % 2 END AS y")
    split = sampling.stratified_split(df, "y", ["id"])
    assert split.count() == 1000 and split.where("y IS NULL AND split IS NULL").count() == 100 and split.where("y IS NOT NULL AND split IS NULL").count() == 0
    folds = sampling.stratified_folds(df, "y", ["id"], 5)
    assert folds.where("y IS NULL AND fold IS NULL").count() == 100 and folds.groupBy("fold").count().count() == 6
    weights = preparation.class_weights(df, "y")
    assert weights.count() == 1000 and weights.where("weight IS NULL").count() == 100


def test_the_selection_follows_its_estimate(spark):
    df = spark.range(2000).selectExpr("id % 2 AS y", "id % 2 + rand(1) AS a", "rand(2) AS b", "id % 2 + 3 * rand(3) AS c")
    exact = preparation.mutual_information(df, ["a", "b", "c"], "y", approximate=False).orderBy(F.desc("mutual_info")).limit(2).collect()
    assert preparation.select_features(df, ["a", "b", "c"], "y", 2, approximate=False) == sorted(r.feature for r in exact) == ["a", "c"]


def test_preparation_is_learned_and_kept(spark):
    df = spark.range(400).selectExpr("id % 2 AS y", "CASE WHEN id % 5 > 0 THEN id % 2 + rand(1) END AS a", "rand(2) AS b", "id % 2 + rand(3) AS c")
    p = preparation.prepare(df, ["a", "b", "c"], "y", k=2)
    assert p.selected == ["a", "c"] and preparation.Preparation.from_json(p.to_json()) == p
    out = preparation.apply(p, df)
    assert out.where("a IS NULL").count() == 0 and abs(out.agg(F.avg("c")).first()[0]) < 0.05


def test_balancing_is_done_once_for_each_fold(spark, three):
    made = []

    def balance(train):
        made.append(1)
        return train

    parts = three.where("y < 2").withColumn("fold", F.col("id") % 2)
    model = training.base_model("random_forest", 2, 2, "y").setNumTrees(2)
    training.search(model, [{"maxDepth": d} for d in (1, 2, 3)], parts, "y", "fold", 2, balance)
    assert len(made) == 2


@pytest.mark.parametrize("parts", [1, 4])
def test_streams_read_a_file_and_a_folder(spark, tmp_path, parts):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(parts)
    if parts > 1:
        events.write.parquet(str(tmp_path / "events.parquet"))
    else:
        events.toPandas().to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    assert streams.stream_unique_events(spark, str(tmp_path)).count() == events.selectExpr("event_id div 2").distinct().count()


def test_equal_lines_have_ids_of_their_own(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a", "b"):
        (folder / name).write_text("2026-07-15 10:23:45 u h SUCCESS 1.1.1.1\n" * 3)
    out = jobs.run_available(jobs.stream_logs(spark, str(folder)), "t")
    again = jobs.run_available(jobs.stream_logs(spark, str(folder)), "t")
    assert out.select("event_id").distinct().count() == 6 and out.select("event_id").exceptAll(again.select("event_id")).count() == 0


def test_files_of_any_size_have_a_fingerprint(spark, tmp_path):
    (tmp_path / "a").write_text("x\ny\nx\n")
    (tmp_path / "b").write_text("y\nx\nx\n")
    (tmp_path / "c").write_text("y\nx\ny\n")
    prints = {r.file[-1]: (r.n_lines, r.fingerprint) for r in file_fingerprints(spark, str(tmp_path)).collect()}
    assert prints["a"] == prints["b"] != prints["c"] and prints["a"][0] == 3


def test_threshold_details_come_from_one_sweep(spark):
    df = spark.range(100).selectExpr("id % 2 AS y", "id / 100.0D AS score")
    found = evaluation.threshold_analysis(df, F.col("y") == 1, "score")
    assert sorted(r.threshold for r in found.where("kind = 'detail'").collect()) == [0.3, 0.5, 0.7] and found.where("kind = 'recommended'").count() == 1
    scans = found._jdf.queryExecution().executedPlan().toString().count("Range (0, 100")
    assert scans == 1


def test_the_row_before_across_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(ordering, "GROUP_BLOCKS", 3)
    df = spark.range(1, 400).selectExpr("id AS line", "id % 7 = 0 OR id BETWEEN 100 AND 130 AS here")
    found = {r.line: r.prev_line for r in ordering.previous_row(df, "line", F.col("here"), ["line"], 10).collect()}
    lines = [i for i in range(1, 400) if i % 7 == 0 or 100 <= i <= 130]
    assert found == dict(zip(lines, [None, *lines[:-1]]))


def test_entropy_by_row(spark):
    rows = [(1, "aab"), (2, ""), (3, None), (4, "x" * 50000 + "y" * 50000), (5, "日本日本")]
    df = spark.createDataFrame(rows, "i int, t string")
    found = {r.i: (round(r.entropy, 9), r.n_chars) for r in entropy_by_row(df, "i", "t").collect()}
    direct = {r.i: round(r.e, 9) for r in df.select("i", shannon_entropy(F.col("t")).alias("e")).collect()}
    assert {i: e for i, (e, _) in found.items()} == direct and found[4] == (1.0, 100000) and found[3] == (0.0, None)


def test_entropy_keeps_rows_apart(spark):
    from tidewatch.functions import text

    long = "ab" * text.BLOCK_CHARS + "c" * 100
    rows = [(1, "aaaa"), (1, "abcd"), (None, "ab"), (None, "aabb"), (2, None), (2, ""), (3, long), (3, long), (None, "x" * (text.BLOCK_CHARS + 1)), (4, "\U0001f600" * text.BLOCK_CHARS + "y")]
    found = sorted(((r.i, round(r.entropy, 9), r.n_chars) for r in entropy_by_row(spark.createDataFrame(rows, "i int, t string"), "i", "t").collect()), key=repr)

    def plain(t):
        if not t:
            return 0.0
        shares = [t.count(c) / len(t) for c in set(t)]
        return round(-sum(p * math.log2(p) for p in shares) + 0.0, 9)

    assert found == sorted(((i, plain(t), None if t is None else len(t)) for i, t in rows), key=repr)


def test_letters_of_short_texts_are_counted_in_one_pass(spark):
    rows = [("a", "abab"), ("b", None), ("c", ""), ("d", "xxxx"), ("e", "\U0001f600\U0001f600\U00010000z"), (None, "\n\n\r\r")]
    found = entropy_by_row(spark.createDataFrame(rows, "k string, t string"), "k", "t")
    # a search of the whole text for each of its letters would be in the expressions of a short row
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan
    assert {r.k: (r.entropy, r.n_chars) for r in found.collect()} == {"a": (1.0, 4), "b": (0.0, None), "c": (0.0, 0), "d": (0.0, 4), "e": (1.5, 4), None: (1.0, 4)}


def test_numbered_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    numbered = ordering.with_line_numbers(spark.range(1, 1001, 1, 4).mapInArrow(rows, "id long"), ["id"])
    assert [(r.id, r.line_number) for r in numbered.orderBy("id").collect()] == [(i, i) for i in range(1, 1001)]
    assert made.value == 1000
