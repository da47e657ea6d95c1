"""Queries that write views of the tables to the shared folder and read them back through the readers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidewatch.operators import event_checks, feature_checks, features, preparation, reports, training
from tidewatch.plans import inputs, logs, models
from tidewatch.plans import features as matrices
from tidewatch.plans.inputs import AS_OF, NOISY_SQL, TELEMETRY_SQL, features_sql, round6, sql6
from tidewatch.session import materialize, shared_dir
from tidewatch.sources import features as feature_files
from tidewatch.sources import landing
from tidewatch.sources import logs as log_files
from tidewatch.sources import reports as report_files
from tidewatch.sources import telemetry as telemetry_files

_EVENT = ["event_id", "timestamp", "source_ip", "target_ip", "action", "status", "log_type", "original_line"]


def _folder(spark, tag):
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def _lines(spark, sf):
    """Lines of every event, and a folder that holds them."""
    folder = _folder(spark, "lines")
    text = F.concat_ws("|", "event_id", "event_type", "user_id")
    inputs.events(spark, sf).select(text.alias("value")).write.text(folder)
    return folder


def line_files(spark, sf):
    """Lines with their numbers: each file must count from 1 to its length."""
    read = materialize(log_files.read_logs(spark, _lines(spark, sf), numbered=True), "read")
    sizes = read.groupBy("file").agg(F.count("*").alias("n"), F.count_distinct("line_number").alias("d"), F.max("line_number").alias("last"))
    right = (F.col("n") == F.col("d")) & (F.col("n") == F.col("last")) & (F.col("line_number") >= 1)
    return read.join(sizes, "file").select("value", right.alias("numbered"))


def line_fingerprints(spark, sf):
    """The fingerprints of the files add up to that of the table."""
    files = log_files.file_fingerprints(spark, _lines(spark, sf)).agg(F.sum("n_lines").alias("n_lines"), F.sum("fingerprint").alias("f"))
    text = F.concat_ws("|", "event_id", "event_type", "user_id")
    whole = inputs.events(spark, sf).agg(F.sum(F.xxhash64(text).cast("decimal(38,0)")).alias("g"))
    return files.crossJoin(whole).select("n_lines", (F.col("f") == F.col("g")).alias("same"))


def event_files(spark, sf):
    """Records and malformed lines of JSON lines, nulls written out."""
    events = inputs.noisy_events(spark, sf).select("line_number", *_EVENT)
    folder = _folder(spark, "events")
    log_files.write_jsonl(events.drop("line_number").where("line_number % 50 <> 0"), folder)
    events.where("line_number % 50 = 0").select(F.concat(F.lit("{broken "), F.col("line_number").cast("string"))).write.mode("append").text(folder)
    good, bad = log_files.read_events_jsonl(spark, folder, ", ".join(f"`{c}` string" for c in _EVENT))
    return good.select(*_EVENT, F.lit(None).cast("string").alias("broken")).unionByName(
        bad.select(*[F.lit(None).cast("string").alias(c) for c in _EVENT], F.col("line").alias("broken"))
    )


def _telemetry_folder(spark, sf):
    rows = inputs.telemetry(spark, sf).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    timed = rows.withColumn("timestamp", F.when(F.coalesce(F.col("bytes"), F.lit(1)) % 7 == 0, "soon").otherwise(F.col("timestamp")))
    folder = _folder(spark, "telemetry")
    timed.write.json(folder)
    inputs.events(spark, sf).where("event_id % 40 = 0").select(F.lit('{"timestamp": ')).write.mode("append").text(folder)
    return folder


def telemetry_files_counts(spark, sf):
    return telemetry_files.telemetry_counts(telemetry_files.read_telemetry(spark, _telemetry_folder(spark, sf)))


def landed_telemetry(spark, sf):
    """The counts of telemetry files, taken while their rows are written, and the rows that were written."""
    folder = _folder(spark, "landed")
    counts = landing.land_telemetry(spark, _telemetry_folder(spark, sf), folder)
    return counts.crossJoin(spark.read.parquet(folder).agg(F.count("*").alias("n_rows")))


def telemetry_files_rows(spark, sf):
    """Typed rows read back, by hour and kind."""
    rows = telemetry_files.load_telemetry(spark, _telemetry_folder(spark, sf))
    return rows.groupBy(F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.count("source_ip").alias("n_source"), F.max("port").alias("port")
    )


def feature_files_rows(spark, sf):
    """A matrix written as CSV and JSON by hour, with its metadata, and read back."""
    matrix = materialize(matrices._matrix(spark, sf, "user-hour"), "matrix")
    base = _folder(spark, "features")
    feature_files.write_features(matrix, f"{base}/csv", f"{base}/json", f"{base}/meta")
    again = spark.read.schema(matrix.schema).json(f"{base}/json")
    meta = spark.read.json(f"{base}/meta").select("record_count", F.size("features").alias("n_features"))
    inside = [f for f in matrix.schema.fields if f.name != "hour"]
    lines = feature_files.read_feature_csv(spark, f"{base}/csv", type(matrix.schema)(inside))
    same = lines.select("window_id", F.col("bytes_transferred").alias("_b"), F.col("privacy_risk").alias("_p"))
    joined = again.join(same, "window_id").crossJoin(meta)
    equal = (F.col("_b") == F.col("bytes_transferred")) & F.col("_p").eqNullSafe(F.col("privacy_risk"))
    return joined.select("window_id", "hour", "login_failure_count", "bytes_transferred", "privacy_risk", equal.alias("csv_agrees"), "record_count", "n_features")


def _ordered(spark, folder, column):
    """Whether the numbers of a column rise through the files and their lines."""
    rows = log_files.read_logs(spark, f"{folder}/part-*", numbered=True).where("line_number > 1")
    return rows.withColumn("_n", F.regexp_extract("value", column, 1).cast("bigint")).groupBy("file").agg(F.min("_n").alias("low"), F.max("_n").alias("high"))


def event_issue_files(spark, sf):
    """The findings as a CSV in line order."""
    folder = _folder(spark, "issues")
    report_files.write_event_issues(logs._noisy_issues(spark, sf)[1], folder)
    return spark.read.csv(folder, header=True, escape='"', multiLine=True).select("line_number", "check_type", "severity", "description", "recommended_action")


def event_issue_order(spark, sf):
    """Files of the CSV whose lines overlap with those of the file after them: none."""
    folder = _folder(spark, "issues")
    report_files.write_event_issues(logs._noisy_issues(spark, sf)[1], folder)
    from pyspark.sql import Window

    spans = _ordered(spark, folder, r"^(\d+),")
    after = F.lead("low").over(Window.orderBy("file"))  # a row a file
    return spans.withColumn("_next", after).agg(F.count_if(F.col("_next") < F.col("high")).alias("n_overlaps"))


def matrix_issue_files(spark, sf):
    folder = _folder(spark, "issues")
    report_files.write_feature_issues(feature_checks.run_feature_checks(inputs.faulty_matrix(spark, sf)), folder)
    return spark.read.csv(folder, header=True, escape='"', multiLine=True).select("line_number", "check_type", "severity", "description", "recommended_action")


def event_summary_file(spark, sf):
    noisy, issues = logs._noisy_issues(spark, sf)
    issues = materialize(issues, "issues")
    folder = _folder(spark, "summary")
    report_files.write_summary(reports.json_summary(noisy, issues, [(n, g) for n, g, _ in event_checks.CHECKS]), folder)
    read = spark.read.json(folder)
    return read.select("total_records", "valid_records", "error_count", "warning_count", "info_count", F.col("by_check.`IP Validation`.errors").alias("ip_errors"))


def matrix_summary_file(spark, sf):
    matrix = inputs.faulty_matrix(spark, sf)
    issues = materialize(feature_checks.run_feature_checks(matrix), "issues")
    folder = _folder(spark, "summary")
    report_files.write_summary(feature_checks.json_summary(matrix, issues), folder)
    read = spark.read.json(folder)
    return read.select(
        "total_records", "valid_records", "error_count", "warning_count", F.col("by_check.duplicate_check").alias("duplicates"),
        round6("null_summary.failure_ratio").alias("null_failure_ratio"),
    )


def matrix_schema_faults(spark, sf):
    """A column that is missing and one of a wrong type."""
    faulty = inputs.faulty_matrix(spark, sf).drop("surprise").withColumn("peer_deviation", F.lit(0.0))
    faulty = faulty.drop("hour").withColumn("domain_length", F.col("domain_length").cast("string"))
    return feature_checks.check_schema(faulty).select("check_type", "severity", "description", "recommended_action")


def feature_statistics(spark, sf):
    found = features.feature_statistics(matrices._matrix(spark, sf, "user-hour"))
    return found.select("feature", "n", *[round6(c).alias(c) for c in ("mean", "std", "min", "max")])


def prepared_chain(spark, sf):
    """Prepare, train, save, load: the loaded chain scores the raw rows as the one in memory does."""
    table = models._training_table(spark, sf)
    x = models._COLUMNS
    raw = table.withColumn("f0", F.when(F.col("vec_id") % 9 != 0, F.col("f0")))
    split = materialize(models.sampling.stratified_split(raw, "y", ["vec_id"]), "split")
    prepared = preparation.prepare(split.where("split = 'train'"), x, "y", k=8)
    train = preparation.apply(prepared, split.where("split = 'train'"))
    fitted = {"random_forest": training.base_model("random_forest", 8, 2, "y").setNumTrees(5).fit(train)}
    folder = _folder(spark, "models")
    training.save_models(spark, fitted, prepared.selected, "random_forest", folder, prepared, split.where("split = 'test'"))
    loaded, best, names = training.load_models(spark, folder)
    again, test = training.load_preparation(spark, folder)
    here = training.score_batch(fitted["random_forest"], preparation.apply(prepared, test))
    there = training.score_batch(loaded[best], preparation.apply(again, test).drop("features"))
    both = here.select("vec_id", "y", "score").join(there.select("vec_id", F.col("score").alias("again")), "vec_id")
    return both.groupBy("y").agg(
        F.count("*").alias("n"), F.count_if(F.col("score") == F.col("again")).alias("n_equal"), F.lit(len(names)).alias("n_features"),
        F.lit(again == prepared).alias("same_preparation"),
    )


def training_tables(spark, sf):
    """The log of a search and the comparison of its models, written and read back."""
    table = models._model_tables(spark, sf)
    folded = models.sampling.stratified_folds(table.where("split = 'train'"), "y", ["vec_id"], 2)
    spaces = {"random_forest": {"numTrees": [5], "maxDepth": [3]}}
    results = training.train_models(folded, table.where("split = 'val'"), "y", models._COLUMNS, spaces=spaces, folds={"random_forest": 2})
    folder = _folder(spark, "tables")
    compared = training.compare_models({n: r["model"] for n, r in results.items()}, table.where("split = 'test'"), "y")
    training.write_tables(training.training_log(table, results), compared, folder)
    log, comparison = (spark.read.csv(f"{folder}/{name}", header=True, escape='"') for name in ("training_log", "model_comparison"))
    return log.select(F.col("model").alias("trained"), "best_params").crossJoin(comparison.select("model", F.col("accuracy").cast("double").between(0, 1).alias("in_range")))


QUERIES = {
    f.__name__: f
    for f in (
        line_files, line_fingerprints, event_files, telemetry_files_counts, landed_telemetry, telemetry_files_rows, feature_files_rows, event_issue_files,
        event_issue_order, matrix_issue_files, event_summary_file, matrix_summary_file, matrix_schema_faults, feature_statistics, prepared_chain,
        training_tables,
    )
}

_TELEMETRY = f"""WITH {TELEMETRY_SQL}, shown AS (SELECT *, coalesce(bytes, 1) % 7 <> 0 AS timed FROM telemetry)"""
_BROKEN = "(SELECT count(*) FROM events WHERE event_id % 40 = 0)"
_NUMERIC = [c for c in features.FEATURE_COLUMNS if c in feature_checks.REQUIRED and c not in feature_checks.NOT_NUMERIC]
_TEST = f"({models._TEST_SQL})"

ORACLES = {
    "line_files": "SELECT event_id || '|' || event_type || '|' || user_id AS value, true AS numbered FROM events",
    "line_fingerprints": "SELECT count(*) AS n_lines, true AS same FROM events",
    "event_files": f"""WITH {NOISY_SQL}
        SELECT {", ".join(_EVENT)}, CAST(NULL AS VARCHAR) AS broken FROM noisy WHERE line_number % 50 <> 0
        UNION ALL SELECT {", ".join("NULL" for _ in _EVENT)}, '{{broken ' || line_number FROM noisy WHERE line_number % 50 = 0""",
    "telemetry_files_counts": f"""{_TELEMETRY} SELECT count(*) + {_BROKEN} AS n_lines, {_BROKEN} AS n_malformed,
        count(*) FILTER (NOT timed) AS n_no_time, count(*) FILTER (timed) AS n_kept FROM shown""",
    "landed_telemetry": f"""{_TELEMETRY} SELECT count(*) + {_BROKEN} AS n_lines, {_BROKEN} AS n_malformed,
        count(*) FILTER (NOT timed) AS n_no_time, count(*) FILTER (timed) AS n_kept, count(*) FILTER (timed) AS n_rows FROM shown""",
    "telemetry_files_rows": f"""{_TELEMETRY} SELECT strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS n,
        CAST(sum(bytes) AS BIGINT) AS bytes, count(source_ip) AS n_source, max(port) AS port FROM shown WHERE timed GROUP BY hour_bucket, event_type""",
    "feature_files_rows": f"""WITH {features_sql('user-hour')} SELECT window_id, hour, login_failure_count, bytes_transferred, privacy_risk,
        true AS csv_agrees, (SELECT count(*) FROM features) AS record_count, {len(features.FEATURE_COLUMNS) - len(features.KEY_COLUMNS)} AS n_features FROM features""",
    "event_issue_files": f"""WITH {logs._ISSUES_CTE}, {logs._ADVISED}
        SELECT CAST(line_number AS VARCHAR) AS line_number, check_type, severity, description, recommended_action FROM advised""",
    "event_issue_order": "SELECT 0 AS n_overlaps",
    "matrix_issue_files": f"{matrices._MATRIX_ISSUES} SELECT line_number, check_type, severity, description, recommended_action FROM issues",
    "event_summary_file": f"""WITH {logs._ISSUES_CTE} SELECT (SELECT count(*) FROM noisy) AS total_records,
        (SELECT count(*) FROM noisy) - count(DISTINCT line_number) FILTER (severity = 'ERROR') AS valid_records,
        count(*) FILTER (severity = 'ERROR') AS error_count, count(*) FILTER (severity = 'WARNING') AS warning_count, count(*) FILTER (severity = 'INFO') AS info_count,
        count(*) FILTER (severity = 'ERROR' AND check_no = 2) AS ip_errors FROM issues""",
    "matrix_summary_file": f"""{matrices._MATRIX_ISSUES}, twice AS (SELECT line_number, count(*) OVER (PARTITION BY window_id, entity_id) AS n FROM matrix),
        bad AS (SELECT CAST(line_number AS BIGINT) AS line_number FROM issues WHERE severity = 'ERROR' AND line_number IS NOT NULL
          UNION SELECT line_number FROM twice WHERE n > 1)
        SELECT (SELECT count(*) FROM matrix) AS total_records, (SELECT count(*) FROM matrix) - (SELECT count(*) FROM bad) AS valid_records,
          count(*) FILTER (severity = 'ERROR') AS error_count, count(*) FILTER (severity = 'WARNING') AS warning_count,
          count(*) FILTER (check_no = 4) AS duplicates, (SELECT {sql6('avg(CAST(failure_ratio IS NULL AS INT))')} FROM matrix) AS null_failure_ratio FROM issues""",
    "matrix_schema_faults": f"""SELECT 'schema' AS check_type, 'ERROR' AS severity, 'Required column ''hour'' is missing from the input file.' AS description,
          '{matrices._ADVICE["missing"]}' AS recommended_action
        UNION ALL SELECT 'schema', 'ERROR', 'Column ''domain_length'' expected to be numeric but has type string.', '{matrices._ADVICE["type"]}'
        UNION ALL SELECT 'schema', 'ERROR', 'Column ''is_business_hours'' contains non-boolean values.', '{matrices._ADVICE["boolean"]}'
          FROM events WHERE event_id % 401 = 0 HAVING count(*) > 0""",
    "feature_statistics": f"WITH {features_sql('user-hour')} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, {sql6(f'avg({c})')} AS mean, {sql6(f'stddev_samp({c})')} AS std, {sql6(f'min({c})')} AS min, {sql6(f'max({c})')} AS max
        FROM features""" for c in _NUMERIC
    ),
    "prepared_chain": f"SELECT y, n, n AS n_equal, 8 AS n_features, true AS same_preparation FROM {_TEST}",
    "training_tables": """SELECT 'random_forest' AS trained, '{"maxDepth": 3, "numTrees": 5}' AS best_params, 'Random Forest' AS model, true AS in_range""",
}
