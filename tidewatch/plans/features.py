"""Queries on feature matrices and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import drift, feature_checks, features, moments, reports
from tidewatch.plans import inputs
from tidewatch.plans.inputs import KEY, MATRIX_SQL, features_sql, round6, sql6
from tidewatch.session import materialize
from tidewatch.sources.telemetry import normalize_telemetry

_DOUBLES = [
    "failure_ratio", "success_rate", "time_since_last_login_min", "dns_query_entropy", "domain_length",
    "bytes_transferred", "peer_deviation",
]
_SPLIT_HOUR = "2024-01-16_00"
_SPLIT_DATE = "1996-01-01"


def _matrix(spark, sf, window):
    return features.compute_features(normalize_telemetry(inputs.telemetry(spark, sf)), window, KEY, include_label=True)


def _rounded(df):
    return df.withColumns({c: round6(c) for c in df.columns if c in _DOUBLES})


def features_user_hour(spark, sf):
    return _rounded(_matrix(spark, sf, "user-hour"))


def features_host_hour(spark, sf):
    return _rounded(_matrix(spark, sf, "host-hour"))


def rolling_rows(spark, sf):
    rolled = features.apply_rolling(_matrix(spark, sf, "user-hour"), "4h")
    return rolled.select("window_id", *[f"{c}_rolling_4h" for c in features.ROLLED])


def rolling_hours(spark, sf):
    rolled = features.apply_rolling(_matrix(spark, sf, "user-hour"), "24h", mode="range")
    return rolled.select("window_id", *[f"{c}_rolling_24h" for c in features.ROLLED])


def matrix_summary(spark, sf):
    return features.matrix_summary(_matrix(spark, sf, "user-hour"))


def _halves(spark, sf):
    matrix = materialize(_matrix(spark, sf, "user-hour"), "matrix")
    return matrix.where(F.col("hour") >= _SPLIT_HOUR), matrix.where(F.col("hour") < _SPLIT_HOUR)


def drift_statistics(spark, sf):
    report = drift.drift_report(*_halves(spark, sf))
    return report.select("feature", "n_cur", "n_ref", round6("ks_statistic").alias("ks"), round6("mean_shift_pct").alias("mean_shift_pct"))


def drift_p_values(spark, sf):
    report = drift.drift_report(*_halves(spark, sf))
    return report.select("feature", round6("ks_statistic").alias("ks"), round6("p_value").alias("p_value"))


def drift_issues(spark, sf):
    current, reference = _halves(spark, sf)
    return feature_checks.check_drift(current, reference).select("check_type", "severity", "description")


def order_price_drift(spark, sf):
    """KS distance of order prices, all from a date on against all before it, on millions of distinct values at scale."""
    o = inputs.table(spark, sf, "orders").select("o_totalprice", "o_orderdate")
    later = F.col("o_orderdate") >= F.lit(_SPLIT_DATE).cast("timestamp")
    stats = drift.ks_statistics(o.where(later), o.where(~later), ["o_totalprice"])
    return stats.select("feature", "n_cur", "n_ref", round6("ks_statistic").alias("ks"), round6("mean_cur").alias("mean_cur"))


def concept_drift(spark, sf):
    found = drift.concept_drift(*_halves(spark, sf))
    return found.select("feature_a", "feature_b", *[round6(c).alias(c) for c in ("cur_corr", "ref_corr", "delta")])


def feature_correlations(spark, sf):
    pairs = moments.correlation_matrix(_matrix(spark, sf, "host-hour"), drift.DRIFT_FEATURES)
    return pairs.withColumn("correlation", round6("correlation"))


def correlation_rank(spark, sf):
    ranked = moments.correlation_rank(_matrix(spark, sf, "host-hour"), "login_failure_count", drift.DRIFT_FEATURES)
    return ranked.withColumn("abs_correlation", round6("abs_correlation"))


def matrix_issues(spark, sf):
    """Schema, null, range and duplicate findings on a matrix with faults."""
    issues = feature_checks.run_feature_checks(inputs.faulty_matrix(spark, sf))
    return issues.select(
        F.array_join("line_numbers", ",").alias("line_number"), "check_no", "check_type", "severity", "description", "recommended_action"
    )


def matrix_null_rates(spark, sf):
    return feature_checks.null_rates(inputs.faulty_matrix(spark, sf)).withColumn("null_rate", round6("null_rate"))


def matrix_duplicates(spark, sf):
    return feature_checks.duplicate_lines(inputs.faulty_matrix(spark, sf)).select("window_id", "entity_id", "n", "line_number")


def matrix_check_summary(spark, sf):
    issues = feature_checks.run_feature_checks(inputs.faulty_matrix(spark, sf))
    return feature_checks.check_summary(issues)


def matrix_valid_rows(spark, sf):
    m = inputs.faulty_matrix(spark, sf)
    return feature_checks.valid_records(m, feature_checks.run_feature_checks(m)).select("line_number", "window_id")


def matrix_recommendations(spark, sf):
    """The first five distinct recommendations in finding order."""
    issues = feature_checks.run_feature_checks(inputs.faulty_matrix(spark, sf))
    return reports.top_recommendations(issues, ["check_no", "seq"], by="recommended_action", limit=5).select("recommended_action")


QUERIES = {
    f.__name__: f
    for f in (
        features_user_hour, features_host_hour, rolling_rows, rolling_hours, matrix_summary, drift_statistics,
        drift_p_values, drift_issues, order_price_drift, concept_drift, feature_correlations, correlation_rank,
        matrix_issues, matrix_null_rates, matrix_duplicates, matrix_check_summary, matrix_valid_rows, matrix_recommendations,
    )
}

_FULL = ", ".join(
    f"{sql6(c)} AS {c}" if c in _DOUBLES else c for c in features.FEATURE_COLUMNS
)


def _rolled(n, frame, order, suffix):
    sums = ", ".join(
        f"CAST(sum({c}) OVER (PARTITION BY entity_id ORDER BY {order} {frame}) AS DOUBLE) AS {c}_rolling_{suffix}" for c in features.ROLLED
    )
    return f"WITH {features_sql('user-hour')} SELECT window_id, {sums} FROM features"


def _ks(cte, feature, value, cur, ref):
    """Rows (feature, side, value) to KS statistic by definition."""
    return f"""{cte},
    sides AS (SELECT feature, value, is_cur FROM long WHERE value IS NOT NULL),
    sizes AS (SELECT feature, count(*) FILTER (is_cur) AS n_cur, count(*) FILTER (NOT is_cur) AS n_ref,
      avg(value) FILTER (is_cur) AS mean_cur, avg(value) FILTER (NOT is_cur) AS mean_ref FROM sides GROUP BY 1),
    steps AS (SELECT feature, value, sum(CAST(is_cur AS INT)) AS c, sum(CAST(NOT is_cur AS INT)) AS r FROM sides GROUP BY 1, 2),
    cdf AS (SELECT feature, sum(c) OVER w AS cc, sum(r) OVER w AS cr FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value)),
    ks AS (SELECT feature, max(abs(cc / n_cur - cr / n_ref)) AS ks FROM cdf JOIN sizes USING (feature) GROUP BY 1)"""


_LONG = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, hour >= '{_SPLIT_HOUR}' AS is_cur FROM features" for f in drift.DRIFT_FEATURES
)
_KS_CTE = _ks(f"WITH {features_sql('user-hour')}, long AS ({_LONG})", None, None, None, None)
_ORDER_KS = _ks(
    """WITH long AS (SELECT 'o_totalprice' AS feature, o_totalprice AS value, o_orderdate >= TIMESTAMP '1996-01-01' AS is_cur
       FROM orders)""", None, None, None, None,
)


_TERMS = "list_sum(list_transform(range(1, 101), lambda k: {}))"
_P_CTE = f"""tails AS (
    SELECT feature, ks, CASE WHEN abs(mean_ref) >= 1e-9 THEN (mean_cur - mean_ref) / abs(mean_ref) * 100 END AS shift,
      round(CAST(n_cur AS DOUBLE) * n_ref / (n_cur + n_ref)) AS size FROM ks JOIN sizes USING (feature) WHERE n_cur >= 2 AND n_ref >= 2),
  placed AS (SELECT *, ks * sqrt(size) AS plain, ks * sqrt(size) + 1 / (6 * sqrt(size)) + (ks * sqrt(size) - 1) / (4 * size) AS z FROM tails),
  report AS (SELECT feature, ks, shift, greatest(0, least(1, CASE WHEN plain <= 0 THEN 1
    WHEN z < 1 THEN 1 - sqrt(2 * pi()) / z * {_TERMS.format("exp(-((2 * k - 1) * (2 * k - 1)) * pi() * pi() / (8 * z * z))")}
    ELSE 2 * {_TERMS.format("CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * z * z)")} END)) AS p FROM placed)"""


def _corr(a, b, where):
    return f"""(SELECT CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END FROM features WHERE {where})"""


_CONCEPT = " UNION ALL ".join(
    f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_corr(a, b, f"hour >= '{_SPLIT_HOUR}'")} AS cur_corr,
    {_corr(a, b, f"hour < '{_SPLIT_HOUR}'")} AS ref_corr"""
    for a, b in drift.RELATED_PAIRS
)
_CORR_ROW = ", ".join(
    f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS c{i}_{j}"
    for i, a in enumerate(drift.DRIFT_FEATURES) for j, b in enumerate(drift.DRIFT_FEATURES)
)
_CORR_LONG = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {sql6(f'c{i}_{j}')} AS correlation FROM m"
    for i, a in enumerate(drift.DRIFT_FEATURES) for j, b in enumerate(drift.DRIFT_FEATURES)
)

_ADVICE = {k: v.replace("'", "''") for k, v in feature_checks.ADVICE.items()}
_MEASURED = [c for c in drift.DRIFT_FEATURES if c != "peer_deviation"]
_NEGATIVE = " UNION ALL ".join(
    f"""SELECT CAST(line_number AS VARCHAR), 3, 'range_check', 'ERROR',
    'Column ''{c}'' has a negative value (' || CAST({c} AS VARCHAR) || ') at row ' || line_number || '.', '{_ADVICE["negative"]}', {i}
    FROM matrix WHERE {c} < 0"""
    for i, c in enumerate(feature_checks.NON_NEGATIVE)
)
_RATIO = " UNION ALL ".join(
    f"""SELECT CAST(line_number AS VARCHAR), 3, 'range_check', 'ERROR',
    'Column ''{c}'' has an out-of-range value (' || CAST(CAST({c} AS DOUBLE) AS VARCHAR) || ') at row ' || line_number || '; expected 0-1.',
    '{_ADVICE["ratio"].format(col=c)}', {len(feature_checks.NON_NEGATIVE) + i} FROM matrix WHERE {c} < 0 OR {c} > 1"""
    for i, c in enumerate(feature_checks.RATIOS)
)
_OUTLIER = " UNION ALL ".join(
    f"""SELECT CAST(line_number AS VARCHAR), 3, 'range_check', 'WARNING',
    'Column ''{c}'' has an extreme outlier (' || printf('%.2f', CAST({c} AS DOUBLE)) || ', z=' || printf('%.1f', z) || ') at row ' || line_number || '.',
    '{_ADVICE["outlier"]}', {len(feature_checks.NON_NEGATIVE) + len(feature_checks.RATIOS) + i}
    FROM (SELECT line_number, {c}, ({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS z FROM matrix) WHERE abs(z) > 5"""
    for i, c in enumerate(_MEASURED)
)
_MATRIX_ISSUES = f"""WITH {MATRIX_SQL}, issues AS (
  SELECT CAST(NULL AS VARCHAR) AS line_number, 1 AS check_no, 'schema' AS check_type, 'ERROR' AS severity,
    'Required column ''peer_deviation'' is missing from the input file.' AS description, '{_ADVICE["missing"]}' AS recommended_action, 1 AS seq
  UNION ALL SELECT NULL, 1, 'schema', 'WARNING', 'Unexpected column present: ''surprise''.', '{_ADVICE["unexpected"].format(col="surprise")}', 2
  UNION ALL SELECT NULL, 1, 'schema', 'ERROR', 'Column ''is_business_hours'' contains non-boolean values.', '{_ADVICE["boolean"]}', 3 FROM matrix WHERE is_business_hours = 'maybe' HAVING count(*) > 0
  UNION ALL SELECT NULL, 2, 'null_check', 'WARNING',
    'Column ''failure_ratio'' has ' || printf('%.1f', 100 * avg(CAST(failure_ratio IS NULL AS INT))) || '% missing values (threshold: 5%).',
    '{_ADVICE["null"].format(col="failure_ratio")}', 7 FROM matrix HAVING avg(CAST(failure_ratio IS NULL AS INT)) > 0.05
  UNION ALL {_NEGATIVE} UNION ALL {_RATIO} UNION ALL {_OUTLIER}
  UNION ALL SELECT CAST(min(line_number) AS VARCHAR), 4, 'duplicate_check', 'ERROR',
    'Duplicate (window_id, entity_id) pair found at ' || count(*) || ' lines, the first ' || min(line_number)
    || ': window_id=''' || window_id || ''', entity_id=''' || entity_id || '''.', '{_ADVICE["duplicate"]}', 0
    FROM matrix GROUP BY window_id, entity_id HAVING count(*) > 1)"""

ORACLES = {
    "features_user_hour": f"WITH {features_sql('user-hour')} SELECT {_FULL} FROM features",
    "features_host_hour": f"WITH {features_sql('host-hour')} SELECT {_FULL} FROM features",
    "rolling_rows": _rolled(4, "ROWS BETWEEN 3 PRECEDING AND CURRENT ROW", "hour", "4h"),
    "rolling_hours": _rolled(24, "RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW", "strptime(hour, '%Y-%m-%d_%H')", "24h"),
    "matrix_summary": f"WITH {features_sql('user-hour')} SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, count(DISTINCT hour) AS n_hours FROM features",
    "drift_statistics": f"""{_KS_CTE} SELECT feature, n_cur, n_ref, {sql6('ks')} AS ks,
        {sql6('CASE WHEN abs(mean_ref) >= 1e-9 THEN (mean_cur - mean_ref) / abs(mean_ref) * 100 END')} AS mean_shift_pct
        FROM ks JOIN sizes USING (feature)""",
    "drift_p_values": f"{_KS_CTE}, {_P_CTE} SELECT feature, {sql6('ks')} AS ks, {sql6('p')} AS p_value FROM report",
    "drift_issues": f"""{_KS_CTE}, {_P_CTE}, pairs AS ({_CONCEPT})
        SELECT 'drift_check' AS check_type, 'WARNING' AS severity, chr(39) || feature || chr(39) || ': KS=' || printf('%.2f', ks) || ', p='
          || printf('%.3f', p) || ' (significant distribution drift vs. reference).' AS description FROM report WHERE p < 0.05
        UNION ALL SELECT 'drift_check', 'WARNING', chr(39) || feature || chr(39) || ': mean shifted ' || printf('%+.0f', shift) || '% vs. reference.'
          FROM report WHERE abs(shift) > 30
        UNION ALL SELECT 'drift_check', 'WARNING', 'Concept drift: correlation between ' || chr(39) || feature_a || chr(39) || ' and ' || chr(39)
          || feature_b || chr(39) || ' changed from ' || printf('%.2f', ref_corr) || ' (reference) to ' || printf('%.2f', cur_corr)
          || ' (current), a shift of ' || printf('%+.2f', cur_corr - ref_corr) || '.' FROM pairs WHERE abs(cur_corr - ref_corr) > 0.3""",
    "order_price_drift": f"{_ORDER_KS} SELECT feature, n_cur, n_ref, {sql6('ks')} AS ks, {sql6('mean_cur')} AS mean_cur FROM ks JOIN sizes USING (feature)",
    "concept_drift": f"""WITH {features_sql('user-hour')}, pairs AS ({_CONCEPT})
        SELECT feature_a, feature_b, {sql6('cur_corr')} AS cur_corr, {sql6('ref_corr')} AS ref_corr, {sql6('cur_corr - ref_corr')} AS delta
        FROM pairs WHERE cur_corr - ref_corr IS NOT NULL""",
    "feature_correlations": f"WITH {features_sql('host-hour')}, m AS (SELECT {_CORR_ROW} FROM features) {_CORR_LONG}",
    "correlation_rank": f"""WITH {features_sql('host-hour')}, m AS (SELECT {_CORR_ROW} FROM features), pairs AS ({_CORR_LONG})
        SELECT feature_a AS feature, abs(correlation) AS abs_correlation FROM pairs WHERE feature_b = 'login_failure_count' AND feature_a <> feature_b""",
    "matrix_issues": f"{_MATRIX_ISSUES} SELECT * EXCLUDE (seq) FROM issues",
    "matrix_null_rates": "WITH " + MATRIX_SQL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {sql6(f'avg(CAST({c} IS NULL AS INT))')} AS null_rate FROM matrix"
        for c in feature_checks.REQUIRED if c != "peer_deviation"
    ),
    "matrix_duplicates": f"""WITH {MATRIX_SQL}, counted AS (SELECT window_id, entity_id, count(*) OVER (PARTITION BY window_id, entity_id) AS n, line_number FROM matrix)
        SELECT * FROM counted WHERE n > 1""",
    "matrix_check_summary": f"""{_MATRIX_ISSUES} SELECT c.check_no, c.name AS check_group, count(*) FILTER (severity = 'ERROR') AS errors,
        count(*) FILTER (severity = 'WARNING') AS warnings, CAST(0 AS BIGINT) AS info, count(*) FILTER (severity = 'ERROR') = 0 AS pass,
        CASE WHEN count(*) FILTER (severity = 'ERROR') > 0 THEN 'FAIL' WHEN count(*) FILTER (severity = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS verdict
        FROM (VALUES (1, 'schema'), (2, 'null_check'), (3, 'range_check'), (4, 'duplicate_check'), (5, 'drift_check')) c(check_no, name)
        LEFT JOIN issues i ON i.check_type = c.name GROUP BY 1, 2""",
    "matrix_recommendations": f"""{_MATRIX_ISSUES}
        SELECT recommended_action FROM issues GROUP BY 1 ORDER BY min(check_no * 1000 + seq) LIMIT 5""",
    "matrix_valid_rows": f"""{_MATRIX_ISSUES}, twice AS (
        SELECT line_number, count(*) OVER (PARTITION BY window_id, entity_id) AS n FROM matrix), bad AS (
        SELECT CAST(line_number AS BIGINT) AS line_number FROM issues WHERE severity = 'ERROR' AND line_number IS NOT NULL
        UNION SELECT line_number FROM twice WHERE n > 1)
        SELECT line_number, window_id FROM matrix WHERE line_number NOT IN (SELECT line_number FROM bad)""",
}
