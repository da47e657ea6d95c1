import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift, feature_checks
from tidewatch.operators.feature_checks import REQUIRED, run_feature_checks


def matrix(spark, n=40, **changes):
    """A clean matrix; ``changes`` maps columns to SQL expressions over the row number ``i``."""
    base = {
        "window_id": "concat('w', i)", "entity_id": "concat('e', i)", "hour": "'2026-07-20_09'", "hour_of_day": "9",
        "login_success_count": "i % 3", "login_failure_count": "i % 4", "unique_source_ips": "1 + i % 2",
        "failure_ratio": "(i % 4) / 4.0D", "success_rate": "0.5D", "time_since_last_login_min": "i * 1.5D",
        "is_business_hours": "true", "dns_query_entropy": "0.0D", "domain_length": "0.0D",
        "bytes_transferred": "i * 2.0D", "unique_dest_ports": "i % 5", "peer_deviation": "(i % 7 - 3) / 2.0D",
    }
    columns = {**base, **changes}
    return spark.range(n).withColumnRenamed("id", "i").selectExpr(
        "i + 2 AS line_number", *[f"{e} AS {c}" for c, e in columns.items() if e is not None]
    )


def found(df, **kw):
    return [(r.line_numbers, r.check_type, r.severity, r.description) for r in run_feature_checks(df, **kw).orderBy("check_no", "seq", "line_numbers").collect()]


def test_clean(spark):
    assert found(matrix(spark)) == []


@pytest.mark.parametrize(
    "changes, finding",
    [
        ({"hour": None}, (None, "schema", "ERROR", "Required column 'hour' is missing from the input file.")),
        ({"extra": "1"}, (None, "schema", "WARNING", "Unexpected column present: 'extra'.")),
        ({"hour_of_day": "'x'"}, (None, "schema", "ERROR", "Column 'hour_of_day' expected to be numeric but has type string.")),
        ({"is_business_hours": "if(i = 3, 'perhaps', 'true')"}, (None, "schema", "ERROR", "Column 'is_business_hours' contains non-boolean values.")),
        ({"success_rate": "if(i < 8, null, 0.5D)"}, (None, "null_check", "WARNING", "Column 'success_rate' has 20.0% missing values (threshold: 5%).")),
        ({"unique_dest_ports": "if(i = 5, -2, 1)"}, ([7], "range_check", "ERROR", "Column 'unique_dest_ports' has a negative value (-2) at row 7.")),
        ({"failure_ratio": "if(i = 5, 1.5D, 0.5D)"}, ([7], "range_check", "ERROR", "Column 'failure_ratio' has an out-of-range value (1.5) at row 7; expected 0-1.")),
        ({"bytes_transferred": "if(i = 39, 900.0D, 1.0D)"}, ([41], "range_check", "WARNING", "Column 'bytes_transferred' has an extreme outlier (900.00, z=6.2) at row 41.")),
        ({"window_id": "if(i in (1, 4), 'w', concat('w', i))", "entity_id": "'e'"},
         ([3], "duplicate_check", "ERROR", "Duplicate (window_id, entity_id) pair found at 2 lines, the first 3: window_id='w', entity_id='e'.")),
    ],
)
def test_single_findings(spark, changes, finding):
    assert finding in found(matrix(spark, **changes))


def test_extra_columns_of_the_matrix_are_expected(spark):
    assert found(matrix(spark, entity_label="'x'", privacy_risk="'LOW'", bytes_transferred_rolling_4h="1.0D")) == []


def test_a_large_duplicate_group_is_one_finding(spark):
    df = matrix(spark, 36000, window_id="if(i % 3 = 0, 'hot', concat('w', i))", entity_id="'e'")
    findings = feature_checks.check_duplicates(df).collect()
    assert [(r.line_numbers, r.seq) for r in findings] == [([2], 0)] and " 12000 lines" in findings[0].description
    lines = feature_checks.duplicate_lines(df)
    assert lines.count() == lines.select("line_number").distinct().count() == 12000
    assert feature_checks.valid_records(df, feature_checks.check_duplicates(df)).count() == 24000


def test_summary_counts_each_line_once(spark):
    df = matrix(spark, unique_dest_ports="if(i = 5, -2, 1)", failure_ratio="if(i = 5, 1.5D, 0.5D)")
    s = feature_checks.json_summary(df, run_feature_checks(df)).first()
    # both cells are also outliers
    assert (s.total_records, s.valid_records, s.error_count, s.warning_count) == (40, 39, 2, 2)
    assert s.by_check["range_check"] == 4
    assert set(s.null_summary) == set(REQUIRED)


def ks_by_hand(a, b):
    values = np.unique(np.concatenate([a, b]))
    return max(abs((a <= v).mean() - (b <= v).mean()) for v in values)


def test_ks_and_shift(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.normal(size=300), 2), np.round(rng.normal(0.4, 1, size=200), 2)
    one, two = (spark.createDataFrame([(float(v),) for v in x], "failure_ratio double") for x in (a, b))
    r = drift.drift_report(one, two).first()
    assert abs(r.ks_statistic - ks_by_hand(a, b)) < 1e-12 and (r.n_cur, r.n_ref) == (300, 200)
    assert abs(r.mean_shift_pct - (a.mean() - b.mean()) / abs(b.mean()) * 100) < 1e-9


def test_exact_tail_counts_all_orders():
    for n, m in ((3, 3), (4, 2), (5, 3)):
        sizes = []
        for spots in itertools.combinations(range(n + m), n):
            i = j = best = 0
            for s in range(n + m):
                i, j = (i + 1, j) if s in spots else (i, j + 1)
                best = max(best, abs(i * m - j * n))
            sizes.append(best)
        for reach in sorted(set(sizes)):
            assert abs(drift.ks_tail(reach / (n * m), n, m) - sum(s >= reach for s in sizes) / len(sizes)) < 1e-12


def test_tails_agree(spark):
    # fixed values: two samples of 30
    for d, p in ((0.26666666666666666, 0.23907300248018645), (0.13333333333333333, 0.9578462903438838), (1 / 3, 0.070888)):
        assert abs(drift.ks_tail(d, 30, 30) - p) < 1e-6
    for d in (0.005, 0.01, 0.02, 0.03):
        limit = spark.range(1).select(drift._limit_p_value(*(F.lit(x) for x in (d, 9000, 7000))).alias("p")).first().p
        assert abs(drift._exact_tail(d, 9000, 7000) - limit) < 2e-3
    assert spark.range(1).select(drift._limit_p_value(*(F.lit(x) for x in (0.5, 200000, 300000))).alias("p")).first().p < 1e-12


def test_the_law_does_not_follow_the_size(spark):
    one, two = (spark.range(30).selectExpr(f"id * {k} AS failure_ratio") for k in (1, 2))
    by_limit, exact = (drift.drift_report(one, two, method=m).first().p_value for m in ("limit", "exact"))
    assert abs(exact - drift._exact_tail(0.5, 30, 30)) < 1e-12 and 1e-6 < abs(by_limit - exact) < 0.02
    with pytest.raises(ValueError):
        drift.drift_report(one, two, method="other")


def test_drift_findings(spark):
    now = matrix(spark, 200, login_failure_count="(i % 4) * 3", failure_ratio="(i % 8) / 8.0D")
    texts = [f[3] for f in found(now, reference=matrix(spark, 200)) if f[1] == "drift_check"]
    assert any(t.startswith("'login_failure_count': KS=") for t in texts)
    assert "'login_failure_count': mean shifted +200% vs. reference." in texts
    assert any(t.startswith("Concept drift: correlation between 'login_failure_count' and 'failure_ratio' changed from 1.00") for t in texts)


def test_constant_columns_have_no_correlation(spark):
    flat = matrix(spark, bytes_transferred="1.0D")
    pairs = {(r.feature_a, r.feature_b) for r in drift.concept_drift(flat, matrix(spark)).collect()}
    assert ("bytes_transferred", "unique_dest_ports") not in pairs and len(pairs) == 2
