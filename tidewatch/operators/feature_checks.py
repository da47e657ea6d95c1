"""Schema, null, range, duplicate and drift checks on a feature matrix.

Findings are rows: ``line_numbers, check_no, seq, check_group, check_type, severity, description,
recommended_action``; ``line_numbers`` is null for findings on the whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import reports
from tidewatch.operators.drift import (
    CORRELATION_SHIFT, DRIFT_FEATURES, MEAN_SHIFT_PCT, concept_drift, drift_report,
)

# Columns, limits and texts of the findings.
REQUIRED = [
    "window_id", "entity_id", "hour", "hour_of_day", "login_success_count", "login_failure_count",
    "unique_source_ips", "failure_ratio", "success_rate", "time_since_last_login_min",
    "is_business_hours", "dns_query_entropy", "domain_length", "bytes_transferred",
    "unique_dest_ports", "peer_deviation",
]
NOT_NUMERIC = ["window_id", "entity_id", "hour", "is_business_hours"]
EXTRA = ["entity_label", "privacy_risk"]
EXTRA_PREFIXES = (
    "login_failure_count_rolling_", "login_success_count_rolling_", "bytes_transferred_rolling_",
)
NON_NEGATIVE = [
    "login_success_count", "login_failure_count", "unique_source_ips", "dns_query_entropy",
    "domain_length", "bytes_transferred", "unique_dest_ports",
]
RATIOS = ["failure_ratio", "success_rate"]
MAX_Z = 5
CHECKS = [(1, "schema"), (2, "null_check"), (3, "range_check"), (4, "duplicate_check"), (5, "drift_check")]
ADVICE = {
    "missing": "Re-run the feature extraction or check for a truncated export; this column is required for "
    "downstream checks.",
    "unexpected": "Remove '{col}' from the pipeline output if it is not an intentional addition, or add it to "
    "the validator's allowed list.",
    "type": "Check the extractor for a serialization issue (e.g. a stray string value written into a numeric "
    "column).",
    "boolean": "Confirm the extractor writes a strict boolean for this column.",
    "null": "Investigate the source of missing '{col}' values; consider imputing with 0 (count-style features) "
    "or the column mean (continuous features) if missingness is expected.",
    "negative": "Counts/sums should never be negative; check the extractor for a subtraction or sign error "
    "upstream.",
    "ratio": "'{col}' is a ratio and must stay within [0, 1]; check the denominator calculation for a "
    "divide-by-zero or logic error.",
    "outlier": "Confirm this is a real event (e.g. a genuine large data transfer) rather than a parsing error "
    "before alerting on it.",
    "duplicate": "Investigate the upstream pipeline for double-processing of the same events (e.g. a re-run "
    "that appended instead of overwrote).",
    "ks": "Investigate whether this reflects a real behavior change (e.g. an attack campaign) or an upstream "
    "data issue; consider retraining any model that depends on this feature if the drift persists.",
    "mean": "Compare against known events (deployment changes, incidents) for the same period; a large shift "
    "concentrated in one feature can indicate a real security event rather than drift noise.",
    "concept": "A changing relationship between two features (rather than a shift in either one alone) can mean "
    "the underlying attack pattern or user behavior has changed; review before trusting a model trained on the "
    "old relationship.",
}
_ISSUE = T.StructType(
    [
        T.StructField("line_numbers", T.ArrayType(T.LongType())),
        T.StructField("check_no", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("check_group", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
    ]
)


def is_allowed_column(name: str) -> bool:
    return name in REQUIRED or name in EXTRA or name.startswith(EXTRA_PREFIXES)


def _finding(check_no: int, seq: int, severity: str, text: Column, advice: str, lines: Column | None = None) -> Column:
    name = CHECKS[check_no - 1][1]
    lines = F.lit(None) if lines is None else lines
    return F.struct(
        lines.cast("array<bigint>").alias("line_numbers"),
        F.lit(check_no).alias("check_no"),
        F.lit(seq).alias("seq"),
        F.lit(name).alias("check_group"),
        F.lit(name).alias("check_type"),
        F.lit(severity).alias("severity"),
        text.alias("description"),
        F.lit(advice).alias("recommended_action"),
    )


def _expand(df: DataFrame, rules: list[Column]) -> DataFrame:
    found = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return df.select(F.inline(found))


def check_schema(df: DataFrame, line: str = "line_number") -> DataFrame:
    columns = [c for c in df.columns if c != line]
    rows, seq = [], 0

    def add(severity, text, advice):
        nonlocal seq
        seq += 1
        rows.append((None, 1, seq, "schema", "schema", severity, text, advice))

    for col in REQUIRED:
        if col not in columns:
            add("ERROR", f"Required column '{col}' is missing from the input file.", ADVICE["missing"])
    for col in columns:
        if not is_allowed_column(col):
            add("WARNING", f"Unexpected column present: '{col}'.", ADVICE["unexpected"].format(col=col))
    for col in REQUIRED:
        if col in columns and col not in NOT_NUMERIC and not isinstance(df.schema[col].dataType, T.NumericType):
            kind = df.schema[col].dataType.simpleString()
            add("ERROR", f"Column '{col}' expected to be numeric but has type {kind}.", ADVICE["type"])
    static = df.sparkSession.createDataFrame(rows, _ISSUE)
    if "is_business_hours" not in columns:
        return static
    flag = F.lower(F.col("is_business_hours").cast("string"))
    odd = df.agg(F.count_if(~F.coalesce(flag.isin("true", "false", "0", "1", "0.0", "1.0"), F.lit(False))).alias("n"))
    issue = _finding(
        1, seq + 1, "ERROR", F.lit("Column 'is_business_hours' contains non-boolean values."), ADVICE["boolean"]
    )
    return static.unionByName(odd.where("n > 0").select(F.inline(F.array(issue))))


def null_rates(df: DataFrame) -> DataFrame:
    """Rows of (column, null_rate) for the required columns, from one pass."""
    present = [c for c in REQUIRED if c in df.columns]
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in present])
    return rates.unpivot([], present, "column", "null_rate")


def check_nulls(df: DataFrame, threshold: float = 0.05) -> DataFrame:
    present = [c for c in REQUIRED if c in df.columns]
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in present])
    rules = [
        F.when(
            F.col(c) > threshold,
            _finding(
                2, i, "WARNING",
                F.format_string(f"Column '{c}' has %.1f%% missing values (threshold: {threshold:.0%}%).", F.col(c) * 100),
                ADVICE["null"].format(col=c),
            ),
        )
        for i, c in enumerate(present)
    ]
    return _expand(rates, rules)


def check_ranges(df: DataFrame, line: str = "line_number") -> DataFrame:
    """Negative counts, ratios outside 0 to 1 and outliers, one finding per cell.

    One pass for the moments, one narrow pass for the findings.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    measured = [c for c in DRIFT_FEATURES if c in numeric]
    moments = df.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in measured]
        ).alias("m")
    )
    lines = F.array(line)
    rules: list[Column] = []

    def add(broken, severity, text, advice):
        rules.append(F.when(broken, _finding(3, len(rules), severity, text, advice, lines)))

    row = F.col(line).cast("string")
    for c in [c for c in NON_NEGATIVE if c in numeric]:
        text = F.concat(
            F.lit(f"Column '{c}' has a negative value ("), F.col(c).cast("string"), F.lit(") at row "), row, F.lit(".")
        )
        add(F.col(c) < 0, "ERROR", text, ADVICE["negative"])
    for c in [c for c in RATIOS if c in numeric]:
        text = F.concat(
            F.lit(f"Column '{c}' has an out-of-range value ("), F.col(c).cast("string"),
            F.lit(") at row "), row, F.lit("; expected 0-1."),
        )
        add((F.col(c) < 0) | (F.col(c) > 1), "ERROR", text, ADVICE["ratio"].format(col=c))
    work = df
    if measured:
        work = df.withColumn("_m", moments.scalar())
    for c in measured:
        std = F.col(f"_m.{c}.std")
        z = F.when(std > 0, (F.col(c) - F.col(f"_m.{c}.mean")) / std)
        text = F.format_string(
            f"Column '{c}' has an extreme outlier (%.2f, z=%.1f) at row %d.", F.col(c).cast("double"), z, F.col(line)
        )
        add(F.abs(z) > MAX_Z, "WARNING", text, ADVICE["outlier"])
    return _expand(work, rules)


def _duplicate_keys(df: DataFrame, line: str) -> DataFrame:
    """Rows of (window_id, entity_id, n, first_line) for keys that occur more than once."""
    return df.groupBy("window_id", "entity_id").agg(F.count("*").alias("n"), F.min(line).alias("first_line")).where("n > 1")


def duplicate_lines(df: DataFrame, line: str = "line_number") -> DataFrame:
    """Rows of (window_id, entity_id, n, line) for every line of a key that occurs more than once."""
    keys = ["window_id", "entity_id"]
    same = F.expr(" AND ".join(f"r.{k} <=> s.{k}" for k in keys))
    found = df.select(*keys, line).alias("r").join(_duplicate_keys(df, line).alias("s"), same)
    return found.select(*[F.col(f"r.{k}").alias(k) for k in keys], "n", line)


def check_duplicates(df: DataFrame, line: str = "line_number") -> DataFrame:
    """One finding per key, at its first line; ``duplicate_lines`` has all of them."""
    if not {"window_id", "entity_id"} <= set(df.columns):
        return df.sparkSession.createDataFrame([], _ISSUE)
    text = F.concat(
        F.lit("Duplicate (window_id, entity_id) pair found at "), F.col("n").cast("string"), F.lit(" lines, the first "),
        F.col("first_line").cast("string"), F.lit(": window_id='"), F.coalesce("window_id", F.lit("")),
        F.lit("', entity_id='"), F.coalesce("entity_id", F.lit("")), F.lit("'."),
    )
    issue = _finding(4, 0, "ERROR", text, ADVICE["duplicate"], F.array("first_line"))
    return _duplicate_keys(df, line).select(F.inline(F.array(issue)))


def check_drift(df: DataFrame, reference: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    names = [f for f in DRIFT_FEATURES if f in df.columns and f in reference.columns]
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("feature")).cast("int") * 2
    ks = F.format_string(
        "'%s': KS=%.2f, p=%.3f (significant distribution drift vs. reference).",
        "feature", "ks_statistic", "p_value",
    )
    mean = F.format_string("'%s': mean shifted %+.0f%% vs. reference.", "feature", "mean_shift_pct")
    details = drift_report(df, reference, names)
    rules = [
        F.when(F.col("p_value") < p_threshold, _finding(5, 0, "WARNING", ks, ADVICE["ks"]).withField("seq", position)),
        F.when(
            F.abs("mean_shift_pct") > MEAN_SHIFT_PCT,
            _finding(5, 0, "WARNING", mean, ADVICE["mean"]).withField("seq", position + 1),
        ),
    ]
    concept = F.format_string(
        "Concept drift: correlation between '%s' and '%s' changed from %.2f (reference) to %.2f (current), "
        "a shift of %+.2f.",
        "feature_a", "feature_b", "ref_corr", "cur_corr", "delta",
    )
    last = 2 * len(DRIFT_FEATURES) + 2
    shifted = [
        F.when(F.abs("delta") > CORRELATION_SHIFT, _finding(5, last, "WARNING", concept, ADVICE["concept"]))
    ]
    return _expand(details, rules).unionByName(_expand(concept_drift(df, reference), shifted))


def run_feature_checks(
    df: DataFrame,
    reference: DataFrame | None = None,
    null_threshold: float = 0.05,
    p_threshold: float = 0.05,
    line: str = "line_number",
) -> DataFrame:
    parts = [check_schema(df, line), check_nulls(df, null_threshold), check_ranges(df, line), check_duplicates(df, line)]
    if reference is not None:
        parts.append(check_drift(df, reference, p_threshold))
    return reduce(DataFrame.unionByName, parts)


def issue_lines(issues: DataFrame) -> DataFrame:
    """One row per finding and line, for the summaries of ``reports``."""
    return issues.withColumn("line_number", F.explode_outer("line_numbers")).drop("line_numbers")


def error_lines(df: DataFrame, issues: DataFrame, line: str = "line_number") -> DataFrame:
    """The lines with errors: those of the findings, and every line of a duplicate."""
    found = issue_lines(issues).select("line_number", "severity")
    if {"window_id", "entity_id"} <= set(df.columns):
        found = found.unionByName(duplicate_lines(df, line).select(F.col(line).alias("line_number"), F.lit("ERROR").alias("severity")))
    return reports.error_lines(found)


def valid_records(df: DataFrame, issues: DataFrame, line: str = "line_number") -> DataFrame:
    bad = error_lines(df, issues, line).withColumnRenamed("line_number", "_bad")
    return df.join(bad, F.col(line) == F.col("_bad"), "left_anti")


def check_summary(issues: DataFrame) -> DataFrame:
    return reports.issues_by_check(issues, CHECKS, failed="FAIL")


def json_summary(df: DataFrame, issues: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """One row: totals, findings per check, null rates and the drift details."""
    bad = error_lines(df, issues).agg(F.count("*")).scalar()
    per_check = check_summary(issues).agg(
        F.map_from_entries(F.array_agg(F.struct("check_group", F.expr("errors + warnings + info"))))
    )
    rates = null_rates(df).agg(F.map_from_entries(F.array_agg(F.struct("column", "null_rate"))))
    total = df.agg(F.count("*")).scalar()
    row = issues.agg(
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
        F.count_if(F.col("severity") == "WARNING").alias("warning_count"),
    ).select(
        total.alias("total_records"), (total - bad).alias("valid_records"), "error_count", "warning_count",
        per_check.scalar().alias("by_check"), rates.scalar().alias("null_summary"),
    )
    if details is None:
        return row
    listed = details.agg(
        F.array_agg(F.struct("feature", "ks_statistic", "p_value", "mean_shift_pct"))
    )
    return row.withColumn("drift_details", listed.scalar())
