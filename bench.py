"""Time the headline queries on the tables of $BENCH_SF_DIR and print one JSON line.

The tables are landed in as many files as there are cores first. The inference of the models is timed always; BENCH_MORE=1 adds the costly
operators, each run once, BENCH_TRAIN=1 the model search on 60,060 rows of 35 columns too.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidewatch.operators import event_checks, log_parsing, sampling, training  # noqa: E402
from tidewatch.operators.ordering import with_line_numbers  # noqa: E402
from tidewatch.plans import QUERIES, inputs  # noqa: E402
from tidewatch.session import get_session, materialize, shared_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
HEADLINE = [
    "log_events", "log_quality", "event_issue_counts", "duplicate_events", "features_user_hour", "features_host_hour",
    "rolling_rows", "drift_statistics", "order_price_drift", "matrix_issues", "contract_summary", "document_entropy",
    "customer_pseudonyms", "exact_quantiles", "describe", "mutual_information", "stratified_split", "security_metrics",
    "threshold_sweep", "network_matches",
]

MORE = [
    "neighbour_recall", "smote_counts", "model_attribution", "model_comparison", "prepared_chain", "stream_log_events",
    "stream_hourly_features", "stream_unique_events", "stream_login_gaps", "neighbour_information", "own_classifiers",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run, repeats: int = 2) -> float:
    """The best of some runs after a warm-up."""
    run()
    return min(timed(run) for _ in range(repeats))


def rates(spark) -> dict[str, float]:
    """Records per second of the parser and of the validator on landed data."""
    # landed in as many files as there are cores
    lines = materialize(inputs.log_lines(spark, SF_DIR).repartition(int(CPUS)), "lines")
    n_lines = lines.count()
    parse = best(lambda: consume(log_parsing.parse_lines(lines, id_from=["line_id"])), 3)
    events, _ = log_parsing.normalize_logs(lines, id_from=["line_id"])
    numbered = materialize(with_line_numbers(materialize(events, "events"), ["line_id"]), "numbered")
    n_events = numbered.count()
    as_of = dt.datetime.fromisoformat(inputs.AS_OF)
    check = best(lambda: consume(event_checks.run_event_checks(numbered, as_of)), 3)
    found = {"parser_rows_per_sec": round(n_lines / parse), "validator_rows_per_sec": round(n_events / check)}
    return found | {f"{name}_per_core": round(rate / int(CPUS)) for name, rate in found.items()}


def training_table(spark, n_rows: int, columns: list[str]):
    """Two classes that some of the columns tell apart, from hashes of the row number."""
    from tidewatch.operators.sampling import seeded_uniform

    noise = {c: seeded_uniform(i, "id") for i, c in enumerate(columns)}
    rows = spark.range(n_rows).withColumn("y", (seeded_uniform(99, "id") < 0.3).cast("double"))
    return rows.withColumns({c: v + F.col("y") * (0.3 if i < 8 else 0.0) for i, (c, v) in enumerate(noise.items())})


def model_times(spark) -> dict[str, float]:
    """Inference in milliseconds a row, and with BENCH_TRAIN=1 the seconds of each model search."""
    columns = [f"c{i}" for i in range(35)]
    split = sampling.stratified_split(training_table(spark, 60_060, columns), "y", ["id"])
    table = materialize(training.assembled(split, columns), "flows")
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    out = {}
    for name in training.SEARCH_SPACE:
        model = training.base_model(name, len(columns), 2, "y")
        model = (model.setMaxIter(20) if hasattr(model, "setMaxIter") else model.setNumTrees(50)).fit(train)
        scored = best(lambda model=model: consume(training.score_batch(model, test)), 1)
        out[f"{name}_ms_per_row"] = round(scored * 1000 / test.count(), 5)
    if os.environ.get("BENCH_TRAIN"):
        folds = sampling.stratified_folds(train, "y", ["id"], 5)
        results = training.train_models(folds, table.where("split = 'val'"), "y", columns)
        out |= {f"{name}_search_sec": round(r["training_time"], 1) for name, r in results.items()}
    return out


def landed_tables(spark) -> str:
    """The tables in as many files as there are cores: a file of one row group would be read by one task."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/tables"
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(int(CPUS)).write.parquet(f"{folder}/{path.name}")
    return folder


def main() -> None:
    spark = get_session(
        "bench", f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": CPUS, "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = landed_tables(spark)
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    times = {n: round(best(lambda: consume(QUERIES[n](spark, folder)), 1), 3) for n in names}
    wanted = bool(os.environ.get("BENCH_MORE") or os.environ.get("BENCH_TRAIN"))
    more = {n: round(timed(lambda n=n: consume(QUERIES[n](spark, folder))), 3) for n in MORE} if wanted else {}
    models = model_times(spark)
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": float(scale.group(1)) if scale else SF_DIR, "cpus": int(CPUS), **rates(spark), "more": more, "models": models,
            }
        )
    )


if __name__ == "__main__":
    main()
