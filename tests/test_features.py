import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import pseudonymize
from tidewatch.operators.features import apply_rolling, compute_features, feature_names, matrix_summary
from tidewatch.sources.features import read_feature_csv, write_features
from tidewatch.sources.telemetry import load_telemetry, normalize_telemetry, read_telemetry, telemetry_counts

KEY = b"test-key"
START = dt.datetime(2026, 7, 20, 8)


def telemetry(n=900, seed=3):
    """Events in which one user has more than half of all logins."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        kind = rng.choice(["AUTH", "AUTH", "NETWORK", "DNS"])
        user = "hot" if rng.random() < 0.55 else rng.choice("abcd")
        rows.append(
            (
                START + dt.timedelta(seconds=rng.randrange(6 * 3600)), kind, user, None if kind == "DNS" else f"10.0.0.{rng.randrange(4)}",
                f"h{rng.randrange(2)}" if kind == "AUTH" else None, rng.choice(["SUCCESS", "FAILURE"]) if kind == "AUTH" else None,
                rng.randrange(5) if kind == "NETWORK" else None, rng.randrange(1000) if kind == "NETWORK" else None,
                f"10.1.0.{rng.randrange(3)}" if kind == "DNS" else None, rng.choice(["a.com", "xyz.net"]) if kind == "DNS" else None,
            )
        )
    return rows


SCHEMA = "timestamp timestamp, event_type string, user string, source_ip string, host string, status string, port int, bytes bigint, client_ip string, query_domain string"


def entropy(s):
    return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))


def by_hand(rows, entity):
    groups, logins = defaultdict(list), defaultdict(list)
    for r in rows:
        t, kind, user, ip, host, *_ = r
        ip = ip or r[8]
        e = user if entity == "user-hour" else host or ip
        groups[e, t.replace(minute=0, second=0)].append((*r[:3], ip, *r[4:]))
        if kind == "AUTH":
            logins[e].append(t)
    gaps = defaultdict(list)
    for e, times in logins.items():
        times.sort()
        for a, b in zip(times, times[1:]):
            gaps[e, b.replace(minute=0, second=0)].append((b - a).total_seconds() / 60)
    mean = {k: sum(v) / len(v) for k, v in gaps.items()}
    fill = sum(mean.values()) / len(mean) if mean else 0.0
    out = {}
    for k, g in groups.items():
        s = sum(r[1] == "AUTH" and r[5] == "SUCCESS" for r in g)
        f = sum(r[1] == "AUTH" and r[5] == "FAILURE" for r in g)
        domains = [r[9] for r in g if r[1] == "DNS"]
        out[k] = [
            s, f, len({r[3] for r in g}), f / (s + f) if s + f else 0.0, s / len(g), mean.get(k, fill),
            sum(map(entropy, domains)) / len(domains) if domains else 0.0, sum(map(len, domains)) / len(domains) if domains else 0.0,
            float(sum(r[7] for r in g if r[1] == "NETWORK")), len({r[6] for r in g if r[1] == "NETWORK"}),
        ]
    for k, v in out.items():
        peers = [w[1] for (_, h), w in out.items() if h == k[1]]
        m = sum(peers) / len(peers)
        sd = math.sqrt(sum((p - m) ** 2 for p in peers) / len(peers))
        v.append((v[1] - m) / sd if sd else 0.0)
    return out


NAMES = [
    "login_success_count", "login_failure_count", "unique_source_ips", "failure_ratio", "success_rate",
    "time_since_last_login_min", "dns_query_entropy", "domain_length", "bytes_transferred", "unique_dest_ports", "peer_deviation",
]


@pytest.mark.parametrize("window", ["user-hour", "host-hour"])
def test_matrix_by_hand(spark, window):
    rows = telemetry()
    df = normalize_telemetry(spark.createDataFrame(rows, SCHEMA))
    wanted = by_hand(rows, window)
    for parts in (1, 9):
        got = compute_features(df.repartition(parts), window, KEY, include_label=True).collect()
        assert len(got) == len(wanted)
        for r in got:
            values = wanted[r.entity_label, dt.datetime.strptime(r.hour, "%Y-%m-%d_%H")]
            for name, w in zip(NAMES, values):
                assert abs(r[name] - w) < 1e-9, (name, r, w)
            assert r.is_business_hours == (9 <= r.hour_of_day <= 17)
            low = "MEDIUM" if window == "user-hour" else "LOW"
            assert r.privacy_risk == ("HIGH" if abs(r.peer_deviation) > 1e-12 else low)
            assert r.window_id == f"{r.hour}_{r.entity_id}" and 0 <= r.failure_ratio <= 1


def test_labels_are_given_on_request_only(spark):
    df = normalize_telemetry(spark.createDataFrame(telemetry(30), SCHEMA))
    matrix = compute_features(df, "user-hour", KEY)
    assert "entity_label" not in matrix.columns and "hour" not in feature_names(matrix)
    with pytest.raises(ValueError):
        compute_features(df, "user-hour", b"")
    with pytest.raises(ValueError):
        compute_features(df, "day", KEY)


def test_rolling(spark):
    hours = ["2026-07-20_00", "2026-07-20_01", "2026-07-20_05", "2026-07-20_06"]
    df = spark.createDataFrame([("e", h, i + 1, 1, 10.0) for i, h in enumerate(hours)],
                               "entity_id string, hour string, login_failure_count int, login_success_count int, bytes_transferred double")
    rows = apply_rolling(df, "4h").orderBy("hour").collect()
    assert [r.login_failure_count_rolling_4h for r in rows] == [1, 3, 6, 10]
    hourly = apply_rolling(df, "4h", mode="range").orderBy("hour").collect()
    assert [r.login_failure_count_rolling_4h for r in hourly] == [1, 3, 3, 7]
    with pytest.raises(ValueError):
        apply_rolling(df, "2h")


def test_telemetry_files(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text(
        '{"timestamp":"2026-07-20T09:00:00Z","event_type":"NETWORK","source_ip":"1.1.1.1","port":443,"bytes":10}\n'
        '{"timestamp":"nope","event_type":"AUTH"}\n{broken\n'
        '{"timestamp":"2026-07-20T09:30:00.5Z","event_type":"DNS","client_ip":"2.2.2.2","query_domain":"a.b","port":"x"}\n'
    )
    path = str(tmp_path / "t.jsonl")
    counts = telemetry_counts(read_telemetry(spark, path)).first()
    assert tuple(counts) == (4, 1, 1, 2)
    rows = load_telemetry(spark, path).orderBy("timestamp").collect()
    assert [(r.source_ip, r.port, r.bytes) for r in rows] == [("1.1.1.1", 443, 10), ("2.2.2.2", None, None)]


def test_matrix_files(spark, tmp_path):
    df = normalize_telemetry(spark.createDataFrame(telemetry(60), SCHEMA))
    matrix = compute_features(df, "user-hour", KEY)
    write_features(matrix, *[str(tmp_path / n) for n in ("csv", "json", "meta")])
    meta = spark.read.json(str(tmp_path / "meta")).first()
    assert meta.record_count == matrix.count() and "peer_deviation" in meta.features
    flat = str(tmp_path / "flat")
    matrix.coalesce(1).write.csv(flat, header=True)
    back = read_feature_csv(spark, flat)
    assert sorted(r.line_number for r in back.collect()) == list(range(2, 2 + meta.record_count))
    s = matrix_summary(matrix).first()
    assert s.n_rows == meta.record_count and s.n_entities <= 5


def test_pseudonym_is_stable(spark):
    a = spark.range(1).select(pseudonymize(F.lit("x"), b"1").alias("a"), pseudonymize(F.lit("x"), b"2").alias("b")).first()
    assert a.a != a.b and a.a.startswith("ps_")
