import hashlib
import hmac
import ipaddress
import math
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.functions import jsons, net, text, times

ADDRESSES = (
    "1.2.3.4 01.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5 10.0.0.1 172.16.0.1 172.32.0.1 192.168.255.255 127.0.0.1 0.0.0.0 "
    "::1 :: 1:: fe80::1%eth0 fe80::1% 1:2:3:4:5:6:7:8 1:2:3:4:5:6:7::8 1:2:3:4:5:6:7:: ::ffff:10.0.0.1 1::2:10.0.0.1 "
    "1:2:3:4:5:6:1.2.3.4 fc00::1 fdff::2 fc::1 12345::1 g::1 1:2:3 :::1 1::2::3 ::1.2.3.4 1.2.3.4: abcd:EF01::"
).split() + ["1.2.3.4\n", " 1.2.3.4", ""]
PRIVATE = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "fc00::/7")]


def parsed(ip):
    try:
        return ipaddress.ip_address(ip)
    except ValueError:
        return None


def test_addresses(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string")
    rows = df.select(
        "ip", net.is_valid_ip(F.col("ip")).alias("ok"), net.is_private_ip(F.col("ip")).alias("private"),
        net.ip_hex(F.col("ip")).alias("hex"), net.normalize_ip(F.col("ip")).alias("norm"),
    ).collect()
    for r in rows:
        a = parsed(r.ip)
        assert r.ok == (a is not None), r
        assert r.private == (a is not None and any(a in n for n in PRIVATE)), r
        assert r.hex == (None if a is None else format(int(a), "032x" if a.version == 6 else "08x")), r
        assert r.norm == (r.ip.strip() if parsed(r.ip.strip()) else None), r


def test_network_matches(spark):
    nets = "10.0.0.0/8 10.0.0.0/30 172.16.0.0/12 fc00::/7 1.2.3.4/32 0.0.0.0/0 1:2:3:4:5:6:7:8/127 ::/0 192.0.0.0/2".split()
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string")
    found = net.match_networks(df, "ip", spark.createDataFrame([(n,) for n in nets], "cidr string"))
    wanted = {(a, n) for a in ADDRESSES if parsed(a) for n in nets if parsed(a) in ipaddress.ip_network(n)}
    assert {(r.ip, r.cidr) for r in found.collect()} == wanted


def test_timestamps(spark):
    wanted = {
        "2026-07-15T10:23:45Z": "2026-07-15T10:23:45Z", "2026-07-15T10:23:45": "2026-07-15T10:23:45Z",
        "2026-07-15 10:23:45": "2026-07-15T10:23:45Z", "2026-07-15T12:23:45+0200": "2026-07-15T10:23:45Z",
        "2026-07-15T12:23:45+02:00": "2026-07-15T10:23:45Z", "15/Jul/2026:12:23:45 +0200": "2026-07-15T10:23:45Z",
        " 2026-7-5 1:2:3 ": "2026-07-05T01:02:03Z", "not-a-timestamp": None, "": None, "2026-13-01T00:00:00Z": None,
        "2026-02-30 00:00:00": None, "2026-07-15T10:23:60Z": None, "2026-07-15": None, "2026-07-15 10:23:45Z": None,
    }
    df = spark.createDataFrame([(t,) for t in wanted], "t string")
    got = df.select("t", times.normalize_timestamp(F.col("t")).alias("o"), times.parse_event_time(F.col("t")).isNotNull().alias("strict"))
    for r in got.collect():
        assert r.o == wanted[r.t], r
        assert r.strict == (r.t in list(wanted)[:3]), r
    half = spark.range(1).select(times.parse_telemetry_time(F.lit("2026-07-15T10:23:45.250Z")).alias("t")).first().t
    assert half.microsecond == 250000


def test_entropy_and_pseudonym(spark):
    words = ["example.com", "xk3q9fjzo.net", "aaaa", "", "a😀b😀", "é\n\n", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for key in (b"k", b"x" * 100):
        for r in df.select("w", text.shannon_entropy(F.col("w")).alias("h"), text.pseudonymize(F.col("w"), key).alias("p")).collect():
            n = len(r.w or "")
            assert abs(r.h - (-sum(c / n * math.log2(c / n) for c in Counter(r.w).values()) if n else 0)) < 1e-12
            if r.w is None:
                assert r.p is None
            else:
                assert r.p == "ps_" + hmac.new(key, r.w.encode(), hashlib.sha256).hexdigest()[:16]
    # fixed values: the token of "dave" under the placeholder key, the entropy of two domains
    one = spark.range(1).select(
        text.pseudonymize(F.lit("dave"), b"CHANGE_ME_IN_PRODUCTION_secret_key").alias("p"),
        text.shannon_entropy(F.lit("example.com")).alias("a"), text.shannon_entropy(F.lit("xk3q9fjzo.net")).alias("b"),
    ).first()
    assert one.p == "ps_ba91f0aa805d2926"
    assert abs(one.a - 3.0957952550009344) < 1e-12 and abs(one.b - 3.7004397181410926) < 1e-12


def test_strict_json(spark):
    cases = {'{"a":1}': True, ' [1] ': True, '{"a":1} x': False, '{"a":1}{"b":2}': False, '{"a":1},{"b":2}': False,
             '{"a":1}] y': False, "": False, "nul": False, "null": True, '"s"': True}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    for r in df.select("t", jsons.parse_strict(F.col("t")).isNotNull().alias("ok")).collect():
        assert r.ok == cases[r.t], r


def test_thousands(spark):
    df = spark.createDataFrame([("1",), ("1234",), ("9" * 21,)], "d string").select("d", text.thousands(F.col("d")).alias("t"))
    assert all(r.t == f"{int(r.d):,}" for r in df.collect())
