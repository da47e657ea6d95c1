"""The neighbour estimate against a search over all pairs."""

import math

import numpy as np
import pytest

from tidewatch.operators import information
from tidewatch.operators.information import neighbour_information
from tidewatch.operators.preparation import select_features


def harmonic(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(x, y, k=3):
    rows = [(a, b) for a, b in zip(x, y) if a is not None and math.isfinite(a) and b is not None]
    size = {c: sum(b == c for _, b in rows) for c in {b for _, b in rows}}
    rows = [(a, b) for a, b in rows if size[b] > 1]
    total = 0.0
    for i, (a, b) in enumerate(rows):
        own = min(k, size[b] - 1)
        r = sorted(abs(a - u) for j, (u, v) in enumerate(rows) if v == b and j != i)[own - 1]
        m = sum(abs(a - u) < r if r else u == a for u, _ in rows)
        own = own if r else sum((u, v) == (a, b) for u, v in rows)
        total += harmonic(own) - harmonic(size[b]) - harmonic(m)
    return max(0.0, harmonic(len(rows)) + total / len(rows)) if rows else None


@pytest.mark.parametrize("partitions", [1, 7])
def test_brute_force(spark, partitions):
    rng = np.random.default_rng(11)
    y = [("a", "b", "c", None, "alone")[0 if i < 60 else 1 if i < 110 else 2 if i < 150 else 3 if i < 155 else 4] for i in range(156)]
    shift = np.array([{"a": 0, "b": 8, "c": 16}.get(c, 0) for c in y])
    near = (rng.integers(0, 12, 156) + shift).astype(float).tolist()
    far = rng.integers(0, 4000, 156).astype(float).tolist()
    flat = [1.0] * 156
    holes = [None if i % 5 == 0 else math.nan if i % 7 == 0 else math.inf if i % 11 == 0 else float(i % 23) for i in range(156)]
    df = spark.createDataFrame(list(zip(near, far, flat, holes, y)), "near double, far double, flat double, holes double, y string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for k in (1, 3):
            found = {r.feature: r.mutual_info for r in neighbour_information(df, ["near", "far", "flat", "holes"], "y", k).collect()}
            for name, x in (("near", near), ("far", far), ("flat", flat), ("holes", holes)):
                assert abs(found[name] - brute(x, y, k)) < 1e-9, name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert found["near"] > found["far"]


def test_selection_and_empty_tables(spark):
    df = spark.createDataFrame([(float(i % 2 * 100 + i % 9), float(i % 13), i % 2) for i in range(400)], "good double, bad double, y int")
    assert select_features(df, ["bad", "good"], "y", 1, method="neighbours") == ["good"]
    assert neighbour_information(df.where("y > 7"), ["good"], "y").collect() == []


def test_neighbours_cross_the_borders_of_small_blocks(spark):
    """Blocks of fewer than k values; what is around a value is plain columns, so no row holds or sorts arrays."""
    rng = np.random.default_rng(3)
    x, y = np.round(rng.normal(size=60) * 20).tolist(), [f"c{i % 2}" for i in range(60)]
    counts = spark.createDataFrame(list(zip(x, y)), "value double, _y string").groupBy("_y", "value").count().selectExpr("'x' AS feature", "_y", "value", "count AS n")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for k in (1, 3, 5):
            around = information._around(counts, k)
            assert not [c for c, kind in around.dtypes if kind.startswith("array")]
            found = {(r["_y"], r["value"]): r for r in around.collect()}
            assert len(found) == counts.count()
            for (c, v), r in found.items():
                own = {u: sum((a, b) == (u, c) for a, b in zip(x, y)) for u in sorted({a for a, b in zip(x, y) if b == c})}
                left, right = [u for u in own if u < v][::-1], [u for u in own if u > v]
                for i in range(1, k + 1):
                    assert (r[f"_l{i}"], r[f"_ln{i}"]) == ((v - left[i - 1], own[left[i - 1]]) if i <= len(left) else (None, None))
                    assert (r[f"_r{i}"], r[f"_rn{i}"]) == ((right[i - 1] - v, own[right[i - 1]]) if i <= len(right) else (None, None))
            df = spark.createDataFrame(list(zip(x, y)), "x double, y string")
            assert abs(neighbour_information(df, ["x"], "y", k).first().mutual_info - brute(x, y, k)) < 1e-9
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
