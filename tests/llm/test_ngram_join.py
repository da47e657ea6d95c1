import re
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import ngram_join as nj


def brute(rows, threshold=0.8, width=5):
    """Links and groups of distinct (id, text) by definition."""
    rows = sorted(set(rows), key=repr)
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    links, name = [0] * len(rows), list(range(len(rows)))
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
        a, b = name[i], name[j]
        name = [min(a, b) if n in (a, b) else n for n in name]
    key = lambda r: (r[0] is not None, r[0] if r[0] is not None else 0)
    low = {}
    for r, n in zip(rows, name, strict=True):
        low[n] = min(low.get(n, r), r, key=key)
    return sorted(((r[0], low[n][0], k) for r, n, k in zip(rows, name, links, strict=True)), key=repr)


def texts(n, seed, vocabulary=2000):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    out = []
    for g in range(n):
        base = list(rng.choice(words, rng.integers(6, 120)))
        for _ in range(rng.integers(1, 8)):
            copy = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 25)):
                copy[rng.integers(len(copy))] = str(rng.choice(words))
            out.append(" ".join(copy))
    return out


ODD = [
    (9001, None), (9002, ""), (9003, "!!"), (9004, "One two"), (9005, "one, TWO!"), (9006, "one two three"), (9007, "a b c d e"), (9008, "long text " * 20000), (9009, "long text " * 20001),
    (9010, "x y z u v w"), (9010, "x y z u v w"), (9010, "other words than those"), (None, "x y z u v w"),
]


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class string")
    return nj.flag(df, **options).collect()


def test_against_brute_force(spark):
    rows = [*enumerate(texts(60, 1)), *ODD]
    found = run(spark, rows)
    assert len(found) == len(rows)
    assert sorted({(r.doc_id, r.text, r._group_id, r._n_links) for r in found}, key=repr) and sorted(
        ((i, g, k) for i, _, g, k in {(r.doc_id, r.text, r._group_id, r._n_links) for r in found}), key=repr
    ) == brute(rows)
    kept = Counter((r._group_id) for r in {(x.doc_id, x.text, x._group_id): x for x in found if x._kept}.values() if r.text and re.search(r"\w", r.text))
    assert set(kept.values()) == {1}


def test_blocks_change_nothing(spark, monkeypatch):
    rows = list(enumerate(texts(25, 2)))
    whole = sorted(run(spark, rows), key=repr)
    monkeypatch.setattr(nj, "BLOCK_CLASSES", 2)
    monkeypatch.setattr(nj, "COLUMN_CHUNK", 5)
    assert sorted(run(spark, rows), key=repr) == whole


def test_a_large_group_of_near_copies_is_complete(spark):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        words = list(base)
        words[rng.integers(60)] = f"x{i % 40}"
        rows.append((i, " ".join(words)))
    expected = {i: k for i, _, k in brute(rows[:300])}
    assert {r.doc_id: r._n_links for r in run(spark, rows[:300])} == expected
    found = run(spark, rows)
    assert len({r._group_id for r in found}) == 1 and sum(r._kept for r in found) == 1


def test_one_row_of_repeated_rows_stays(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "no"), (3, "no"), (4, None), (4, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in nj.keep_one(df).collect()) == [1, 3, 4]
    assert nj.keep_one(df.limit(0)).collect() == [] and nj.flag(df.limit(0)).collect() == []


def test_bands_for_a_recall():
    bands, rows = nj.band_plan(0.8, 0.9999)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (128 // (rows + 1)) < 0.9999
    with pytest.raises(ValueError):
        nj.band_plan(0.1, 0.9999, 4)


def test_measured_recall_of_the_bands():
    rng = np.random.default_rng(7)
    bands, rows = nj.band_plan(0.8, 0.999, 64)
    hit = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, 90).astype(np.uint64)
        one, two = np.append(both[:80], both[80:85]), np.append(both[:80], both[85:])
        values = np.concatenate([np.sort(one), np.sort(two)])
        signed, digests = nj.signatures(values, np.array([0, 85, 170]), bands, rows)
        hit += bool((signed[0] == signed[1]).any())
        assert digests[0] != digests[1]
    assert hit >= 299  # similarity 80/90
