"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import periodic_runs as pr


def brute(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(least, 2 * q):
                part = words[s : s + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([2, 6, 12]))
def test_runs_of_words(words, least):
    assert pr.runs_of(words, least) == brute(words, least)


def test_long_and_nested_periods():
    rng = random.Random(5)
    for _ in range(60):
        unit = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        words = [rng.randrange(50) for _ in range(rng.randrange(20))] + unit * rng.randrange(1, 9)
        words = words * rng.randrange(1, 4) + [rng.randrange(3) for _ in range(rng.randrange(40))]
        assert pr.runs_of(words) == brute(words)
    assert pr.runs_of([0] * 20_000) == [(0, 20_000, 1)]
    assert pr.runs_of(list(range(3000)) * 3) == [(0, 9000, 3000)]


def row(text, repeat=None):
    words = pr.WORD.findall(text or "")
    if repeat:
        a, p = repeat
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    kept = " ".join(w for k, w in enumerate(words) if k not in drop)
    return len(runs), best, hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), kept


def found(df):
    return {r.doc_id: (r._n_runs, tuple(r._best) if r._best else None, r._runs_sha256, r._collapsed_sha256, r._collapsed) for r in df.collect()}


def test_documents(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a", "a " * 30, "x a b " * 9 + "x", "é b\x1cc d " * 12, "one two three four five six " * 2, "a b c d e f " * 1 + "a b c d e f"]
    for _ in range(150):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(len(words) + 1)
            words[a:a] = [rng.choice("pqrst") for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 7)
        texts.append(rng.choice([" ", "\n", "\t  "]).join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert found(pr.find(docs, collapse=True)) == {k: row(t) for k, t in enumerate(texts)}
    planted = found(pr.find(docs, repeat=lambda r, n: pr.planted(r["doc_id"], n), collapse=True))
    wanted = {}
    for k, t in enumerate(texts):
        n, h = len(pr.WORD.findall(t or "")), zlib.crc32(str(k).encode())
        a, g = (h // 10) % n if n else 0, h // 10
        wanted[k] = row(t, (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 and n else None)
    assert planted == wanted and planted != found(pr.find(docs, collapse=True))


def test_rows_and_columns(spark):
    rows = [(None, "a b " * 8, 5, "s"), (None, "a b " * 8, 5, "s"), (2, None, 6, None)]
    out = pr.find(spark.createDataFrame(rows, "doc_id long, text string, _n_runs int, source string"), repeat=lambda r, n: pr.planted(r["doc_id"], n)).collect()
    assert sorted((r._n_runs, r.source) for r in out if r.doc_id is None) == [(1, "s")] * 2 and len(out) == 3
    assert pr.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_stretches_leave_running_text_out():
    import numpy as np

    words = [str(k) for k in range(500)]
    lists = [words, words + words, words[:5] * 4, words[:3] + ["x", "y"] * 7 + words[:3]]
    codes, _, starts = pr.tokens(lists)
    assert pr.stretches(codes, starts) == [(500, 1500), (1500, 1520), (1523, 1537)]
    assert pr.stretches(np.zeros(0, np.int64), np.array([0, 0])) == []


@pytest.mark.parametrize("words", [[], ["a"], ["a", "b"] * 3])
def test_short_texts(words):
    assert pr.runs_of(pr.pd.factorize(pr.np.array(words, object))[0].tolist()) == []
