"""Periodic runs of words, found through the suffix automaton of a text and link-cut access.

The suffix links of the automaton are a tree whose nodes are the repeated word sequences. In the order of the text, each word accesses the node of its
prefix: the path to the root takes the word's number as its last occurrence. The path falls into segments of equal previous number; a
segment with previous end ``e`` and longest sequence ``l`` gives a square ending at word ``i`` where the distance ``i - e`` is at most
``l``, and the square is extended to its run once. The segments of the access (the preferred paths) are kept as stacks on the heavy paths of the tree, which
is finished before the first access: every access is a few heavy paths, and a segment is changed once for each number it loses.

Only stretches that may hold a run reach the automaton. A run of at least 12 words repeats each of its words inside a sequence of six at the distance of its
period, so it lies in a stretch of words that repeated sequences of six cover; such stretches are cut out until none shrinks. Nothing of a run is
lost this way, and running text has no such stretch.

Defined results: a null or empty text has no words and no run. Every row has its result; equal rows have equal ones.
A column of the documents with the name of a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.llm.common import mix, slices, tokens, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: What only str.split takes for white space.
FURTHER = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Least length of a run, and the words of a sequence that each run repeats.
LEAST, WIDTH = 12, 6


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    return WORD.findall(text) if FURTHER.search(text) else text.split()


def automaton(words: list[int]) -> tuple[array, array, array]:
    """(suffix link, longest length) of each state and the state of each prefix. ``words`` are numbers from 0 on."""
    link, size = array("i", [-1]), array("i", [0])
    word_of, goes = array("i", [-1]), array("i", [0])  # the first transition of a state; further ones are in ``more``
    more: dict[int, dict[int, int]] = {}
    prefix = array("i")
    last = 0
    for c in words:
        own = len(link)
        link.append(0)
        size.append(size[last] + 1)
        word_of.append(-1)
        goes.append(0)
        p, q = last, -1
        while p != -1:
            if word_of[p] == c:
                q = goes[p]
                break
            others = more.get(p)
            if others is not None and c in others:
                q = others[c]
                break
            if word_of[p] < 0:
                word_of[p], goes[p] = c, own
            elif others is None:
                more[p] = {c: own}
            else:
                others[c] = own
            p = link[p]
        if q >= 0:
            if size[p] + 1 == size[q]:
                link[own] = q
            else:
                copy = len(link)
                link.append(link[q])
                size.append(size[p] + 1)
                word_of.append(word_of[q])
                goes.append(goes[q])
                if q in more:
                    more[copy] = dict(more[q])
                while p != -1:
                    if word_of[p] == c:
                        if goes[p] != q:
                            break
                        goes[p] = copy
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != q:
                            break
                        others[c] = copy
                    p = link[p]
                link[q] = link[own] = copy
        prefix.append(own)
        last = own
    return link, size, prefix


def heavy_heads(link: array, size: array) -> array:
    """The highest state of the heavy path of each state."""
    n = len(link)
    order = np.argsort(np.frombuffer(size, np.int32), kind="stable").tolist()
    below, heavy = array("i", [1]) * n, array("i", [-1]) * n
    for v in reversed(order[1:]):
        up = link[v]
        below[up] += below[v]
        if heavy[up] < 0 or below[v] > below[heavy[up]]:
            heavy[up] = v
    head = array("i", range(n))
    for v in order[1:]:
        if heavy[link[v]] == v:
            head[v] = head[link[v]]
    return head


def runs_of(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with a length of at least ``least`` and twice the period, by start and period."""
    n = len(words)
    link, size, prefix = automaton(words)
    head = heavy_heads(link, size)
    segments: dict[int, list[tuple[int, int]]] = {}  # by heavy path: (length at the lower end, last occurrence), the one next to the root last
    reached: dict[int, int] = {}  # by period: the end of its last run
    found = []
    for i in range(n):
        x = prefix[i]
        while x > 0:
            top = head[x]
            length = size[x]
            stack = segments.get(top)
            if stack is None:
                segments[top] = [(length, i)]
            else:
                done, hits = 0, []
                while stack and stack[-1][0] <= length:
                    hits.append(stack[-1])
                    done = stack.pop()[0]
                if stack and done < length:
                    hits.append((length, stack[-1][1]))
                stack.append((length, i))
                for same, before in hits:
                    period = i - before
                    if period <= same and reached.get(period, -1) < i:
                        low = i - same
                        while low >= period and words[low] == words[low - period]:
                            low -= 1
                        high = i + 1
                        while high < n and words[high] == words[high - period]:
                            high += 1
                        reached[period] = high - 1
                        start = low + 1 - period
                        if high - start >= least:
                            found.append((start, high - start, period))
            x = link[top] if top else 0
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def stretches(codes: np.ndarray, starts: np.ndarray, least: int = LEAST, width: int = WIDTH) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that may hold a run, in the words of all documents one after the other."""
    hashes = mix(codes.astype(np.uint64) + np.uint64(1))
    begin, end = starts[:-1], starts[1:]
    while True:
        long = end - begin >= least
        begin, end = begin[long], end[long]
        if not len(begin):
            return []
        sizes = end - begin
        own = np.repeat(np.arange(len(begin)), sizes)
        place = np.arange(len(own)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        grams = window_hashes(hashes[place], width)
        whole = own[: len(grams)] == own[width - 1 :]
        key = mix(grams[whole] ^ mix(own[: len(grams)][whole].astype(np.uint64)))
        again = np.flatnonzero(whole)[pd.Series(key).duplicated(keep=False).to_numpy()]
        covered = np.zeros(len(own) + 1, np.int32)
        np.add.at(covered, again, 1)
        np.add.at(covered, again + width, -1)
        inside = np.cumsum(covered[:-1]) > 0
        edge = np.flatnonzero(np.concatenate(([True], (inside[1:] != inside[:-1]) | (own[1:] != own[:-1]), [True])))
        first, last = edge[:-1], edge[1:]
        first, last = first[inside[edge[:-1]]], last[inside[edge[:-1]]]
        after = place[first] if len(first) else np.zeros(0, np.int64)
        until = after + (last - first)
        if len(after) == len(begin) and (after == begin).all() and (until == end).all():
            return list(zip(begin.tolist(), end.tolist(), strict=True))
        begin, end = after, until


def planted(doc_id, n: int) -> tuple[int, int] | None:
    """(a, p) where the words of a document from ``a`` on repeat with period ``p``, by the checksum of its id; a null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 else None


def find(docs: DataFrame, text_col: str = "text", repeat=None, least: int = LEAST, collapse: bool = False) -> DataFrame:
    """All columns of ``docs``, ``_runs`` (start, length, period) and the digests ``_n_runs``, ``_best``, ``_runs_sha256``, ``_collapsed_sha256``.

    ``_best`` is the longest run (ties: smallest start, then period), null without runs. With ``collapse`` also ``_collapsed``: the words outside of repetitions,
    joined by a space. ``repeat(row, n)`` may name (a, p): the words from ``a`` on are then read with period ``p``.
    """
    more = "_n_runs long, _best struct<start: long, length: long, period: long>, _runs_sha256 string, _collapsed_sha256 string, _runs array<struct<start: long, length: long, period: long>>"
    results = StructType.fromDDL(more + ", _collapsed string" * collapse)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in results.names])
    schema = StructType([*docs.schema.fields, *results.fields])
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_col):
            lists = [words_of(t) for t in texts]
            if repeat is not None:
                for k, row in enumerate(batch.drop_columns([text_col]).to_pylist()):
                    words = lists[k]
                    if (own := repeat(row, len(words))) is not None:
                        a, p = own
                        unit = words[a : a + p]
                        lists[k] = words[:a] + (unit * (1 + (len(words) - a) // p))[: len(words) - a]
            codes, _, starts = tokens(lists)
            found: list[list[tuple[int, int, int]]] = [[] for _ in lists]
            for begin, end in stretches(codes, starts, least):
                own = int(np.searchsorted(starts, begin, side="right")) - 1
                shift = begin - int(starts[own])
                found[own] += [(s + shift, length, period) for s, length, period in runs_of(pd.factorize(codes[begin:end])[0].tolist(), least)]
            best, hashes, collapsed = [], [], []
            for words, runs in zip(lists, found, strict=True):
                runs.sort(key=lambda r: (r[0], r[2]))
                top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                best.append(dict(zip(("start", "length", "period"), top, strict=True)) if top else None)
                hashes.append(hashlib.sha256("".join(f"{s},{length},{period}\n" for s, length, period in runs).encode()).hexdigest())
                if runs:
                    depth = np.zeros(len(words) + 1, np.int32)
                    for s, length, period in runs:
                        depth[s + period] += 1
                        depth[s + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                collapsed.append(" ".join(words))
            columns = [
                pa.array([len(r) for r in found], pa.int64()), pa.array(best, run_type), pa.array(hashes), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in collapsed]),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(run_type)),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, *([pa.array(collapsed)] * collapse)], names=schema.names)

    return docs.mapInArrow(run, schema)
