"""Helpers that the corpus operators share: tokens of a batch, stable hashes, components."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewatch.session import materialize

WORD = re.compile(r"\w+")
#: Characters of text a task tokenizes at once; a longer text is a slice of its own.
SLICE_CHARS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of the batches with at most ``limit`` characters of text, or one row."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def tokens(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens in order, the distinct tokens, and where each list starts (one more than lists)."""
    starts = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = np.empty(int(starts[-1]), dtype=object)
    flat[:] = list(chain.from_iterable(lists))
    codes, distinct = pd.factorize(flat)
    return codes, np.asarray(distinct, dtype=object), starts


def hash_strings(values: np.ndarray) -> np.ndarray:
    """64-bit hashes that are the same in every process."""
    return pd.util.hash_array(np.asarray(values, dtype=object), categorize=False) if len(values) else np.zeros(0, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` hashes; shorter by ``width - 1``."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= _MIX
        out += hashes[k : k + n]
    return mix(out)


def pack(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``keep`` and one struct of all other columns, so that no name of theirs meets one of an operator."""
    rest = [c for c in docs.columns if c not in keep]
    own = [F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row")] if rest else []
    return docs.select(*keep, *own)


def unpack(packed: DataFrame, columns: list[str], keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The columns as they were before ``pack``."""
    return packed.select(*[F.col(c) if c in keep else F.col("_row").getField(c).alias(c) for c in columns])


def widened(fields: list[StructField], more: str) -> StructType:
    """Fields and those of a DDL string."""
    return StructType([*fields, *StructType.fromDDL(more).fields])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b); a component is named by its smallest node.

    In each round every node joins the first of its neighbours and itself, in the order of the nodes at first and of a new hash in later rounds, and then the one that
    this one has joined. Edges are contracted to what their ends have joined, so rounds shrink. Each round is written, so lost executors cost no more than a round.
    """
    edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        place = F.lit(0) if not rounds else F.xxhash64(F.lit(len(rounds)), "node")
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("own", "node")
        first = both.groupBy("own").agg(F.min(F.struct(place.alias("place"), "node")).alias("near")).withColumnRenamed("own", "node")
        chosen = materialize(first.select("node", F.least("near", F.struct(place.alias("place"), "node"))["node"].alias("to")), "names")
        further = chosen.select(F.col("node").alias("_at"), F.col("to").alias("_there"))
        rounds.append(materialize(chosen.join(further, F.col("to") == F.col("_at")).select("node", F.col("_there").alias("to")), "names"))
        for end in ("a", "b"):
            edges = edges.join(rounds[-1].withColumnRenamed("to", "_to"), F.col(end) == F.col("node")).withColumn(end, F.col("_to")).drop("node", "_to")
        edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    names = rounds[0]
    for after in rounds[1:]:
        moved = after.select(F.col("node").alias("_at"), F.col("to").alias("_there"))
        names = names.join(moved, F.col("to") == F.col("_at"), "left").select("node", F.coalesce("_there", "to").alias("to"))
    if len(rounds) == 1:  # the smallest node is the first one
        return names.withColumnRenamed("to", "component")
    names = materialize(names, "names")
    least = materialize(names.groupBy(F.col("to").alias("_at")).agg(F.min("node").alias("component")), "names")
    return names.join(least, F.col("to") == F.col("_at")).select("node", "component")
