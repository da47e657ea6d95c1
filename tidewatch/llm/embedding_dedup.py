"""Exact pairs of embeddings with a cosine at or above a threshold, by dual traversal of cover trees.

Only vectors of one space (equal label and length) are compared. Equal vectors are a class, and one of a class is compared. On
unit vectors the cosine is a distance, so the search is for pairs within ``sqrt(2 - 2 * threshold)``. Large spaces are first split
over the cluster into nested cells around pivots, until a cell has at most ``cell_size`` classes; pairs of cells are followed
down level by level and dropped when their centres are farther apart than both covering radii and the search distance.
In the tasks each cell is a cover tree with halving radii; two trees (or one with itself) go down together, again pruned by covering
radii, and what is left is compared in double precision. No pair is written: a task gives every class its number of links and a tie.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite number, and vectors without a label, link with
nothing. Repeated rows (equal id, label and vector) are one vector in all counts; each row of the input has its row in the result.
Vectors of one id that differ are different vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components
from tidewatch.llm.ngram_join import hubs
from tidewatch.session import materialize

CELL_SIZE = 2000
MAX_PIVOTS = 32
ROUNDS = 24
SLACK = 1e-7
MAX_PRODUCTS = 4096
KEPT_TREES = 8


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


class CoverTree:
    """Nested levels over unit vectors: the nodes of a level lie within ``radius`` of their parent's centre, and the radius halves."""

    def __init__(self, x: np.ndarray, last_radius: float):
        n = len(x)
        self.x = x
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # by node: centre (a point), parent in the level above, covering radius
        products = x @ x.T if n <= MAX_PRODUCTS else None
        node = np.zeros(n, dtype=np.int64)
        centres, parents, radius = np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64), 2.0
        while n:
            self.levels.append((centres, parents, self._cover(x, centres, node)))
            if radius <= last_radius or len(centres) == n:
                break
            radius /= 2
            centres, parents, node = self._split(x, products, centres, node, radius)
        self.node = node  # of each point, in the last level

    @staticmethod
    def _cover(x: np.ndarray, centres: np.ndarray, node: np.ndarray) -> np.ndarray:
        out = np.zeros(len(centres))
        np.maximum.at(out, node, np.sqrt(((x - x[centres[node]]) ** 2).sum(axis=1)))
        return out

    @staticmethod
    def _split(x: np.ndarray, products: np.ndarray | None, centres: np.ndarray, node: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(node, kind="stable")
        cuts = np.searchsorted(node[order], np.arange(len(centres) + 1))
        sizes = np.diff(cuts)
        alone = np.flatnonzero(sizes == 1)  # their only point stays their centre
        new_node = np.empty(len(x), np.int64)
        new_node[order[cuts[alone]]] = np.arange(len(alone))
        new_centres, new_parents = centres[alone].tolist(), alone.tolist()
        near_enough = 1 - radius * radius / 2
        for parent in np.flatnonzero(sizes > 1):
            left = order[cuts[parent] : cuts[parent + 1]]
            pick = int(centres[parent])  # a centre stays one in the next level
            while True:
                near = (products[pick, left] if products is not None else x[left] @ x[pick]) >= near_enough
                near |= left == pick
                new_node[left[near]] = len(new_centres)
                new_centres.append(pick)
                new_parents.append(int(parent))
                left = left[~near]
                if not len(left):
                    break
                pick = int(left[0])
        return np.array(new_centres), np.array(new_parents), new_node


def search_distance(threshold: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * threshold))


def close_pairs(
    x: np.ndarray, y: np.ndarray | None, threshold: float, tx: CoverTree | None = None, ty: CoverTree | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with cosine at the threshold or above, i of ``x`` and j of ``y``; with ``y`` None pairs i < j of ``x``."""
    distance = search_distance(threshold)
    tx = tx or CoverTree(units(x), distance / 2)
    ty = tx if y is None else ty or CoverTree(units(y), distance / 2)
    ux, uy = tx.x, ty.x
    near = np.ones((1, 1), bool)
    for level in range(max(len(tx.levels), len(ty.levels))):
        (cx, px, rx), (cy, py, ry) = tx.levels[min(level, len(tx.levels) - 1)], ty.levels[min(level, len(ty.levels) - 1)]
        # nodes of a tree that has ended stand for themselves
        px = px if level < len(tx.levels) else np.arange(len(cx))
        py = py if level < len(ty.levels) else np.arange(len(cy))
        some_x, some_y = near.any(axis=1)[px], near.any(axis=0)[py]
        after = np.zeros((len(cx), len(cy)), bool)
        kx, ky = np.flatnonzero(some_x), np.flatnonzero(some_y)
        if not len(kx) or not len(ky):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        reach = rx[kx][:, None] + ry[ky][None, :] + (distance + SLACK)
        # distance <= reach, as a bound of the cosine
        after[np.ix_(kx, ky)] = near[np.ix_(px[kx], py[ky])] & (ux[cx[kx]] @ uy[cy[ky]].T >= 1 - reach * reach / 2)
        near = after
    at_x, at_y = np.flatnonzero(near.any(axis=1)[tx.node]), np.flatnonzero(near.any(axis=0)[ty.node])
    found_i, found_j = [], []
    norm_x = np.sqrt(np.einsum("ij,ij->i", x, x))
    y = x if y is None else y
    norm_y = np.sqrt(np.einsum("ij,ij->i", y, y))
    for k in range(0, len(at_x), 1024):
        part = at_x[k : k + 1024]
        cosine = (x[part] @ y[at_y].T) / (norm_x[part][:, None] * norm_y[at_y][None, :])
        i, j = np.nonzero((cosine >= threshold) & near[np.ix_(tx.node[part], ty.node[at_y])])
        found_i.append(part[i])
        found_j.append(at_y[j])
    i, j = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (found_i, found_j))
    return (i[i < j], j[i < j]) if ty is tx else (i, j)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def _radius(a: Column, b: Column) -> Column:
    """Distance of the directions of two vectors."""
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))))


def _cells(points: DataFrame, cell_size: int) -> tuple[DataFrame, list[DataFrame]]:
    """The points with their last cells, and the nodes (node, parent, centre, radius, n) of each level."""
    levels: list[DataFrame] = []
    for turn in range(ROUNDS):
        centre = points.groupBy("node").agg(F.min_by("vector", F.xxhash64("class")).alias("centre"), F.count(F.lit(1)).alias("n"))
        centred = points.join(centre, "node")
        nodes = materialize(
            centred.groupBy("node").agg(F.max(_radius(F.col("vector"), F.col("centre"))).alias("radius"), F.first("centre").alias("centre"), F.first("n").alias("n"))
            .withColumn("parent", F.when(F.instr("node", "/") > 0, F.regexp_replace("node", "/[^/]*$", ""))),
            "cells",
        )
        levels.append(nodes)
        large = nodes.where(F.col("n") > cell_size).select("node", F.least(F.lit(MAX_PIVOTS), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / cell_size))).cast("int").alias("k"))
        if turn == ROUNDS - 1 or large.isEmpty():
            break
        picked = (
            points.join(large, "node").groupBy("node", F.pmod(F.xxhash64(F.lit(turn), "class"), F.col("k")).alias("place"))
            .agg(F.min_by("vector", F.xxhash64(F.lit(turn + ROUNDS), "class")).alias("pivot"))
            .withColumn("norm", F.sqrt(_dot(F.col("pivot"), F.col("pivot")))).withColumn("pivot", F.transform("pivot", lambda v: v / F.col("norm")))
            .groupBy("node").agg(F.sort_array(F.collect_list("pivot")).alias("pivots"))
        )
        near = points.join(picked, "node", "left").withColumn("near", F.transform("pivots", lambda p: _dot(p, F.col("vector"))))
        nearest = F.array_position("near", F.array_max("near")).cast("string")
        points = materialize(
            near.select("space", "class", "copies", "vector", F.when(F.col("pivots").isNull(), F.col("node")).otherwise(F.concat_ws("/", "node", nearest)).alias("node")), "points"
        )
    return points, levels


def _cell_pairs(levels: list[DataFrame], distance: float) -> DataFrame:
    """(a, b), a <= b: the pairs of last cells that may hold close vectors."""
    first = levels[0]
    pairs = first.select(F.col("node").alias("a"), F.col("node").alias("b"))
    for above, level in zip(levels, levels[1:], strict=False):
        moved = level.where(F.col("parent").isNotNull())
        # cells that were not split are in the next level as they were
        same = level.join(above.select(F.col("node").alias("_was")), F.col("node") == F.col("_was"), "left_semi").select(F.col("node").alias("up"), "node", "centre", "radius")
        split = moved.join(above.select(F.col("node").alias("_was")), F.col("node") == F.col("_was"), "left_anti").select(F.col("parent").alias("up"), "node", "centre", "radius")
        below = materialize(same.unionAll(split), "children")
        left = below.select(F.col("up").alias("a"), F.col("node").alias("la"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
        right = below.select(F.col("up").alias("b"), F.col("node").alias("lb"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
        joined = pairs.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("la") <= F.col("lb")))
        near = joined.where((F.col("la") == F.col("lb")) | (_radius(F.col("ca"), F.col("cb")) <= F.col("ra") + F.col("rb") + distance + SLACK))
        pairs = materialize(near.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")), "cell-pairs")
    return pairs


def _traverse(threshold: float):
    schema = pa.schema([("class", pa.string()), ("links", pa.int64()), ("hub", pa.string())])

    trees: dict[str, CoverTree] = {}  # the last ones of a task: a cell comes with many others

    def tree(cell: str, x: np.ndarray) -> CoverTree:
        if cell not in trees or len(trees[cell].x) != len(x):
            if len(trees) >= KEPT_TREES:
                del trees[next(iter(trees))]
            trees[cell] = CoverTree(units(x), search_distance(threshold) / 2)
        return trees[cell]

    def one(a: str, b: str, batch: pa.Table) -> pa.RecordBatch | None:
        batch = batch.sort_by([("node", "ascending"), ("class", "ascending")])
        node, names, copies = (batch.column(c).to_pylist() for c in ("node", "class", "copies"))
        x = _matrix(batch.column("vector").combine_chunks())
        split = node.index(b) if a != b and b in node else None
        if a != b and (split is None or not split):
            return None
        if split is None:
            i, j = close_pairs(x, None, threshold, tree(a, x))
        else:
            i, j = close_pairs(x[:split], x[split:], threshold, tree(a, x[:split]), tree(b, x[split:]))
        if not len(i):
            return None
        j = j if split is None else j + split
        copies = np.array(copies)
        links = np.bincount(i, weights=copies[j], minlength=len(x)) + np.bincount(j, weights=copies[i], minlength=len(x))
        hub = hubs(len(x), i, j)
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array([names[k] for k in some]), pa.array(links[some].astype(np.int64)), pa.array([names[hub[k]] for k in some])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            start = 0
            for i in range(batch.num_rows + 1):
                own = (a[i], b[i]) if i < batch.num_rows else None
                if own != (a[start], b[start]):
                    if key is not None and key != (a[start], b[start]):
                        if (out := one(*key, pa.Table.from_batches(held))) is not None:
                            yield out
                        held = []
                    key = (a[start], b[start])
                    held.append(batch.slice(start, i - start))
                    start = i
        if held and (out := one(*key, pa.Table.from_batches(held))) is not None:
            yield out

    return run


def similar(vectors: DataFrame, threshold: float = 0.93, cell_size: int = CELL_SIZE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``."""
    distance = search_distance(threshold)
    plain = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).cast("string").alias("_label"), F.col(vector_col).cast("array<double>").alias("_vector"))
    usable = F.col("_label").isNotNull() & F.coalesce(_usable(F.col("_vector")), F.lit(False))
    clean = F.transform("_vector", lambda v: v + 0.0)  # one zero
    name = F.format_string("%016x%016x", F.xxhash64("_label", "_clean"), F.xxhash64(F.lit(1), "_label", "_clean"))
    keyed = plain.withColumn("_clean", F.when(usable, clean)).select("_id", "_label", "_clean", F.when(F.col("_clean").isNotNull(), name).alias("_class"))
    good = keyed.where("_class IS NOT NULL")
    counts = good.groupBy("_class").agg(F.count_distinct(F.struct("_id")).alias("copies"), F.min("_id").alias("first"), F.first("_label").alias("_label"), F.first("_clean").alias("vector"))
    space = F.concat(F.hex(F.xxhash64("_label")), F.lit("."), F.size("vector").cast("string"))
    classes = materialize(counts.select(F.col("_class").alias("class"), "copies", "first", space.alias("space"), "vector"), "vectors")
    points, levels = _cells(classes.select("space", "class", "copies", "vector", F.col("space").alias("node")), cell_size)
    pairs = _cell_pairs(levels, distance)
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sides.join(points.select("node", "class", "copies", "vector"), "node").repartition(parts, "a", "b").sortWithinPartitions("a", "b")
    found = materialize(dealt.mapInArrow(_traverse(threshold), "class string, links long, hub string"), "links")
    groups = components(found.select(F.col("class").alias("a"), F.col("hub").alias("b")))
    summed = found.groupBy(F.col("class").alias("_linked")).agg(F.sum("links").alias("links"))
    # both sides are written, so that the join can split a large group
    grouped = materialize(groups.join(classes.select("class", "first"), F.col("class") == F.col("node")).select("node", "first", F.col("component").alias("group")), "vector-groups")
    heads = materialize(grouped.groupBy(F.col("group").alias("_group")).agg(F.min("first").alias("head")), "heads")
    headed = materialize(grouped.join(heads, F.col("group") == F.col("_group")).select("node", "head"), "vector-groups")
    named = (
        classes.select("class", "copies", "first").join(headed, F.col("class") == F.col("node"), "left").join(summed, F.col("class") == F.col("_linked"), "left")
        .select("class", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("head", "first").alias("head"))
    )
    named = materialize(named, "vector-groups")
    return keyed.select("_id", "_class").join(named, F.col("_class") == F.col("class"), "left").select(
        F.col("_id").alias("vec_id"), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("head", "_id").alias("component_id"), F.coalesce(F.col("_id").eqNullSafe(F.coalesce("head", "_id")), F.lit(True)).alias("kept"),
    )
