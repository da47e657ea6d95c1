"""Nearest neighbours and synthetic oversampling.

``nearest_neighbours`` is linear in the number of points: for each of a few random projection trees all points
are put in order (by the signs of some projections, then by another one) and cut into leaves of equal size;
neighbours inside a leaf are compared there. Then the neighbours of neighbours are tried, some rounds long: a
point meets those who have it as a neighbour with its own neighbours, so no pair of candidates is a row, and only
what is nearer than the neighbours known so far leaves the task. Vectors go out in passes of about ``PASS_BYTES``.
Points spread evenly in many dimensions are not found like this. The recall is measured on a sample, and where it is
too low all points are compared with all: quadratic, but in blocks and without pairs of blocks being shuffled.
``exact_neighbours`` compares a stated set of queries with all points, block by block, and measures the recall of
the other; its blocks are read again from where they were written, and no copies of them are dealt out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import with_line_numbers
from tidewatch.operators.sampling import assign_by_rank, seeded_hash, seeded_uniform
from tidewatch.session import materialize

LEAF_ROWS = 256
TREES = 8
ROUNDS = 2
SPARE = 10
BLOCK_ROWS = 2000
MAX_CLASSES = 1000
# the recall that the search must reach on about so many points
ENOUGH = 0.97
SAMPLE_ROWS = 1000
# bytes of vectors that are on their way at once, points that are merged and that others meet at in one group
PASS_BYTES = 500_000_000
MERGE_ROWS = 8192
MEET_ROWS = 1024
_LISTS = "pid bigint, nb array<bigint>, dist array<double>"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# of a query and of a point without an id, which are nobody's copies
_NO_QUERY, _NO_POINT = -(2**63), -(2**63) + 1


def _written(df: DataFrame, tag: str) -> DataFrame:
    """``df``, written; the shuffle files that it took go at once instead of when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, tag)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def _packed(points: DataFrame) -> DataFrame:
    """Points as (pid, v): the bytes of a number, then the vector, in four bytes a number where none loses by it."""

    def pack(batches):
        for batch in batches:
            rows = []
            for row in batch.column("x").to_numpy(zero_copy_only=False):
                if row is None:
                    raise ValueError("a point has no vector")
                x = np.asarray(row, dtype="float64")
                with np.errstate(over="ignore", invalid="ignore"):
                    short = x.astype("float32")
                rows.append(b"\x04" + short.tobytes() if (short == x).all() else b"\x08" + x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("pid"), pa.array(rows, pa.binary())], ["pid", "v"])

    return points.select("pid", "x").mapInArrow(pack, "pid bigint, v binary")


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    kinds = {(row[0], len(row)) for row in rows}
    if len(kinds) != 1:
        return np.array([np.frombuffer(row, f"f{row[0]}", offset=1) for row in rows], dtype="float64")
    ((size, length),) = kinds
    numbers = np.frombuffer(b"".join(rows), "uint8").reshape(len(rows), length)[:, 1:]
    return np.ascontiguousarray(numbers).view(f"f{size}").astype("float64")


def _distances(x, a, others, b) -> np.ndarray:
    """Distances of the rows ``a`` of x and ``b`` of others, pair by pair."""
    step = max(1, 4_000_000 // max(1, x.shape[1]))
    parts = [np.sqrt(((x[a[i : i + step]] - others[b[i : i + step]]) ** 2).sum(axis=1)) for i in range(0, len(a), step)]
    return np.concatenate(parts) if parts else np.empty(0)


def _nearest(ids, points, other_ids, others, k: int, limit=None):
    """For each point the k nearest others, as rows of (place of the point, nb, dist), by distance and id.

    ``limit`` bounds the distance. Products of matrices tell who can be among them, up to their rounding error;
    only these are measured.
    """
    out = []
    count, width = min(k, len(others)), points.shape[1]
    centre = others.mean(axis=0)
    square = ((others - centre) ** 2).sum(axis=1)
    # half the digits do where no square of a number leaves their range
    kind = np.dtype("float32" if 1e-12 < square.max(initial=0) < 1e24 and np.abs(points - centre).max(initial=0) < 1e12 else "float64")
    right = np.vstack([-2 * (others - centre).T, np.ones(len(others)), square]).astype(kind)
    step = max(1, 500_000 // max(1, len(others)))
    for start in range(0, len(points), step):
        mine = slice(start, start + step)
        block = points[mine] - centre
        own = (block**2).sum(axis=1)
        near = np.column_stack([block, own, np.ones(len(block))]).astype(kind) @ right
        slack = 4 * (width + 8) * np.finfo(kind).eps * (np.sqrt(own) + np.sqrt(square.max(initial=0))) ** 2
        bound = np.full(len(block), np.inf) if limit is None else limit[mine]
        reach = bound**2 * (1 + 1e-12) + slack
        if not np.isfinite(bound).all():
            near[ids[mine, None] == other_ids[None, :]] = np.inf
            reach = np.fmin(reach, np.partition(near, count - 1, axis=1)[:, count - 1] + 2 * slack)
        # what is not a number, here or as the bound, is measured; rounding up keeps the bound
        row, other = np.nonzero(~(near > np.nextafter(reach.astype(kind), kind.type(np.inf))[:, None]))
        apart = ids[mine][row] != other_ids[other]
        row, other = row[apart], other[apart]
        dist = _distances(points[mine], row, others, other)
        kept = np.isfinite(dist) & (dist <= bound[row])
        row, nb, dist = row[kept], other_ids[other[kept]], dist[kept]
        order = np.lexsort((nb, dist, row))
        row, nb, dist = row[order], nb[order], dist[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < count
        out.append((row[first] + start, nb[first], dist[first]))
    return tuple(np.concatenate(part) for part in zip(*out)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _cut(pid, nb, dist, k: int):
    """The k nearest of each pid among distinct pairs, by pid, distance and neighbour."""
    order = np.lexsort((dist, nb, pid))
    pid, nb, dist = pid[order], nb[order], dist[order]
    new = np.ones(len(pid), bool)
    new[1:] = (pid[1:] != pid[:-1]) | (nb[1:] != nb[:-1])
    pid, nb, dist = pid[new], nb[new], dist[new]
    order = np.lexsort((nb, dist, pid))
    pid, nb, dist = pid[order], nb[order], dist[order]
    first = np.arange(len(pid)) - np.searchsorted(pid, pid) < k
    return pid[first], nb[first], dist[first]


def _numbers(column, nobody: int) -> np.ndarray:
    return np.asarray(pc.fill_null(column, nobody))


def _listed(pid, nb, dist, k: int) -> pa.Table:
    """One row for each pid, with its k nearest."""
    pid, nb, dist = _cut(pid, nb, dist, k)
    new = np.ones(len(pid), bool)
    new[1:] = pid[1:] != pid[:-1]
    starts = np.flatnonzero(new)
    ends = pa.array(np.append(starts, len(pid)), pa.int32())
    names = pid[starts]
    return pa.table({
        "pid": pa.array(names, pa.int64(), mask=names == _NO_QUERY),
        "nb": pa.ListArray.from_arrays(ends, pa.array(nb, pa.int64(), mask=nb == _NO_POINT)),
        "dist": pa.ListArray.from_arrays(ends, pa.array(dist, pa.float64())),
    })


def _merged(lists: DataFrame, n: int, k: int) -> DataFrame:
    """Lists of neighbours as one of k for each pid."""

    def merge(table: pa.Table) -> pa.Table:
        pid = np.repeat(_numbers(table["pid"], _NO_QUERY), pc.list_value_length(table["nb"]).to_numpy())
        return _listed(pid, _numbers(pc.list_flatten(table["nb"]), _NO_POINT), pc.list_flatten(table["dist"]).to_numpy(), k)

    bucket = F.pmod(F.xxhash64("pid"), F.lit(max(1, math.ceil(n / MERGE_ROWS)))).alias("_bucket")
    return lists.groupBy(bucket).applyInArrow(merge, _LISTS)


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    found = lists.select("pid", F.posexplode(F.arrays_zip("nb", "dist")).alias("_place", "_n"))
    return found.select("pid", "_n.nb", "_n.dist", (F.col("_place") + 1).alias("rank")).where(F.col("rank") <= k)


def _extent(packed: DataFrame) -> tuple[int, int, np.ndarray]:
    """How many points there are, the bytes of their vectors and the mean."""

    def add(batches):
        n, size, total = 0, 0, 0.0
        for batch in batches:
            if batch.num_rows:
                n, size = n + batch.num_rows, size + pc.sum(pc.binary_length(batch.column("v"))).as_py()
                total = total + _matrix(batch.column("v")).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "size": [size], "total": [total.tolist()]})

    # a row for each task
    parts = packed.mapInArrow(add, "n bigint, size bigint, total array<double>").collect()
    n = sum(r["n"] for r in parts)
    return n, sum(r["size"] for r in parts), np.sum([r["total"] for r in parts], axis=0) / max(1, n)


def _leaves(packed: DataFrame, n: int, mean: np.ndarray, trees: int, leaf_rows: int, seed: int) -> DataFrame:
    """Rows of (pid, tree, leaf); a leaf has at most ``leaf_rows`` points."""
    bits = max(0, math.ceil(math.log2(max(1, n / leaf_rows))) - 1)
    rng = np.random.default_rng(seed)
    axes = np.stack([rng.normal(size=len(mean)) for _ in range(trees * (bits + 1))], axis=1)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = ((_matrix(batch.column("v")) - mean) @ axes).reshape(batch.num_rows, trees, bits + 1)
            code = ((at[:, :, :bits] > 0) << np.arange(bits)).sum(axis=2)
            yield pa.RecordBatch.from_pydict({
                "pid": np.repeat(batch.column("pid").to_numpy(zero_copy_only=False), trees),
                "tree": np.tile(np.arange(trees, dtype="int32"), batch.num_rows),
                "code": code.ravel().astype("int32"), "at": at[:, :, bits].ravel(),
            })

    placed = packed.mapInArrow(place, "pid bigint, tree int, code int, at double")
    ordered = with_line_numbers(placed, ["tree", "code", "at", "pid"], "_number")
    return ordered.select("pid", "tree", F.floor((F.col("_number") - 1) / leaf_rows).alias("leaf"))


def _tried(near: DataFrame, packed: DataFrame, n: int, size: int, wide: int) -> list[DataFrame]:
    """Lists of the neighbours' neighbours, and of those whose neighbour a point is, that are nearer than its known ones."""

    def meet(table: pa.Table) -> pa.Table:
        via, pid, dist, limit = (table[c].to_numpy() for c in ("via", "pid", "dist", "limit"))
        x, asks = _matrix(table["v"]), pc.is_valid(table["known"]).to_numpy()
        u, w = np.flatnonzero(asks), np.flatnonzero(~asks)
        w = w[np.argsort(via[w], kind="stable")]
        low, high = (np.searchsorted(via[w], via[u], side) for side in ("left", "right"))
        lists = table["known"].filter(pa.array(asks))
        length = pc.list_value_length(lists).to_numpy()
        # short lists are filled with the point itself
        known = np.repeat(pid[u, None], max(1, length.max(initial=0)), axis=1)
        known[np.arange(known.shape[1])[None, :] < length[:, None]] = pc.list_flatten(lists).to_numpy()
        met, found = np.zeros(len(u), bool), []
        upto = np.cumsum(high - low)
        start = 0
        while start < len(u):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + 1_000_000, "right")))
            pairs = (high - low)[start:stop]
            a = np.repeat(np.arange(start, stop), pairs)
            b = w[np.arange(len(a)) - np.repeat(np.cumsum(pairs) - pairs, pairs) + low[a]]
            same = pid[u[a]] == pid[b]
            met[a[same]] = True
            d = _distances(x, u[a], x, b)
            nearer = (d <= limit[u[a]]) & ~same
            a, b, d = a[nearer], b[nearer], d[nearer]
            fresh = (known[a] != pid[b][:, None]).all(axis=1)
            found.append((pid[u[a[fresh]]], pid[b[fresh]], d[fresh]))
            start = stop
        # and the other way round
        own = np.full(len(u), np.inf)
        own[high > low] = limit[w[low[high > low]]]
        back = u[~met & (dist[u] <= own)]
        found.append((via[back], pid[back], dist[back]))
        return _listed(*(np.concatenate(part) for part in zip(*found)), wide)

    farthest = F.when(F.size("nb") >= wide, F.element_at("dist", -1)).otherwise(F.lit(float("inf"))).alias("limit")
    known = _written(near.join(packed, "pid").select("pid", "nb", "dist", "v", farthest), "known")
    pair = F.explode(F.arrays_zip("nb", "dist")).alias("_n")
    asking = known.select("pid", "v", "limit", F.col("nb").alias("known"), pair).select(
        F.col("_n.nb").alias("via"), "pid", F.col("_n.dist").alias("dist"), "limit", "v", "known"
    )
    asked = near.select(F.col("pid").alias("via"), farthest, pair).select("via", F.col("_n.nb").alias("pid"), F.col("_n.dist").alias("dist"), "limit")
    buckets = max(1, math.ceil(n / MEET_ROWS))
    passes = min(buckets, max(1, math.ceil(2 * wide * size / PASS_BYTES)))
    bucket = F.pmod(F.xxhash64("via"), F.lit(buckets))
    found = []
    for turn in range(passes):
        mine = bucket % passes == turn
        answers = asked.where(mine).join(packed, "pid").withColumn("known", F.lit(None).cast("array<bigint>"))
        groups = asking.where(mine).unionByName(answers).groupBy(bucket.alias("_bucket"))
        found.append(_written(groups.applyInArrow(meet, _LISTS), "tried"))
    return found


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _blocks(packed: DataFrame, n: int, block_rows: int) -> DataFrame:
    number = F.pmod(F.xxhash64("pid"), F.lit(max(1, math.ceil(n / block_rows)))).cast("int").alias("block")
    return _written(packed.groupBy(number).agg(F.collect_list(F.struct("pid", "v")).alias("rows")), "blocks")


def _compared(asked: DataFrame, known: DataFrame, n: int, k: int) -> DataFrame:
    """Lists of the exact k nearest points of the n queries; both come in written blocks, and each pair is compared once."""

    def compare(batches):
        queries, best = {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                a = batch.column("asked")[i].as_py()
                if a not in queries:
                    rows = batch.column("queries")[i].values
                    queries[a] = _numbers(rows.field("pid"), _NO_QUERY), _matrix(rows.field("v"))
                    best[a] = np.empty(0, int), np.empty(0, int), np.empty(0)
                ids, x = queries[a]
                rows = batch.column("rows")[i].values
                place, _, dist = best[a]
                full = np.bincount(place, minlength=len(ids)) >= k
                limit = np.full(len(ids), np.inf)
                limit[full] = dist[np.searchsorted(place, np.flatnonzero(full), "right") - 1]
                more = _nearest(ids, x, _numbers(rows.field("pid"), _NO_POINT), _matrix(rows.field("v")), k, limit)
                best[a] = _cut(*(np.concatenate(part) for part in zip(best[a], more)), k)
        for a, (place, nb, dist) in best.items():
            yield from _listed(queries[a][0][place], nb, dist, k).to_batches()

    # a task finds k of each of its queries among the points that it reads
    passes = math.ceil(n * (32 + 16 * k) * max(1, len(known.inputFiles())) / PASS_BYTES)
    found = []
    for turn in range(max(1, passes)):
        mine = asked.where(F.col("block") % max(1, passes) == turn).select(F.col("block").alias("asked"), F.col("rows").alias("queries"))
        found.append(_merged(mine.crossJoin(known).mapInArrow(compare, _LISTS), n, k))
    return found[0] if len(found) == 1 else _union([_written(f, "compared") for f in found])


def nearest_neighbours(
    points: DataFrame, k: int, leaf_rows: int = LEAF_ROWS, trees: int = TREES, rounds: int = ROUNDS, seed: int = 42
) -> DataFrame:
    """Rows of (pid, nb, dist, rank): k near points of every point, nearly always its nearest.

    ``points`` has ``pid bigint``, no two alike, and ``x array<double>``. Ties are broken by the neighbour's
    id. With at most ``leaf_rows`` points the result is exact. The search keeps ``SPARE`` more than k of each.
    Some points are compared with all; if too few of their nearest were found, every point is.
    """
    wide = k + SPARE
    packed = materialize(_packed(points.where(F.col("pid").isNotNull())), "points")
    n, size, mean = _extent(packed)
    if not n:
        return _ranked(packed.sparkSession.createDataFrame([], _LISTS), k)
    leaves = _leaves(packed, n, mean, trees, leaf_rows, seed)

    def at_home(table: pa.Table) -> pa.Table:
        ids, x = table["pid"].to_numpy(), _matrix(table["v"])
        place, nb, dist = _nearest(ids, x, ids, x, wide)
        return _listed(ids[place], nb, dist, wide)

    passes = min(trees, max(1, math.ceil(trees * size / PASS_BYTES)))
    grown = [leaves.where(F.col("tree") % passes == turn).join(packed, "pid") for turn in range(passes)]
    found = [_written(_merged(g.groupBy("tree", "leaf").applyInArrow(at_home, _LISTS), n, wide), "near") for g in grown]
    near = found[0] if passes == 1 else _written(_merged(_union(found), n, wide), "near")
    for _ in range(rounds):
        near = _written(_merged(_union([near, *_tried(near, packed, n, size, wide)]), n, wide), "near")
    if n > leaf_rows:
        sample = packed.where(F.pmod(F.xxhash64("pid", F.lit(seed)), F.lit(math.ceil(n / SAMPLE_ROWS))) == 0)
        known = _blocks(packed, n, BLOCK_ROWS)
        exact = _ranked(_compared(_blocks(sample, SAMPLE_ROWS, BLOCK_ROWS), known, SAMPLE_ROWS, k), k)
        share = recall(_ranked(near, k), exact).first()["recall"]
        if share is not None and share < ENOUGH:
            # nothing but the comparison with all points tells who is near in such a table
            near = _written(_compared(known, known, n, k), "near")
    return _ranked(near, k)


def exact_neighbours(queries: DataFrame, points: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of (pid, nb, dist, rank): the exact k nearest points of each query, block by block."""
    packed = [_written(_packed(df), "points") for df in (queries, points)]
    sizes = [df.count() for df in packed]
    asked, known = (_blocks(df, n, block_rows) for df, n in zip(packed, sizes))
    return _ranked(_compared(asked, known, sizes[0], k), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: how many of the exact pairs were found, and their share."""
    hits = exact.select("pid", "nb").join(found.select("pid", "nb", F.lit(1).alias("_hit")), ["pid", "nb"], "left")
    return hits.agg(F.count("*").alias("n_pairs"), F.count("_hit").alias("n_found"), F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))


def smote(
    df: DataFrame, columns: list[str], label: str, keys: list[str], k: int = 5, seed: int = 42,
    leaf_rows: int = LEAF_ROWS, trace: bool = False,
) -> DataFrame:
    """Rows of (label, features…, synthetic): the input and synthetic rows until classes are equal.

    A synthetic row lies between a row and one of its k nearest of the same class, k being at most
    the class size less one. Equal rows are handled as one point with a count: the nearest
    neighbours of a repeated row are its own repeats. A class of one row is left as it is, and so are
    rows without a label. ``trace`` adds the row (``_x``) and the neighbour (``_target``) of a synthetic row.
    """
    x = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counted) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    sizes = {r[label]: r["n"] for r in counted}
    largest = max(sizes.values(), default=0)
    none = [F.lit(None).cast("array<double>").alias(c) for c in ("_x", "_target")] if trace else []
    base = df.select(label, *columns, F.lit(False).alias("synthetic"), *none)
    for value, n in sizes.items():
        near = min(k, min(sizes.values()) - 1)
        if n == largest or near < 1:
            continue
        rows = df.where(F.col(label) == F.lit(value)).select(F.col(label).alias("_class"), *keys, x.alias("x"))
        extra = _synthetic(rows, keys, near, n, largest - n, seed, leaf_rows)
        base = base.unionByName(
            extra.select(
                F.lit(value).alias(label), *[F.col("y")[i].alias(c) for i, c in enumerate(columns)],
                F.lit(True).alias("synthetic"), *([F.col("x").alias("_x"), F.col("target").alias("_target")] if trace else []),
            )
        )
    return base


def _synthetic(rows, keys, k, n, wanted, seed, leaf_rows) -> DataFrame:
    # numbers that are written once, so no two points share one
    points = materialize(
        rows.groupBy("x").agg(F.count("*").alias("copies")).withColumn("pid", F.monotonically_increasing_id()), "points"
    )
    near = nearest_neighbours(points, k, leaf_rows, seed=seed)
    others = near.join(points.select(F.col("pid").alias("nb"), F.col("x").alias("nx"), F.col("copies").alias("nc")), "nb")
    # nearest first, each neighbour as often as it occurs, cut at k
    listed = others.groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "nx", F.least("nc", F.lit(k)).alias("nc")))).alias("l")
    )
    spread = F.flatten(F.transform("l", lambda e: F.array_repeat(e["nx"], e["nc"].cast("int"))))
    own = F.array_repeat("x", F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    known = points.join(listed, "pid", "left").select(
        "pid", F.slice(F.concat(own, F.coalesce(spread, F.array().cast("array<array<double>>"))), 1, k).alias("near")
    )
    # every row is used equally often, and the remainder by hash rank
    every, rest = divmod(wanted, n)
    ranked = assign_by_rank(
        rows.join(points.select("x", "pid"), "x"), "_class", seeded_hash(seed, *keys), {"rest": F.lit(rest)}, "_beyond"
    )
    used = ranked.withColumn("times", F.lit(every) + F.when(F.col("_beyond") == 0, 1).otherwise(0)).where("times > 0")
    copies = used.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    drawn = copies.join(known, "pid").withColumn(
        "target", F.get("near", F.pmod(seeded_hash(seed + 1, *keys, "copy"), F.size("near")).cast("int"))
    ).withColumn("share", seeded_uniform(seed + 2, *keys, "copy"))
    y = F.zip_with("x", "target", lambda p, q: F.struct(p.alias("p"), (q - p).alias("d")))
    return drawn.withColumn("_pd", y).withColumn("y", F.transform("_pd", lambda e: e["p"] + F.col("share") * e["d"]))
