"""Similarity join of texts by the Jaccard index of their word n-grams, through MinHash bands.

Documents with equal n-gram sets are a class, and only one of a class is compared. Bands and rows are chosen so that a pair at the
threshold shares a band with at least the target recall. A class that shares a band bucket with others is tied to the
smallest class of the bucket (no pairs are made; the bands are tied in two steps, the second with the names that the first gave), and the connected sets of such ties are the places where links can be. Inside each,
all pairs are verified on the full n-gram sets, in blocks of bounded size, with no pair ever written as a row: a block gives
every class its number of links and one tie. So buckets and groups of any size are complete, beyond the recall of the bands even.

Words are lower-cased runs of letters, digits and underscores. A text with fewer words than ``width`` has one n-gram, all its words.

Defined results: null texts and texts without a word link with nothing. Repeated rows (equal id and text) are one document in all
counts; every row of the input has its row in the result. Different texts of one id are different documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, components, hash_strings, mix, slices, tokens, window_hashes
from tidewatch.session import materialize

BLOCK_GRAMS = 200_000
BLOCK_CLASSES = 256
COLUMN_CHUNK = 4096
#: Bands that are tied first.
FIRST_BANDS = 6


def band_plan(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, whose bands give the recall at the threshold."""
    for rows in range(max_hashes, 0, -1):
        miss = 1 - threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log(miss)) if 0 < miss < 1 else 1
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError(f"{max_hashes} hashes do not give a recall of {recall} at {threshold}")


def gram_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, one text after the other, and where each starts."""
    codes, distinct, starts = tokens([WORD.findall(t.lower()) if t else [] for t in texts])
    words = hash_strings(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = window_hashes(words, width)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    at = np.arange(len(grams))
    inside = at + width <= starts[text[: len(grams)] + 1] if len(grams) else np.zeros(0, bool)
    own, value = text[: len(grams)][inside], grams[inside]
    short = [i for i in np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < width))]
    if short:
        whole = [window_hashes(words[starts[i] : starts[i + 1]], starts[i + 1] - starts[i])[0] ^ np.uint64(starts[i + 1] - starts[i]) for i in short]
        own, value = np.concatenate((own, short)), np.concatenate((value, np.array(whole, np.uint64)))
    order = np.lexsort((value, own))
    own, value = own[order], value[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    own, value = own[first], value[first]
    return value, np.searchsorted(own, np.arange(len(texts) + 1))


def signatures(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, list[bytes | None]]:
    """Band hashes of each text (rows of zeros without n-grams), and a digest of each set."""
    n = len(starts) - 1
    full = np.diff(starts) > 0
    out = np.zeros((n, bands), np.uint64)
    digests: list[bytes | None] = [None] * n
    if not full.any():
        return out, digests
    cuts = starts[:-1][full]
    keys = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for band in range(bands):
        h = np.full(full.sum(), np.uint64(band))
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((values ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint64(1)), cuts)
            h = mix(h * np.uint64(31) + least)
        out[full, band] = h
    one, two = np.add.reduceat(mix(values), cuts), np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), cuts)
    sizes = np.diff(starts)[full].astype(np.uint64)
    packed = np.stack([mix(one + sizes), mix(two ^ sizes)], axis=1).astype(">u8").tobytes()
    for place, i in enumerate(np.flatnonzero(full)):
        digests[i] = packed[16 * place : 16 * place + 16]
    return out, digests


def linked(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i on side 0 and j on side 1, with the threshold reached; all pairs i < j if every set is on side 0."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    own = np.repeat(np.arange(n), sizes)
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    own, value = own[order], value[order]
    cuts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    counts = np.diff(np.append(cuts, len(value)))
    # n-grams of the same sets are one column, with its weight; those of one set alone tell nothing
    marks = mix(np.arange(1, n + 1, dtype=np.uint64))
    kinds, first, weight = np.unique(np.add.reduceat(marks[own], cuts), return_index=True, return_counts=True)
    many = counts[first] > 1
    first, weight = first[many], weight[many]
    both = bool(side.any())
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if both else (np.arange(n), np.arange(n))
    common = np.zeros((len(left), len(right)))
    for k in range(0, len(first), COLUMN_CHUNK):
        some = first[k : k + COLUMN_CHUNK]
        held = np.zeros((n, len(some)), np.float32)
        column = np.repeat(np.arange(len(some)), counts[some])
        at = np.concatenate([np.arange(cuts[c], cuts[c] + counts[c]) for c in some])
        held[own[at], column] = 1
        common += (held[left] * weight[k : k + COLUMN_CHUNK].astype(np.float32)) @ held[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero(common >= threshold * union - 1e-9)
    i, j = left[i], right[j]
    if not both:
        i, j = i[i < j], j[i < j]
    return i, j


def hubs(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected with."""
    name = np.arange(n)
    while True:
        low = np.minimum(name[i], name[j])
        after = name.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == name).all():
            return name
        name = after


def _verify(width: int, threshold: float):
    schema = pa.schema([("class", pa.binary()), ("links", pa.int64()), ("hub", pa.binary())])

    def one(rows: list[dict]) -> pa.RecordBatch | None:
        by_class = {r["class"]: r for r in rows}  # repeated rows of a representative
        rows = [by_class[c] for c in sorted(by_class)]
        values, starts = gram_sets([r["text"] for r in rows], width)
        sets = [values[starts[k] : starts[k + 1]] for k in range(len(rows))]
        cross = rows[0]["p"] != rows[0]["q"]
        side = np.array([int(cross and r["block"] == r["q"]) for r in rows])
        if cross and (side.all() or not side.any()):
            return None
        i, j = linked(sets, side, threshold)
        if not len(i):
            return None
        copies = np.array([r["copies"] for r in rows])
        links = np.bincount(i, weights=copies[j], minlength=len(rows)) + np.bincount(j, weights=copies[i], minlength=len(rows))
        hub = hubs(len(rows), i, j)
        some = np.flatnonzero(links)
        names = [r["class"] for r in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in some], pa.binary()), pa.array(links[some].astype(np.int64)), pa.array([names[hub[k]] for k in some], pa.binary())], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch, texts in slices(batches, "text"):
            for row, text in zip(batch.drop_columns(["text"]).to_pylist(), texts, strict=True):
                own = (row["component"], row["p"], row["q"])
                if own != key and rows:
                    if (out := one(rows)) is not None:
                        yield out
                    rows = []
                key = own
                rows.append(row | {"text": text})
        if rows and (out := one(rows)) is not None:
            yield out

    return run


def _ties(named: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the names (class, name, bands) which share a bucket: of each class a star of its name and the smallest names of its buckets."""
    buckets = named.select("class", "name", F.posexplode("bands").alias("band", "value"))
    tied = buckets.groupBy(F.col("band").alias("_band"), F.col("value").alias("_value")).agg(F.min("name").alias("hub"), F.max("name").alias("_last")).where("hub <> _last")
    held = buckets.join(tied, (F.col("band") == F.col("_band")) & (F.col("value") == F.col("_value"))).where("name <> hub")
    stars = held.groupBy("class", "name").agg(F.collect_set("hub").alias("hubs")).withColumn("hubs", F.array_append("hubs", F.col("name")))  # at most a hub a band
    return stars.select(F.explode("hubs").alias("a"), F.array_min("hubs").alias("b")).where("a <> b")


def similar(
    docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.9999, max_hashes: int = 128, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(_id, _text_hash, class_id, group_id, n_links, kept, n_rows) for each distinct id and text.

    ``class_id`` is the smallest id with the same n-gram set, ``group_id`` the smallest id that links lead to, ``n_links`` the number of
    other documents linked directly, ``kept`` true for one document of each group, and ``n_rows`` how often the row is there.
    """
    bands, rows = band_plan(threshold, recall, max_hashes)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            values, starts = gram_sets(texts, width)
            hashes, digests = signatures(values, starts, bands, rows)
            sizes = np.diff(starts)
            found = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum((sizes > 0) * bands))), pa.int32()), pa.array(hashes[sizes > 0].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_text_hash"), pa.array(sizes), pa.array(digests, pa.binary()), found], names=["_id", "_text_hash", "n", "class", "bands"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"), F.col(text_col).alias("_text"))
    signed = materialize(slim.mapInArrow(sign, f"_id {kind}, _text_hash long, n long, class binary, bands array<long>"), "signed")
    distinct = signed.groupBy("_id", "_text_hash", "class").agg(F.count(F.lit(1)).alias("n_rows"))
    classes = materialize(
        signed.where("class IS NOT NULL").groupBy("class").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("_id", "_text_hash")).alias("first"))
        .join(distinct.where("class IS NOT NULL").groupBy(F.col("class").alias("_class")).agg(F.count(F.lit(1)).alias("copies")), F.col("class") == F.col("_class")).drop("_class"),
        "classes",
    )
    # the first bands name the sets of most classes, so later ones join only buckets that still hold several names
    names = classes.select("class", "bands", F.col("class").alias("name"), F.lit(False).alias("tied"))
    for low, high in ((0, min(FIRST_BANDS, bands)), (FIRST_BANDS, bands)):
        if low < high:
            found = components(_ties(names.select("class", "name", F.slice("bands", low + 1, high - low).alias("bands"))))
            moved = found.select(F.col("node").alias("_name"), "component")
            names = names.join(moved, F.col("name") == F.col("_name"), "left").select("class", "bands", F.coalesce("component", "name").alias("name"), (F.col("tied") | F.col("component").isNotNull()).alias("tied"))
            names = materialize(names, "sets")
    places = names.where("tied").select(F.col("class").alias("node"), F.col("name").alias("component"))
    sized = places.join(classes.select(F.col("class").alias("node"), "n"), "node").groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES)).cast("int").alias("_blocks")
    )
    # the few sets of several blocks; written, so that the join can split or broadcast
    large = materialize(sized.where("_blocks > 1"), "large-sets")
    sets = places.join(large, "component", "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1)))
    members = sets.join(classes.select(F.col("class").alias("node"), "copies", "first"), "node").select(
        F.col("node").alias("class"), "component", "copies", "blocks", F.col("first._id").alias("_first_id"), F.col("first._text_hash").alias("_first_hash"),
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    texts = slim.join(members, slim["_id"].eqNullSafe(members["_first_id"]) & (slim["_text_hash"] == members["_first_hash"]))
    copied = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "class", "block", "copies", F.col("_text").alias("text")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = copied.repartition(parts, "component", "p", "q").sortWithinPartitions("component", "p", "q", "class")
    found = materialize(dealt.mapInArrow(_verify(width, threshold), "class binary, links long, hub binary"), "links")
    groups = components(found.select(F.col("class").alias("a"), F.col("hub").alias("b")))
    counted = found.groupBy(F.col("class").alias("_linked")).agg(F.sum("links").alias("links"))
    # both sides are written, so that the join can split a large group
    grouped = materialize(groups.join(classes.select("class", "first"), F.col("class") == F.col("node")).select("node", "first", F.col("component").alias("group")), "groups")
    heads = materialize(grouped.groupBy(F.col("group").alias("_group")).agg(F.min("first").alias("head")), "heads")
    headed = materialize(grouped.join(heads, F.col("group") == F.col("_group")).select("node", "head"), "groups")
    named = (
        classes.select(F.col("class").alias("_class"), "first", "copies").join(headed, F.col("_class") == F.col("node"), "left").join(counted, F.col("_class") == F.col("_linked"), "left")
        .select("_class", "first", "copies", F.coalesce("head", "first").alias("head"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = materialize(named, "groups")
    whole = distinct.join(named, F.col("class") == F.col("_class"), "left")
    me = F.struct("_id", "_text_hash")
    return whole.select(
        "_id", "_text_hash", F.when(F.col("class").isNull(), F.col("_id")).otherwise(F.col("first._id")).alias("class_id"),
        F.when(F.col("class").isNull(), F.col("_id")).otherwise(F.col("head._id")).alias("group_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"), F.coalesce(me.eqNullSafe(F.col("head")) | F.col("head").isNull(), F.lit(True)).alias("kept"), "n_rows",
    )


def flag(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` and ``_class_id``, ``_group_id``, ``_n_links``, ``_kept``; a repeated row repeats its result."""
    return _joined(docs, similar(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each group, and one row of repeated rows."""
    found = similar(docs, id_col=id_col, text_col=text_col, **options).where("kept")
    kept = _joined(docs, found, id_col, text_col).select(docs.columns)
    if found.where("n_rows > 1").isEmpty():
        return kept
    return kept.dropDuplicates([id_col, text_col])


def _joined(docs: DataFrame, results: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = results.select(
        F.col("_id").alias("_own_id"), F.col("_text_hash").alias("_own_hash"), F.col("class_id").alias("_class_id"), F.col("group_id").alias("_group_id"),
        F.col("n_links").alias("_n_links"), F.col("kept").alias("_kept"),
    )
    whole = docs.withColumn("_hash", F.xxhash64(text_col))
    return whole.join(found, whole[id_col].eqNullSafe(found["_own_id"]) & (whole["_hash"] == found["_own_hash"])).drop("_hash", "_own_id", "_own_hash")
