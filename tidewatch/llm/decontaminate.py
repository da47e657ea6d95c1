"""Benchmark passages in documents, found through canonical templates, re-parameterised copies included.

Numbers, names and units become typed placeholders. Windows of ``width`` canonical tokens are hash-joined; an item that is
shorter is one window of its own length. Matches on one alignment of item and document (the difference of the token
positions) belong together: their slots must map one item value to one document value and back, and they must cover enough
tokens. Typed windows with fewer than half literal tokens say nothing and are not used.

Beside them windows of the lower-cased tokens as written are joined, whatever they hold, so that verbatim copies are found
in any case and however many numbers and names they have. Evidence is what either kind covers, or both where their slots agree; where
typed slots of the same alignment contradict each other, only a copy of the whole item as written is.
A third kind takes every capitalised token for a name, at the start of a sentence as inside, and a run of names for one placeholder, so
other names in their place change neither the windows nor the alignment; it is aligned and judged apart. All kinds count the positions of
the item that their windows cover.
Items with fewer than ``min_item`` tokens, and items that are numbers and signs only, are not looked for.

Only windows whose hash an item has leave the scan. The item hashes are sent to the tasks in blocks of at most
``BLOCK_HASHES``; a larger benchmark takes more blocks, each a pass over the documents, with the same result.

Defined results: null and empty texts hold no item; null items are skipped; equal items are found each; repeated documents
get equal rows; documents with one id and different texts are told apart by a hash of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import hash_strings, slices, tokens, window_hashes
from tidewatch.session import materialize

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d]\w*|[.!?\n%$€£°]")
ENDS = frozenset(".!?\n")
SIGNS = frozenset("%$€£°")
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres mg g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degrees mph kmh watt watts volt volts".split()
)
BLOCK_HASHES = 2_000_000
#: Kinds of windows.
TYPED, WRITTEN, RUNS = range(3)
NUMBER, UNIT, NAME = hash_strings(np.array(["<number>", "<unit>", "<name>"], dtype=object))


class Reading(NamedTuple):
    """Hashes of the tokens, whether each is a slot, where each text starts, and the first word of each token and of the end."""

    hashes: np.ndarray
    slots: np.ndarray
    starts: np.ndarray
    first: np.ndarray


def readings(texts: list[str | None]) -> tuple[dict[int, Reading], np.ndarray, np.ndarray]:
    """The texts with typed placeholders, as written, and with runs of names, by kind; the tokens as written; whether each is a word."""
    codes, distinct, starts = tokens([TOKEN.findall(t) if t else [] for t in texts])
    if not len(codes):
        nothing = Reading(np.zeros(0, np.uint64), np.zeros(0, bool), starts, np.zeros(1, np.int64))
        return {TYPED: nothing, WRITTEN: nothing, RUNS: nothing}, np.zeros(0, object), np.zeros(0, bool)
    ends = np.array([x in ENDS for x in distinct])
    number = np.array([x[0].isdigit() for x in distinct])
    sign = np.array([x in SIGNS for x in distinct])
    unit = np.array([x.lower() in UNITS for x in distinct])
    capital = np.array([x[0].isupper() for x in distinct])
    written = hash_strings(np.array([x.lower() for x in distinct], dtype=object))[codes]
    hashes = written.copy()
    first = np.zeros(len(codes) + 1, dtype=bool)
    first[starts] = True
    first = first[:-1]
    after = np.roll(codes, 1)
    is_number = number[codes]
    is_unit = sign[codes] | (unit[codes] & np.roll(is_number, 1) & ~first)
    is_name = capital[codes] & ~first & ~ends[after] & ~is_unit
    hashes[is_number], hashes[is_unit], hashes[is_name] = NUMBER, UNIT, NAME
    any_name = capital[codes] & ~is_unit
    runs = hashes.copy()
    runs[any_name] = NAME
    head = ~(any_name & np.roll(any_name, 1) & ~first)
    slots = is_number | is_unit | is_name
    keep = ~ends[codes]
    kept = np.concatenate(([0], np.cumsum(keep)))
    each = np.arange(kept[-1] + 1)
    found = {TYPED: Reading(hashes[keep], slots[keep], kept[starts], each), WRITTEN: Reading(written[keep], slots[keep], kept[starts], each)}
    one = keep & head
    placed = np.concatenate(([0], np.cumsum(one)))
    found[RUNS] = Reading(runs[one], (slots | any_name)[one], placed[starts], np.append(kept[:-1][one], kept[-1]))
    return found, distinct[codes[keep]], ~(number | sign)[codes[keep]]


def _windows(reading: Reading, kind: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of the windows that lie in one text and, with placeholders, are literal enough."""
    starts = reading.starts
    found = window_hashes(reading.hashes, width) + np.uint64(kind)
    at = np.arange(len(found))
    text = np.searchsorted(starts, at, side="right") - 1
    good = at + width <= starts[text + 1]
    if kind != WRITTEN:
        literal = np.concatenate(([0], np.cumsum(~reading.slots)))
        good &= 2 * (literal[at + width] - literal[at]) >= width
    return text[good], at[good], found[good]


def _slot_words(reading: Reading, words: np.ndarray, at: np.ndarray, width: int) -> pa.Array:
    first, slots = reading.first, reading.slots
    return pa.array([[" ".join(words[first[i] : first[i + 1]]) for i in range(a, a + width) if slots[i]] for a in at], pa.list_(pa.string()))


WINDOW_TYPE = pa.schema(
    [
        ("_row", pa.int64()), ("_kind", pa.int32()), ("_width", pa.int32()), ("_at", pa.int64()), ("_hash", pa.int64()), ("_size", pa.int64()),
        ("_length", pa.int64()), ("_from", pa.int64()), ("_to", pa.int64()), ("_slots", pa.list_(pa.string())),
    ]
)


def _item_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            found_readings, words, word = readings(texts)
            rows = batch.column("_row").to_pylist()
            for kind, reading in found_readings.items():
                starts = reading.starts
                sizes, begin = np.diff(starts), reading.first[starts]
                whole = np.diff(begin)
                worded = np.diff(np.concatenate(([0], np.cumsum(word)))[begin]) > 0
                for w in np.unique(np.minimum(sizes, width)):
                    if not w:
                        continue
                    text, at, found = _windows(reading, kind, int(w))
                    mine = (np.minimum(sizes[text], width) == w) & worded[text]
                    text, at, found = text[mine], at[mine], found[mine]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([rows[i] for i in text], pa.int64()), pa.array(np.full(len(at), kind), pa.int32()), pa.array(np.full(len(at), w), pa.int32()),
                            pa.array(at - starts[text], pa.int64()), pa.array(found.view(np.int64)), pa.array(whole[text], pa.int64()),
                            pa.array(sizes[text], pa.int64()), pa.array(reading.first[at] - begin[text], pa.int64()), pa.array(reading.first[at + w] - begin[text], pa.int64()),
                            _slot_words(reading, words, at, int(w)),
                        ],
                        schema=WINDOW_TYPE,
                    )

    return run


def _doc_windows(wanted: dict[tuple[int, int], np.ndarray]):
    """Windows whose hash is among the sorted ``wanted`` of their kind and width; as written, the item tells the slots."""
    bits = np.uint64((1 << 22) - 1)
    filters = {}
    for key, hashes in wanted.items():
        filters[key] = np.zeros(1 << 22, dtype=bool)
        filters[key][hashes & bits] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            found_readings, words, _ = readings(texts)
            for (kind, w), sought in wanted.items():
                reading = found_readings[kind]
                text, at, found = _windows(reading, kind, w)
                may = filters[kind, w][found & bits]
                text, at, found = text[may], at[may], found[may]
                place = np.minimum(np.searchsorted(sought, found), len(sought) - 1)
                hit = sought[place] == found
                text, at, found = text[hit], at[hit], found[hit]
                if len(at):
                    slots = pa.nulls(len(at), pa.list_(pa.string())) if kind == WRITTEN else _slot_words(reading, words, at, w)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("_id").take(pa.array(text)), batch.column("_text_hash").take(pa.array(text)), pa.array(at - reading.starts[text], pa.int64()),
                            pa.array(found.view(np.int64)), slots,
                        ],
                        names=["_id", "_text_hash", "_doc_at", "_hash", "_doc_slots"],
                    )

    return run


def _one_to_one(pairs: str) -> Column:
    n = F.size(pairs)
    return (F.size(F.array_distinct(F.col(f"{pairs}.i"))) == n) & (F.size(F.array_distinct(F.col(f"{pairs}.d"))) == n)


def find_items(
    docs: DataFrame, items: DataFrame, width: int = 8, min_tokens: int = 13, min_share: float = 0.8, min_item: int = 5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(_id, _text_hash, item, n_windows): items whose aligned, slot-consistent windows cover ``min_tokens`` tokens, or the share of a shorter item."""
    own = items.select(F.col(item_col).cast("long").alias("_row"), F.col(item_text).alias("_text")).where("_text IS NOT NULL")
    windows = materialize(own.mapInArrow(_item_windows(width), "_row long, _kind int, _width int, _at long, _hash long, _size long, _length long, _from long, _to long, _slots array<string>").where(F.col("_length") >= min_item), "item-windows")
    slim = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_text_hash"), F.col(text_col).alias("_text")).where("length(_text) > 0")
    distinct = windows.select("_kind", "_width", "_hash").distinct()
    n_blocks = max(1, -(-distinct.count() // BLOCK_HASHES))
    hits = None
    for k in range(n_blocks):
        rows = distinct.where(F.pmod(F.xxhash64("_hash"), F.lit(n_blocks)) == k).toPandas()
        wanted = {(int(kind), int(w)): np.sort(g.to_numpy(np.int64).view(np.uint64)) for (kind, w), g in rows.groupby(["_kind", "_width"])["_hash"]}
        if wanted:
            part = slim.mapInArrow(_doc_windows(wanted), "_id long, _text_hash long, _doc_at long, _hash long, _doc_slots array<string>")
            hits = part if hits is None else hits.unionAll(part)
    if hits is None:
        return docs.sparkSession.createDataFrame([], "_id long, _text_hash long, item long, n_windows long")
    need = F.least(F.lit(min_tokens), F.ceil(F.col("_size") * min_share))
    written = F.col("_kind") == WRITTEN
    aligned = hits.distinct().join(windows, "_hash").withColumn("_shift", F.col("_doc_at") - F.col("_at"))
    aligned = aligned.withColumn("_zip", F.arrays_zip(F.col("_slots").alias("i"), F.when(written, F.col("_slots")).otherwise(F.col("_doc_slots")).alias("d")))
    merged = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    places = F.sequence("_from", F.col("_to") - 1)
    runs = aligned.groupBy("_id", "_text_hash", F.col("_row").alias("item"), (F.col("_kind") == RUNS).alias("_apart"), "_shift").agg(
        F.size(F.collect_set("_at")).cast("long").alias("n_windows"), F.first(need).alias("_need"), F.first("_size").alias("_size"),
        F.size(merged(places)).alias("_n_all"), F.size(merged(F.when(~written, places))).alias("_n_typed"), F.size(merged(F.when(written, places))).alias("_n_written"),
        merged("_zip").alias("_pairs"), merged(F.when(~written, F.col("_zip"))).alias("_typed_pairs"),
    )
    covers = lambda n: F.col(n) >= F.col("_need")
    whole = F.col("_n_written") >= F.col("_size")
    holds = whole | (_one_to_one("_typed_pairs") & (covers("_n_typed") | covers("_n_written"))) | (_one_to_one("_pairs") & covers("_n_all"))
    return runs.where(holds).groupBy("_id", "_text_hash", "item").agg(F.max("n_windows").alias("n_windows"))


def flag(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` and ``_items``: the sorted ids of the items that a document holds."""
    found = find_items(docs, items, id_col=id_col, text_col=text_col, **options).groupBy(F.col("_id").alias("_hit_id"), F.col("_text_hash").alias("_hit_hash")).agg(
        F.sort_array(F.collect_set("item")).alias("_items")
    )
    whole = docs.withColumn("_text_hash", F.xxhash64(text_col))
    joined = whole.join(found, whole[id_col].cast("long").eqNullSafe(found["_hit_id"]) & (whole["_text_hash"] == found["_hit_hash"]), "left")
    return joined.select(*docs.columns, F.coalesce("_items", F.array().cast("array<long>")).alias("_items"))
