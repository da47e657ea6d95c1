"""Alignment of two tokenizations of the same bytes by lockstep merging.

All documents of a slice are merged at once: a NumPy state vector holds a pointer into the A and one into the B tokens of each, and a step emits the link
of every pair of current tokens, a cut where both end, and advances the pointer whose token ends first, or both. Documents that are finished are taken
out of the vector. So that one long document does not keep the vector going alone, documents are entered in parts of ``PART_PIECES``
pieces: both tokenizers certainly begin anew before white space that follows another character, so both have an end there.

The tokens are written once. How often an id pair is linked is counted over the corpus (partial sums in the tasks, one shuffle of id pairs), and the documents are merged again to sum the counts. The table of
pairs goes to the tasks if it has at most ``broadcast_pairs`` rows; a larger one is joined with the pairs of the documents, split where a pair is hot.

Defined results: texts that are null or empty, or whose tokens do not give back their bytes (a literal U+2581), have no tokens: all
numbers 0, no groups. Such texts count nowhere. Every row has its result; repeated rows count as often as they are there.
A column of the documents with the name of a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.llm.piece_cache import Encoder, PieceCache, byte_alphabet, flat, gather, text_slices
from tidewatch.session import materialize

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BREAK = "\n"
SPACE = r"\x20\x09-\x0D"
#: A blank or line break after another character begins a piece.
PIECE = re.compile(rf"[ \n][{SPACE}]*[^{SPACE}]*(?:[\t\x0B-\r][{SPACE}]*[^{SPACE}]*)*")
#: White space or its neighbours by some definition, beside the ASCII characters: a text with one of these is not cut.
ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")
#: A blank or line break with more white space behind, or the sign that is used to split.
RUN = re.compile(rf"[ \n][{SPACE}]|[\t\x0B-\r\x00]")
PART_PIECES = 64
SLICE_CHARS = 1_000_000
#: How ids are stored between the passes, and how many of one side are merged at once.
ID = np.dtype("<u2")
BATCH_IDS = 300_000
_models: dict[tuple[str, str], Both] = {}
#: How the byte-level vocabulary cuts a text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Side:
    """One tokenizer: the ids of pieces, the bytes of ids, and whether it begins anew at each piece."""

    def __init__(self, encode: Encoder, surface: list[bytes], splits: bool = True):
        self.encode, self.surface, self.splits = encode, surface, splits
        self.sizes = np.array([len(s) for s in surface], np.int64)
        if len(surface) > np.iinfo(ID).max + 1:
            raise ValueError(f"more than {np.iinfo(ID).max + 1} ids")

    def names(self, mark: str) -> np.ndarray:
        """All ids as text, with ``mark`` behind."""
        return np.array([f"{i}{mark}" for i in range(len(self.surface))], object)


def byte_side(path: str) -> Side:
    """A byte-level vocabulary. Its merges are in the order of the ids they make, so ids are ranks and special strings plain text."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()}
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(made[:-1], made[1:], strict=True)) or sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("the merges are not in the order of their ids")
    coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Side(lambda pieces: flat([coder.encode_ordinary(p) for p in pieces]), [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])])


def piece_side(path: str) -> Side:
    """Its library puts a space before each text; a line break, which no piece holds, takes that space and goes with it."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    surface = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
    normal = [p.replace(MARK, " ") for i, p in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    before = model.encode(BREAK)
    if len(before) != 2 or any(BREAK in p for p in normal):
        raise ValueError("the model has pieces with line breaks")

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat([x[len(before) :] for x in model.encode([BREAK + p for p in pieces], num_threads=1)])

    return Side(encode, surface, not any(re.search(rf"[^{SPACE}] ", p) for p in normal))


class Both:
    """Two tokenizers and the pieces they know."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b, self.splits = a, b, a.splits and b.splits
        self.cache = PieceCache([a.encode, b.encode], self._given_back)
        self.names = {(side, mark): own.names(mark) for side, own, marks in (("a", a, ",|"), ("b", b, ",;")) for mark in marks}


    def _given_back(self, pieces: list[str], *found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Whether the tokens of either side have the bytes of a piece."""
        raw = [p.encode() for p in pieces]
        whole, lengths = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
        good = np.ones(len(pieces), bool)
        for side, (ids, sizes) in zip((self.a, self.b), found, strict=True):
            own = list(map(side.surface.__getitem__, ids.tolist()))
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            equal = lengths == np.diff(np.concatenate(([0], np.cumsum(side.sizes[ids])))[bounds])
            if not equal.all() or b"".join(own) != whole:  # few slices come here
                equal = np.array([b"".join(own[x:y]) == r for x, y, r in zip(bounds[:-1], bounds[1:], raw, strict=True)], bool)
            good &= equal
        return good


def models(byte_path: str, piece_path: str) -> Both:
    """Both tokenizers of this process."""
    if (byte_path, piece_path) not in _models:
        _models.clear()
        _models[byte_path, piece_path] = Both(byte_side(byte_path), piece_side(piece_path))
    return _models[byte_path, piece_path]


def pieces_of(text: str | None, splits: bool) -> list[str]:
    """The pieces of a text with a space before it."""
    if not text:
        return []
    text = " " + text
    if not splits or ODD.search(text):
        return [text]
    return PIECE.findall(text) if RUN.search(text) else text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray, stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and, for each token, whether a group ends with it.

    ``end_a`` and ``end_b`` are the byte ends of all tokens, both counted from the same place; each part has its first A and B token and
    the A token after its last.
    """
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    a, b, stop = begin_a.copy(), begin_b.copy(), stop_a
    some = a < stop
    a, b, stop = a[some], b[some], stop[some]
    left, right = [], []
    while len(a):
        left.append(a)
        right.append(b)
        ends, other = end_a[a], end_b[b]
        both = ends == other
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a = a + (ends <= other)
        b = b + (other <= ends)
        if (open_ := a < stop).all():
            continue
        a, b, stop = a[open_], b[open_], stop[open_]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), cut_a, cut_b


def tokenized(texts: list[str | None], both: Both) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For either side the ids of all texts and where each text's start; for both where the parts of the texts start, and the first part of each text."""
    rows, first = both.cache.rows([pieces_of(t, both.splits) for t in texts])
    usable = both.cache.usable[rows]
    if not usable.all():  # a text with a piece that its tokens do not give back has none
        bad = np.diff(np.concatenate(([0], np.cumsum(~usable)))[first]) > 0
        sizes = np.diff(first)
        rows = rows[~np.repeat(bad, sizes)]
        first = np.concatenate(([0], np.cumsum(np.where(bad, 0, sizes))))
    n_parts = -(-np.diff(first) // PART_PIECES)
    parts = gather(np.zeros(len(first) - 1, np.int64), n_parts) * PART_PIECES + np.repeat(first[:-1], n_parts)
    ids, bounds = zip(*(x.take(rows) for x in both.cache.lists), strict=True)
    bounds = [np.concatenate(([0], np.cumsum(e))) for e in bounds]
    return list(ids), [np.stack([b[parts] for b in bounds]), np.stack([b[first] for b in bounds])], np.concatenate(([0], np.cumsum(n_parts)))


class Merged:
    """The tokens of some texts, their links and groups; ``first_a`` and ``first_b`` say where each text's tokens start."""

    def __init__(self, ids: list[np.ndarray], parts: np.ndarray, first: np.ndarray, both: Both):
        self.both, (self.a, self.b), (self.first_a, self.first_b) = both, ids, first
        begin_a, begin_b = parts
        end_a, end_b = np.cumsum(both.a.sizes[self.a]), np.cumsum(both.b.sizes[self.b])
        self.left, self.right, self.cut_a, self.cut_b = lockstep(end_a, end_b, begin_a, begin_b, np.append(begin_a[1:], len(self.a))[: len(begin_a)])

    @classmethod
    def of(cls, texts: list[str | None], both: Both) -> Merged:
        ids, (parts, first), _ = tokenized(texts, both)
        return cls(ids, parts, first, both)

    @classmethod
    def stored(cls, batch: pa.RecordBatch, both: Both) -> Merged:
        """From the columns that ``tokenize`` adds."""
        ids, first = [], []
        for side in "ab":
            column = batch.column(f"_{side}")
            raw = column.to_pylist()
            ids.append(np.frombuffer(b"".join(raw), ID))
            first.append(np.concatenate(([0], np.cumsum([len(x) for x in raw], dtype=np.int64) // ID.itemsize)))
        inside = [batch.column(f"_parts_{side}") for side in "ab"]
        n_parts = inside[0].value_lengths().to_numpy()
        parts = [np.repeat(own[:-1], n_parts) + x.flatten().to_numpy() for own, x in zip(first, inside, strict=True)]
        return cls(ids, np.stack(parts), np.stack(first), both)

    def pairs(self) -> np.ndarray:
        """The id pair of each link as one number."""
        return self.a[self.left].astype(np.int64) << 32 | self.b[self.right].astype(np.int64)

    def per_text(self, link_values: np.ndarray | None = None) -> np.ndarray:
        """The number of links of each text, or the sum of ``link_values`` over them."""
        text = np.searchsorted(self.first_a, self.left, side="right") - 1
        n = len(self.first_a) - 1
        if link_values is None:
            return np.bincount(text, minlength=n)
        out = np.zeros(n, np.int64)
        np.add.at(out, text, link_values)
        return out

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """The number of groups of each text, and the texts ``a1,a2|b1;a3|b2,b3``."""
        counted = np.concatenate(([0], np.cumsum(self.cut_a)))
        n_groups = counted[self.first_a[1:]] - counted[self.first_a[:-1]]
        group_a, group_b = counted[:-1], np.cumsum(self.cut_b) - self.cut_b
        until_a, until_b = np.concatenate(([0], np.flatnonzero(self.cut_a) + 1)), np.concatenate(([0], np.flatnonzero(self.cut_b) + 1))
        at_a, at_b = np.arange(len(self.a)) + until_b[group_a], np.arange(len(self.b)) + until_a[group_b + 1] if len(self.b) else group_b
        out = np.empty(len(self.a) + len(self.b), object)
        for side, ids, at, cut, end in (("a", self.a, at_a, self.cut_a, "|"), ("b", self.b, at_b, self.cut_b, ";")):
            out[at[~cut]], out[at[cut]] = self.both.names[side, ","][ids[~cut]], self.both.names[side, end][ids[cut]]
        bounds = (self.first_a + self.first_b).tolist()
        return n_groups, ["".join(out[x:y].tolist())[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def tokenize(docs: DataFrame, byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the ids of both sides (``_a``, ``_b``, little-endian) and where in them each part starts (``_parts_a``, ``_parts_b``)."""
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("_a binary, _b binary, _parts_a array<int>, _parts_b array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = models(byte_path, piece_path)
        for batch, texts in text_slices(batches, text_col, SLICE_CHARS):
            ids, (parts, first), first_part = tokenized(texts, both)
            raw, inside = [], []
            for own, part, start in zip(ids, parts, first, strict=True):
                own = own.astype(ID)
                raw.append(pa.array([own[x:y].tobytes() for x, y in zip(start[:-1], start[1:], strict=True)], pa.binary()))
                inside.append(pa.ListArray.from_arrays(pa.array(first_part, pa.int32()), pa.array(part - np.repeat(start[:-1], np.diff(first_part)), pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *raw, *inside], names=schema.names)

    return docs.mapInArrow(run, schema)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with at most ``BATCH_IDS`` ids of the A side, or one row."""
    for batch in batches:
        if batch.num_rows:
            sizes = np.cumsum(pc.binary_length(batch.column("_a")).to_numpy() // ID.itemsize)
            cuts = np.flatnonzero(np.diff(sizes // BATCH_IDS, prepend=-1))
            for x, y in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                yield batch.slice(x, y - x)


def pair_counts(tokens: DataFrame, byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL) -> DataFrame:
    """(pair, n, best): how many links of all texts hold an A id (upper half of ``pair``) and a B id, and whether no A id is linked with the B id more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = models(byte_path, piece_path)
        for batch in _batches(batches):
            pair, n = np.unique(Merged.stored(batch, both).pairs(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    found = tokens.select("_a", "_b", "_parts_a", "_parts_b").mapInArrow(run, "pair long, n long")
    totals = materialize(found.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = totals.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))
    return materialize(totals.join(most, b_id == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "pairs")


NUMBERS = "_n_a long, _n_b long, _n_groups long, _n_links long"
SUMS = "_n_best long, _count_sum long"


def align(
    docs: DataFrame, byte_path: str = BYTE_MODEL, piece_path: str = PIECE_MODEL, text_col: str = "text", keep_text: bool = True, groups: bool = False, broadcast_pairs: int = 2_000_000
) -> DataFrame:
    """All columns of ``docs``, the numbers of tokens, groups and links, ``_n_best``, ``_count_sum`` and ``_groups_sha256``; with ``groups`` also ``_groups``.

    The tokens are written once for the two passes over them; without ``keep_text`` the text is not, and is left out of the result.
    """
    spark = docs.sparkSession
    results = StructType.fromDDL(f"{NUMBERS}, {SUMS}, _groups_sha256 string" + ", _groups string" * groups)
    kept = [c for c in docs.columns if c not in results.names and (keep_text or c != text_col)]
    # columns travel in a struct, so that no name of theirs meets one of the tokens
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(text_col).alias("_text"))
    tokens = materialize(tokenize(packed, byte_path, piece_path, "_text").drop("_text").withColumn("_place", F.monotonically_increasing_id()), "tokens")
    totals = pair_counts(tokens, byte_path, piece_path)
    small = totals.count() <= broadcast_pairs
    shared = None
    if small:
        table = totals.toArrow().sort_by("pair")
        shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))
    names = results.names if small else [c for c in results.names if c not in ("_n_best", "_count_sum")]
    front = ["_row", "_place"]
    schema = StructType([*[tokens.schema[c] for c in front], *[results[c] for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = models(byte_path, piece_path)
        for batch in _batches(batches):
            merged = Merged.stored(batch, both)
            n_groups, texts = merged.groups()
            columns = [np.diff(merged.first_a), np.diff(merged.first_b), n_groups, merged.per_text()]
            if shared is not None:
                pair, n, best = shared.value
                own, at = np.unique(merged.pairs(), return_inverse=True)
                own = np.searchsorted(pair, own)
                columns += [merged.per_text(best[own].astype(np.int64)[at]), merged.per_text(n[own][at])]
            more = [pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in texts]), *([pa.array(texts)] * groups)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in front], *[pa.array(c, pa.int64()) for c in columns], *more], names=schema.names)

    out = tokens.mapInArrow(run, schema)
    if not small:
        sums = _sums(tokens, totals, byte_path, piece_path)
        out = out.join(sums, F.col("_place") == F.col("_at"), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_n_best", "_count_sum")})
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], *results.names)


def _sums(tokens: DataFrame, totals: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(_at, _n_best, _count_sum) of each row with links, through a join of its pairs with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = models(byte_path, piece_path)
        for batch in _batches(batches):
            merged = Merged.stored(batch, both)
            text = np.searchsorted(merged.first_a, merged.left, side="right") - 1
            order = np.lexsort((pair := merged.pairs(), text))
            text, pair = text[order], pair[order]
            new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])))) if len(text) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_place").take(pa.array(text[new])), pa.array(pair[new]), pa.array(np.diff(np.append(new, len(text))))], names=["_at", "pair", "times"])

    pairs = tokens.mapInArrow(run, "_at long, pair long, times long")
    return pairs.join(totals, "pair").groupBy("_at").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_n_best"), F.sum(F.col("times") * F.col("n")).alias("_count_sum"))
