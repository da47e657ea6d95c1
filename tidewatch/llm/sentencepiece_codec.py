"""SentencePiece encoding by streaming Viterbi, and exact decoding.

The pieces and scores of a model file give the segmentation with the highest sum of scores. The search keeps backpointers only
from the last committed boundary on: whenever all boundaries that a later piece can still start from lead back to one boundary,
the ids before it are final, are given out, and the memory before it is freed. Memory beside the ids is bounded by the
longest piece and the longest stretch of ambiguous text.

Where no piece of the vocabulary crosses a kind of boundary (a space after another character, a line break), all paths meet
there for certain. Stretches between such places are encoded once and kept in a bounded table, as words repeat.

A space stands for the mark U+2581 of the pieces; characters without a piece become byte pieces (a literal U+2581 too, so that
decoding is exact) or, without those, the unknown id. A space goes before the text if the model says so (``prefix``).

Defined results: null text has null ids, an empty text none. Decoding gives back the text for every vocabulary with byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, widened

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score
TABLE_ENTRIES = 200_000
NEVER = float("-inf")
_codecs: dict[str, Codec] = {}


class Codec:
    """``pieces``: (piece, score, kind) by id; kind is ``normal``, ``byte``, ``unknown`` or ``other``."""

    def __init__(self, pieces: list[tuple[str, float, str]], prefix: bool = True):
        self.prefix = prefix
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        normal = [(p.replace(MARK, " "), s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "normal"]
        self.longest = max((len(p) for p, _, _ in normal), default=1)
        self.unknown_score = min((s for _, s, _ in normal), default=0.0) - UNKNOWN_PENALTY
        self.trie: dict[str, tuple[dict, float, int]] = {}  # by character: what follows, score and id of the piece that ends here, or -1
        for p, s, i in sorted(normal):
            node = self.trie
            for c in p[:-1]:
                node = node.setdefault(c, ({}, 0.0, -1))[0]
            node[p[-1]] = (node[p[-1]][0] if p[-1] in node else {}, s, i)
        self.surface = [p.replace(MARK, " ").encode() if kind == "normal" else bytes([int(p[1:-1], 16)]) if kind == "byte" else b"" for p, _, kind in pieces]
        if not self.byte_ids:
            self.surface[self.unknown] = " ⁇ ".encode()
        long = [p for p, _, _ in normal if len(p) > 1]
        spaces = not any(" " in p.lstrip(" ") for p in long)
        breaks = not any("\n" in p for p in long)
        self.cut = {(True, True): r"\n| +[^ \n]*|[^ \n]+", (True, False): r" +[^ ]*|[^ ]+", (False, True): r"\n|[^\n]+"}.get((spaces, breaks))
        self.cut = re.compile(self.cut) if self.cut else None
        self.table: dict[str, list[int]] = {}
        self.aged: dict[str, list[int]] = {}

    def _spelled(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Runs of final ids, each given out as soon as all surviving paths agree on its end."""
        n, longest, trie, unknown_score = len(text), self.longest, self.trie, self.unknown_score
        done = 0  # all before is committed; the lists hold the boundaries from here on, as far as a piece may reach
        room = min(n, 5 * longest) + 1
        best, begin, piece = [NEVER] * room, [0] * room, [-1] * room  # score of a boundary; start and id of the piece before it
        best[0] = 0.0
        check = 4 * longest
        for i in range(n):
            at = i - done
            score = best[at]
            if score != NEVER:
                node, j, single = trie, at, False
                for char in text[i : i + longest]:
                    found = node.get(char)
                    if found is None:
                        break
                    j += 1
                    node, value, own = found
                    if own >= 0:
                        value += score
                        if value > best[j]:
                            best[j], begin[j], piece[j] = value, i, own
                        if j == at + 1:
                            single = True
                if not single and score + unknown_score > best[at + 1]:
                    best[at + 1], begin[at + 1], piece[at + 1] = score + unknown_score, i, -1
            if at >= check:
                # the boundaries after this place that pieces reach so far: every later path goes through one of them
                alive = {k + done for k in range(at + 1, min(at + 1 + longest, len(best))) if best[k] != NEVER}
                while len(alive) > 1:
                    last = max(alive)
                    alive.discard(last)
                    alive.add(begin[last - done])
                meet = alive.pop()
                if meet > done:
                    yield self._trace(text, begin, piece, done, meet)
                    best, begin, piece, done = best[meet - done :], begin[meet - done :], piece[meet - done :], meet
                check = max(4 * longest, i + 1 - done + longest)
                more = min(n - done, check + longest + 1) + 1 - len(best)
                best, begin, piece = best + [NEVER] * more, begin + [0] * more, piece + [-1] * more
        if n > done:
            yield self._trace(text, begin, piece, done, n)

    def _trace(self, text: str, begin: list[int], piece: list[int], done: int, end: int) -> list[int]:
        out: list[int] = []
        while end > done:
            start, own = begin[end - done], piece[end - done]
            if own >= 0:
                out.append(own)
            else:
                out += reversed(self._spelled(text[start:end]))
            end = start
        out.reverse()
        return out

    def _learn(self, stretch: str) -> list[int]:
        ids = self.aged.get(stretch) or [i for run in self.stream(stretch) for i in run]
        if len(stretch) <= 64:
            if len(self.table) >= TABLE_ENTRIES:
                self.table, self.aged = {}, self.table
            self.table[stretch] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = " " + text if self.prefix else text
        if self.cut is None:
            return [i for run in self.stream(text) for i in run]
        ids: list[int] = []
        for stretch in self.cut.findall(text):
            ids += self.table.get(stretch) or self._learn(stretch)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def read_model(path: str = MODEL) -> tuple[list[tuple[str, float, str]], bool]:
    """The pieces of a model file, and whether a space goes before a text. Its normalization must be the identity."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else "other" if model.is_control(i) or model.is_unused(i) else "normal"
    n = model.get_piece_size()
    first = model.encode("a", out_type=str)
    return list(zip([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], [kind(i) for i in range(n)], strict=True)), "".join(first).startswith(MARK)


def _broadcast(spark: SparkSession, path: str):
    """The model for the tasks: a file of bounded size, read on the driver once."""
    pieces, prefix = read_model(path)
    key = hashlib.sha256(repr((pieces, prefix)).encode()).hexdigest()
    return spark.sparkContext.broadcast((key, pieces, prefix))


def _codec(shared) -> Codec:
    """The codec of this process, with its table of known words."""
    key, pieces, prefix = shared.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(pieces, prefix)
    return _codecs[key]


def _lists(lists: list[list[int] | None]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x or ()) for x in lists], out=offsets[1:])
    flat = np.fromiter((i for x in lists if x for i in x), dtype=np.int32, count=int(offsets[-1]))
    empty = pa.array([x is None for x in lists])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=empty)


def encode(docs: DataFrame, path: str = MODEL, text_col: str = "text", check: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``_ids``; with ``check`` also ``_exact``: whether decoding gives back the text."""
    shared = _broadcast(docs.sparkSession, path)
    names = docs.columns
    schema = widened(docs.schema.fields, "_ids array<int>" + ", _exact boolean" * check)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch, texts in slices(batches, text_col):
            ids = [None if t is None else codec.encode(t) for t in texts]
            more = [_lists(ids)]
            if check:
                more.append(pa.array([None if t is None else codec.decode(x) == t for t, x in zip(texts, ids, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*names, "_ids", *["_exact"] * check])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str = MODEL, ids_col: str = "_ids") -> DataFrame:
    """All columns of ``docs`` and ``_decoded``."""
    shared = _broadcast(docs.sparkSession, path)
    names = docs.columns
    schema = widened(docs.schema.fields, "_decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [None if x is None else codec.decode(x) for x in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, "_decoded"])

    return docs.mapInArrow(run, schema)


def id_counts(encoded: DataFrame, ids_col: str = "_ids") -> DataFrame:
    """How often each id occurs; a null id list has none."""
    return encoded.select(F.explode(ids_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
