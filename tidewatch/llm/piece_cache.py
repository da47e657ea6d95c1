"""Tokenization of many texts through their repeated pieces.

A text is cut at places where the tokenizers certainly begin anew, each distinct piece is encoded once by the libraries, and the
ids of all texts of a slice are gathered with numpy. The table of known pieces is bounded; a piece it lacks is encoded again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_PIECES = 200_000
TABLE_CHARS = 64

#: The ids of pieces, one after the other, and how many each has.
Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters are themselves, the others follow from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``starts[k] .. starts[k] + counts[k] - 1`` of all k, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def text_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of the batches with at most ``limit`` bytes of text, or one row; only the texts of one part are Python objects at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            part = batch.slice(start, end - start)
            yield part, part.column(text).to_pylist()
            start = end


class Lists:
    """Id lists by number, one after the other; ``put`` adds some."""

    def __init__(self) -> None:
        self.ids, self.n_ids, self.starts, self.counts = np.zeros(1024, np.int32), 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def put(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        total = self.n_ids + len(ids)
        if total > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.n_ids], np.zeros(2 * total - self.n_ids, np.int32)))
        self.ids[self.n_ids : total] = ids
        self.starts = np.concatenate((self.starts, self.n_ids + np.cumsum(sizes) - sizes))
        self.counts, self.n_ids = np.concatenate((self.counts, sizes)), total

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists ``rows`` in order, and how many each has."""
        each = self.counts[rows]
        return self.ids[gather(self.starts[rows], each)], each


class PieceCache:
    """The ids that each of some encoders gives a piece; equal pieces must have equal ids.

    ``sound`` may tell of pieces and what each encoder gave for them which are usable.
    """

    def __init__(self, encoders: list[Encoder], sound: Callable[..., np.ndarray] | None = None, pieces: int = TABLE_PIECES):
        self.encoders, self.sound, self.pieces = encoders, sound, pieces
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.lists = [Lists() for _ in self.encoders]
        self.usable = np.zeros(0, bool)

    def rows(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece, for ``lists`` and ``usable`` until the next call, and the first piece of each list."""
        first = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=first[1:])
        every = list(chain.from_iterable(lists))
        rows = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
        if len(self.usable) > self.pieces:
            rows = self._shrink(rows)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            lacking = [every[k] for k in missing]
            pieces = list(dict.fromkeys(lacking))
            found = [encode(pieces) for encode in self.encoders]
            start = len(self.usable)
            for store, own in zip(self.lists, found, strict=True):
                store.put(*own)
            good = np.ones(len(pieces), bool) if self.sound is None else self.sound(pieces, *found)
            self.usable = np.concatenate((self.usable, good))
            own = {p: k for k, p in enumerate(pieces, start)}
            rows[missing] = np.fromiter(map(own.__getitem__, lacking), np.int64, len(lacking))
            self.known.update(own if max(map(len, pieces)) <= TABLE_CHARS else {p: k for p, k in own.items() if len(p) <= TABLE_CHARS})
        return rows, first

    def _shrink(self, rows: np.ndarray) -> np.ndarray:
        """Keep what the texts at hand use, which are the frequent pieces; their new numbers for ``rows``."""
        kept = np.unique(rows[rows >= 0])
        place = np.full(len(self.usable) + 1, -1)
        place[kept] = np.arange(len(kept))
        self.known = {p: int(place[k]) for p, k in self.known.items() if place[k] >= 0}
        for store in self.lists:
            ids, counts = store.take(kept)
            store.__init__()
            store.put(ids, counts)
        self.usable = self.usable[kept]
        return place[rows]  # -1 stays -1
