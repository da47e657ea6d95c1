"""Masked pseudo-likelihood of documents under a bidirectional window network, trained in numpy by the executors.

Every token is predicted from the ``REACH`` tokens on either side (the ends of a text are a symbol of their own): embeddings by
place are added, pass a tanh, and a two-level softmax gives the probability of the token's block of words and of the word in the
block. A document's score is the sum of these conditional log-probabilities over all its tokens.

Words are the ``words - buckets`` most frequent of the whole corpus; all others share ``buckets`` symbols by hash.
Training goes over all positions of all documents: in each round every task trains a copy of the network on its documents, one
position in ``stride`` (another share each round, so ``rounds`` of them take every position), and the copies are averaged,
weighted by their positions. What is shuffled grows with the
corpus; what reaches the driver is the vocabulary and one network.

Defined results: null texts and texts without a word have no tokens and score 0. Equal texts have equal scores up to rounding. A
corpus without a word leaves an untrained network over the shared symbols.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, hash_strings, mix, slices, tokens
from tidewatch.session import materialize

REACH = 2
BLOCK_WORDS = 64
HIDDEN = 24
CHUNK = 8192
#: A task's steps grow from the first to the second number of positions, by its positions so far.
STEP_POSITIONS = 1024, 4096
SCORE_POSITIONS = 1 << 14
COUNT_FLUSH = 300_000
#: Logits that are certainly smaller, of either sign, are not shifted before exp.
SAFE_LOGIT = 60


@dataclass
class Network:
    """Parameters: ``into`` by place and word, ``bias``, ``to_block``, ``block_bias``, ``to_word`` and ``word_bias`` by block."""

    into: np.ndarray = field(repr=False)
    bias: np.ndarray = field(repr=False)
    to_block: np.ndarray = field(repr=False)
    block_bias: np.ndarray = field(repr=False)
    to_word: np.ndarray = field(repr=False)
    word_bias: np.ndarray = field(repr=False)

    def arrays(self) -> list[np.ndarray]:
        return [self.into, self.bias, self.to_block, self.block_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Network(*out)

    def hidden(self, around: list[np.ndarray]) -> np.ndarray:
        """A row for each position, of the symbols at each place around it, and a last column of ones for the biases."""
        h = np.take(self.into[0], around[0], axis=0)
        for of_place, symbols in zip(self.into[1:], around[1:]):
            h += np.take(of_place, symbols, axis=0)
        h += self.bias
        out = np.ones((len(h), HIDDEN + 1), np.float32)
        out[:, :-1] = _tanh(h)
        return out

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, cuts = _by_block(target, len(self.word_bias))  # tokens of a block side by side
        target = target[order]
        h = self.hidden(_by_place(around, order))
        room = _room(len(target), len(cuts) - 1)
        found = 0
        for weights, own, wanted in (
            (_with_bias(self.to_block, self.block_bias)[None], np.array([0, len(target)]), target // BLOCK_WORDS),
            (_with_bias(self.to_word, self.word_bias), cuts, target % BLOCK_WORDS),
        ):
            e = Exponentials(h, weights, own, wanted, room)
            found = found + e.logit - np.log(e.total)
        out = np.empty(len(target))
        out[order] = found
        return out


def _by_block(target: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    block = (target // BLOCK_WORDS).astype(np.uint16)
    return np.argsort(block, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(block, minlength=blocks))))


def _by_place(around: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """The symbols at each place, side by side and as numpy takes them without a copy."""
    return [np.take(symbols, order).astype(np.intp) for symbols in around.T]


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The bias as a last row of the weights."""
    return np.concatenate((weights, bias[..., None, :]), axis=-2)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place, as 1 - 2 / (exp(2x) + 1), which takes half the time of numpy's; exp is kept finite."""
    np.minimum(x, 40, out=x)
    x += x
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def _room(n: int, blocks: int) -> np.ndarray:
    """Memory for the logits of ``n`` positions, taken once for all of them."""
    return np.empty(n * max(blocks, BLOCK_WORDS), np.float32)


class Exponentials:
    """exp of the logits of positions that ``cuts`` deals to the matrices of ``weights``, all in ``room``.

    ``parts`` are (matrix, its positions, a row for each class and a column for each position), so sums over classes go along whole rows;
    ``total`` are these sums, ``place`` is where the target is in ``flat``, ``logit`` what it was there.
    """

    def __init__(self, h: np.ndarray, weights: np.ndarray, cuts: np.ndarray, target: np.ndarray, room: np.ndarray):
        n, classes, sizes = len(h), weights.shape[2], np.diff(cuts)
        self.flat = room[: n * classes]
        self.parts = [(b, slice(cuts[b], cuts[b + 1]), self.flat[cuts[b] * classes : cuts[b + 1] * classes].reshape(classes, -1)) for b in np.flatnonzero(sizes)]
        wide = not np.abs(weights).sum(axis=1).max() < SAFE_LOGIT  # units are at most 1
        for b, own, z in self.parts:
            np.matmul(weights[b].T, h[own].T, out=z)
            if wide:
                z -= z.max(axis=0)
        first = np.repeat(cuts[:-1], sizes)
        self.place = first * (classes - 1) + target * np.repeat(sizes, sizes) + np.arange(n)
        self.logit = self.flat[self.place]
        np.exp(self.flat, out=self.flat)
        self.total, ones = np.empty(n, np.float32), np.ones(classes, np.float32)
        for _, own, z in self.parts:
            np.matmul(ones, z, out=self.total[own])

    def errors(self) -> list[tuple[int, slice, np.ndarray]]:
        """The parts as probabilities, less 1 for the target."""
        share = 1 / self.total
        for _, own, z in self.parts:
            z *= share[own]
        self.flat[self.place] -= 1
        return self.parts


def first_network(counts: np.ndarray, seed: int = 3) -> Network:
    """Small random embeddings; the biases are the frequencies of the corpus."""
    rng = np.random.default_rng(seed)
    blocks = len(counts) // BLOCK_WORDS
    by_block = counts.reshape(blocks, BLOCK_WORDS) + 0.5
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    share = by_block.sum(axis=1)
    return Network(
        small(2 * REACH, len(counts) + 1, HIDDEN), np.zeros(HIDDEN, np.float32), small(HIDDEN, blocks), np.log(share / share.sum()).astype(np.float32),
        small(blocks, HIDDEN, BLOCK_WORDS), np.log(by_block / share[:, None]).astype(np.float32),
    )


class Trainer:
    """Adagrad on copies of the parameters; only the rows that a step touches change."""

    def __init__(self, start: Network, rate: float = 0.1):
        self.net = net = start.like(start.flat())
        self.rate = rate
        self.blocks, self.words = _with_bias(net.to_block, net.block_bias), _with_bias(net.to_word, net.word_bias)
        net.to_block, net.block_bias, net.to_word, net.word_bias = self.blocks[:-1], self.blocks[-1], self.words[:, :-1], self.words[:, -1]
        self.dense = [net.bias, self.blocks, self.words]
        self.sums = [np.full(a.shape, 1e-2, np.float32) for a in (net.into[:, :, 0], *self.dense)]
        self.seen, self.room = 0, _room(0, 0)

    def next_step(self) -> int:
        least, most = STEP_POSITIONS
        return min(most, least * (1 + self.seen // (16 * least)))

    def step(self, around: np.ndarray, target: np.ndarray) -> None:
        net, n, blocks = self.net, len(target), len(self.words)
        if len(self.room) < n * max(blocks, BLOCK_WORDS):
            self.room = _room(n, blocks)
        order, cuts = _by_block(target, blocks)
        around, target = _by_place(around, order), target[order]
        h = net.hidden(around)
        ((_, _, g),) = Exponentials(h, self.blocks[None], np.array([0, n]), target // BLOCK_WORDS, self.room).errors()
        dh, of_blocks = g.T @ net.to_block.T, h.T @ g.T
        of_word, of_words = np.empty_like(dh), np.zeros_like(self.words)
        for b, own, e in Exponentials(h, self.words, cuts, target % BLOCK_WORDS, self.room).errors():
            np.matmul(e.T, net.to_word[b].T, out=of_word[own])
            np.matmul(h[own].T, e.T, out=of_words[b])
        dh += of_word
        h = h[:, :-1]
        dh *= 1 - h * h
        for values, sums, grad in zip(self.dense, self.sums[1:], (dh.sum(axis=0), of_blocks, of_words)):
            grad /= n
            sums += grad * grad
            values -= self.rate * grad / np.sqrt(sums)
        of_unit = dh.T.astype(np.float64, order="C")
        for into, sums, symbols in zip(net.into, self.sums[0], around):  # symbols that are not there have a gradient of 0 and do not change
            grad = np.empty_like(into)
            for k, unit in enumerate(of_unit):
                grad[:, k] = np.bincount(symbols, unit, len(into))
            grad /= n
            sums += np.einsum("ij,ij->i", grad, grad) / HIDDEN
            grad *= (self.rate / np.sqrt(sums))[:, None]
            into -= grad
        self.seen += n


@dataclass
class Vocabulary:
    words: list[str]
    buckets: int

    def codes(self, distinct: np.ndarray) -> np.ndarray:
        index = {w: i for i, w in enumerate(self.words)}
        out = np.fromiter((index.get(w, -1) for w in distinct), np.int64, len(distinct))
        rest = out < 0
        out[rest] = len(self.words) + (hash_strings(distinct[rest]) % np.uint64(self.buckets)).astype(np.int64)
        return out

    @property
    def size(self) -> int:
        return len(self.words) + self.buckets

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all tokens, and where each text starts."""
        codes, distinct, starts = tokens([WORD.findall(t.lower()) if t else [] for t in texts])
        return (self.codes(distinct)[codes] if len(codes) else np.zeros(0, np.int64)), starts


def contexts(target: np.ndarray, starts: np.ndarray, size: int, take: np.ndarray | None = None) -> np.ndarray:
    """The symbols around the tokens (those at ``take``); ``size`` stands for the ends of a text."""
    n = len(starts) - 1
    at = np.arange(len(target)) + REACH * (2 * np.repeat(np.arange(n), np.diff(starts)) + 1)
    padded = np.full(len(target) + 2 * REACH * max(n, 1), size, dtype=np.int32)
    padded[at] = target
    at = at if take is None else at[take]
    return np.stack([padded[at + d] for d in range(-REACH, REACH + 1) if d], axis=1) if len(at) else np.zeros((0, 2 * REACH), np.int32)


def _code_slices(batches: Iterator[pa.RecordBatch], limit: int = 500_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of encoded batches with at most ``limit`` tokens, or one row."""
    for batch in batches:
        column = batch.column("_codes")
        starts = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
        codes = column.flatten().to_numpy(zero_copy_only=False)
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1)
            yield batch.slice(row, end - row), codes[starts[row] : starts[end]].astype(np.int64), starts[row : end + 1] - starts[row]
            row = end


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``_codes``."""
    rest = [f for f in docs.schema.fields if f.name != text_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "_codes array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_col):
            codes, starts = vocabulary.encode(texts)
            found = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(codes, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), found], names=[*(f.name for f in rest), "_codes"])

    return docs.mapInArrow(run, schema)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for _, texts in slices(batches, "_text"):
            for t in filter(None, texts):
                held.update(WORD.findall(t.lower()))
            if len(held) > COUNT_FLUSH:
                yield out()
                held = Counter()
        if held:
            yield out()

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _averaged(copies: DataFrame, chunks: int) -> np.ndarray:
    """The weighted mean of the copies' changes, summed chunk by chunk as the sorted rows go by."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total, weight = None, None, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([weight], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["chunk", "weight", "data"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != chunk:
                    if chunk is not None:
                        yield out()
                    chunk, total, weight = row["chunk"], 0.0, 0
                total = total + np.frombuffer(row["data"], np.float16).astype(np.float64) * row["weight"]
                weight += row["weight"]
        if chunk is not None:
            yield out()

    sums = copies.repartition(min(chunks, 64), "chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, weight long, data binary")
    rows = sorted(sums.collect(), key=lambda r: r["chunk"])  # one network
    return np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(r["data"], np.float32) / max(r["weight"], 1) for r in rows)])


def learn_vocabulary(docs: DataFrame, words: int = 2048, buckets: int = 256, text_col: str = "text") -> tuple[Vocabulary, Network]:
    """The most frequent words of the corpus, and the untrained network over them."""
    if words % BLOCK_WORDS or not 0 < buckets < words:
        raise ValueError(f"words must be a multiple of {BLOCK_WORDS} and more than buckets")
    counted = materialize(word_counts(docs, text_col), "word-counts")
    top = [(r["word"], r["n"]) for r in counted.orderBy(F.desc("n"), "word").limit(words - buckets).collect()]
    fill = -(len(top) + buckets) % BLOCK_WORDS  # a small corpus has fewer words
    vocabulary = Vocabulary([w for w, _ in top], buckets + fill)
    rest = (counted.agg(F.sum("n")).first()[0] or 0) - sum(n for _, n in top)
    return vocabulary, first_network(np.array([n for _, n in top] + [rest / vocabulary.buckets] * vocabulary.buckets, dtype=float))


def train(encoded: DataFrame, vocabulary: Vocabulary, net: Network, rounds: int = 2, stride: int = 2) -> Network:
    if stride > rounds:
        raise ValueError("with fewer rounds than stride, positions are left out")
    size = vocabulary.size
    slim = encoded.select("_codes").where("size(_codes) > 0")
    chunks = -(-net.flat().size // CHUNK)
    for turn in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], start=net, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(start)
            around, target = np.zeros((0, 2 * REACH), np.int32), np.zeros(0, np.int64)
            for _, codes, starts in _code_slices(batches):
                take = np.flatnonzero(mix(np.arange(len(codes), dtype=np.uint64)) % np.uint64(stride) == turn % stride)
                around, target = np.concatenate((around, contexts(codes, starts, size, take))), np.concatenate((target, codes[take]))
                order = np.argsort(mix(np.arange(len(target), dtype=np.uint64)))
                n = 0
                while n + (step := trainer.next_step()) <= len(order):
                    trainer.step(around[order[n : n + step]], target[order[n : n + step]])
                    n += step
                around, target = around[order[n:]], target[order[n:]]
            if len(target):
                trainer.step(around, target)
            if trainer.seen:
                change = (trainer.net.flat() - start.flat()).astype(np.float16)
                for k in range(0, len(change), CHUNK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k // CHUNK], pa.int32()), pa.array([trainer.seen], pa.int64()), pa.array([change[k : k + CHUNK].tobytes()], pa.binary())],
                        names=["chunk", "weight", "data"],
                    )

        change = _averaged(slim.mapInArrow(run, "chunk int, weight long, data binary"), chunks)
        if len(change):
            net = net.like(net.flat() + change)
    return net


def score(encoded: DataFrame, vocabulary: Vocabulary, net: Network) -> DataFrame:
    """The columns of ``encoded`` but the codes, with ``_n_tokens`` and ``_log_likelihood`` (summed conditional log-probabilities)."""
    rest = [f for f in encoded.schema.fields if f.name != "_codes"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "_n_tokens long", "_log_likelihood double"])
    size = vocabulary.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, codes, starts in _code_slices(batches):
            around = contexts(codes, starts, size)
            each = np.zeros(len(codes) + 1)
            for k in range(0, len(codes), SCORE_POSITIONS):
                end = min(k + SCORE_POSITIONS, len(codes))
                each[k:end] = net.log_probability(around[k:end], codes[k:end])
            total = np.add.reduceat(each, starts[:-1]) * (np.diff(starts) > 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(np.diff(starts), pa.int64()), pa.array(total)], names=[*(f.name for f in rest), "_n_tokens", "_log_likelihood"]
            )

    return encoded.mapInArrow(run, schema)


def fit_and_score(docs: DataFrame, words: int = 2048, buckets: int = 256, rounds: int = 2, stride: int = 2, text_col: str = "text") -> DataFrame:
    """Learn from all of ``docs`` and score each; the codes are written once and read by every round."""
    vocabulary, net = learn_vocabulary(docs, words, buckets, text_col)
    encoded = materialize(encode(docs, vocabulary, text_col), "codes")
    return score(encoded, vocabulary, train(encoded, vocabulary, net, rounds, stride))
