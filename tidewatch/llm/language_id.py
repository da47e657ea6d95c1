"""Language of whole texts: the family first, then one-versus-one linear support vector machines inside the family.

Features are hashed runs of 1 to 4 characters of the lower-cased text, with everything but letters as one space; a text is scored
by the mean weight of its runs. The family is told by a softmax regression over the families that were learned, then each pair
of languages of that family votes by the sign of its machine (squared hinge loss); the sum of the margins settles ties.

The model is fitted on at most about ``max_docs`` documents a language (by a hash of the id), line by line; prediction reads every
whole text and nothing but the text.

Defined results: ``und`` with score 0 if a text is null or has no letter. Languages that the table of families lacks are a family
of their own. With one learned language every text is of that language, with none every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import mix, slices

BITS = 16
RUNS = (1, 2, 3, 4)
PAD = max(RUNS) - 1
LETTER = re.compile(r"[^\W\d_]")
REST = re.compile(r"[\W\d_]+")
SCALE = 100.0
BLOCK = 1 << 20
# fixed values: ISO 639-1 codes by family
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is fo af yi lb fy",
    "romance": "fr es it pt ro ca gl oc la rm",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "semitic": "ar he mt am",
    "indic": "hi bn mr gu pa ur ne si sd as or",
    "iranian": "fa ps ku tg",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue",
    "malay": "id ms jv su",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each behind its own spaces, and where each text (with them) starts."""
    clean = [" " * PAD + REST.sub(" ", t.lower()) for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in clean], out=starts[1:])
    return np.frombuffer(("".join(clean) + " " * PAD).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64), starts


def _run_slots(chars: np.ndarray, n: int, width: int) -> np.ndarray:
    """Slots of the runs of ``width`` characters that begin at the first ``n`` places."""
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = h * np.uint64(0x100000001B3) + chars[k : k + n]
    return (mix(h) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def mean_weights(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean row of ``weights`` over the runs of each text."""
    chars, starts = _characters(texts)
    total = np.zeros((len(texts), weights.shape[1]))
    for begin in range(0, int(starts[-1]), BLOCK):
        n = min(BLOCK, int(starts[-1]) - begin)
        first = int(np.searchsorted(starts, begin, side="right")) - 1
        last = int(np.searchsorted(starts, begin + n, side="left"))
        cuts = np.maximum(starts[first:last] - begin, 0)
        block = chars[begin : begin + n + PAD]
        for width in RUNS:
            total[first:last] += np.add.reduceat(weights[_run_slots(block, n, width)], cuts, axis=0)
    return total * (SCALE / (len(RUNS) * np.diff(starts)[:, None]))


@dataclass
class LanguageModel:
    families: list[str]
    languages: dict[str, list[str]]
    weights: np.ndarray = field(repr=False)  # columns: the families (if over one), then the pairs of each family
    bias: np.ndarray = field(repr=False)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        has = [bool(self.families) and bool(t) and LETTER.search(t) is not None for t in texts]
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        at = np.flatnonzero(has)
        if not len(at):
            return names, scores
        margins = mean_weights([texts[i] for i in at], self.weights) + self.bias if self.weights.shape[1] else np.zeros((len(at), 0))
        if len(self.families) > 1:
            e = np.exp(margins[:, : len(self.families)] - margins[:, : len(self.families)].max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            column = len(self.families)
        else:
            p, column = np.ones((len(at), 1)), 0
        chosen = p.argmax(axis=1)
        for f, family in enumerate(self.families):
            own, n = self.languages[family], len(self.languages[family])
            mine = chosen == f
            votes = np.zeros((mine.sum(), n))
            for a, b in combinations(range(n), 2):
                m = margins[mine, column]
                column += 1
                votes[:, a] += (m > 0) + np.tanh(m) / (4 * n)
                votes[:, b] += (m <= 0) - np.tanh(m) / (4 * n)
            best = votes.argmax(axis=1) if n > 1 else np.zeros(mine.sum(), int)
            sure = np.clip(votes.max(axis=1) / max(n - 1, 1), 0, 1) if n > 1 else np.ones(mine.sum())
            for i, k in zip(at[mine], best, strict=True):
                names[i] = own[k]
            scores[at[mine]] = np.clip(p[mine, f] * sure, 0, 1)
        return names, scores


def _descend(texts: list[str], loss, n_out: int, steps: int = 60, penalty: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias that minimise ``loss(margins) -> gradient by margin`` over the lines, by Adam in batches."""
    rng = np.random.default_rng(11)
    order = rng.permutation(len(texts))
    batches = []
    for part in np.array_split(order, max(1, len(texts) // 2000)):
        chars, starts = _characters([texts[i] for i in part])
        n = int(starts[-1])
        slots = np.concatenate([_run_slots(chars, n, w) for w in RUNS])
        rows = np.tile(np.repeat(np.arange(len(part)), np.diff(starts)), len(RUNS))
        cells, counts = np.unique(rows << BITS | slots, return_counts=True)
        scale = SCALE / (len(RUNS) * np.diff(starts))
        batches.append((part, (cells >> BITS).astype(np.int32), (cells & ((1 << BITS) - 1)).astype(np.int32), counts * scale[cells >> BITS]))
    w, bias = np.zeros((1 << BITS, n_out)), np.zeros(n_out)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros(n_out), np.zeros(n_out)
    for step in range(1, steps + 1):
        part, rows, slots, x = batches[step % len(batches)]
        z = np.stack([np.bincount(rows, weights=x * w[slots, j], minlength=len(part)) for j in range(n_out)], axis=1) + bias
        g = loss(z, part) / len(part)
        grad = np.stack([np.bincount(slots, weights=x * g[rows, j], minlength=1 << BITS) for j in range(n_out)], axis=1) + penalty * w
        rate = 0.1 * (1 - step / (steps + 1))
        for param, value, mean, var in ((w, grad, m, v), (bias, g.sum(axis=0), mb, vb)):
            mean += 0.1 * (value - mean)
            var += 0.01 * (value**2 - var)
            param -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    return w, bias


def train(texts: list[str], langs: list[str], steps: int = 60) -> LanguageModel:
    langs = np.array(langs, dtype=object)
    known = sorted(set(langs))
    family_of = {x: FAMILY.get(x.lower().split("-")[0].split("_")[0], x) for x in known}
    families = sorted(set(family_of.values()))
    languages = {f: [x for x in known if family_of[x] == f] for f in families}
    weights, bias = [], []
    if len(families) > 1:
        y = np.array([families.index(family_of[x]) for x in langs])
        share = 1 / (np.bincount(y, minlength=len(families))[y] * len(families)) * len(y)

        def softmax(z, part):
            e = np.exp(z - z.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            return p * share[part][:, None]

        w, b = _descend(texts, softmax, len(families), steps)
        weights.append(w)
        bias.append(b)
    for f in families:
        for one, two in combinations(languages[f], 2):
            at = np.flatnonzero((langs == one) | (langs == two))
            sign = np.where(langs[at] == one, 1.0, -1.0)
            share = np.where(sign > 0, 0.5 / max((sign > 0).mean(), 1e-9), 0.5 / max((sign < 0).mean(), 1e-9))

            def hinge(z, part, sign=sign, share=share):
                return (-2 * np.maximum(0, 1 - sign[part] * z[:, 0]) * sign[part] * share[part])[:, None]

            w, b = _descend([texts[i] for i in at], hinge, 1, steps)
            weights.append(w)
            bias.append(b)
    empty = np.zeros((1 << BITS, 0))
    return LanguageModel(families, languages, np.concatenate([empty, *weights], axis=1).astype(np.float32), np.concatenate([np.zeros(0), *bias]))


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)) == fold


def fit(docs: DataFrame, max_docs: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from the documents that are not held out; ``max_docs`` a language, by a hash of the id."""
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).where(
        ~held_out(F.col("_id")) & F.col("_lang").isNotNull() & F.col("_text").isNotNull()
    )
    counts = {r["_lang"]: r["count"] for r in own.groupBy("_lang").count().collect()}  # a row a language
    unit = F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(1_000_000))
    keep = F.lit(False)
    for lang, count in counts.items():
        keep = keep | ((F.col("_lang") == lang) & (unit < int(min(1.0, max_docs / count) * 1_000_000)))
    sample = own.where(keep).select("_id", "_text", "_lang").toPandas().sort_values(["_id", "_text"], kind="stable")
    texts, langs = [], []
    for text, lang in zip(sample["_text"], sample["_lang"], strict=True):
        for line in text.split("\n"):
            if LETTER.search(line):
                texts.append(line)
                langs.append(lang)
    return train(texts, langs)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            names, scores = model.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return own.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
