import random
from pathlib import Path

import pytest

from tidewatch.llm import sentencepiece_codec as codec

needs_model = pytest.mark.skipif(not Path(codec.MODEL).exists(), reason="needs the tokenizer files")
TEXTS = [
    "", " ", "  a  b", "\t漢字 ☃😀▁x", "a" * 500 + "漢" * 50, "x\n\n y ", "<s> <0x41> </s>", "▁▁", "Ünïcode ​ zero\u0000nul", "word " * 3000, "hello" * 4000,
    "the other thing\r\nand\x0bmore", "…" * 700,
]


@pytest.fixture(scope="module")
def model():
    return codec.Codec(*codec.read_model())


def best_path(own: codec.Codec, text: str) -> float:
    """The highest sum of scores over the whole text at once."""
    pieces = {}

    def gather(node, prefix):
        for c, (below, score, i) in node.items():
            if i >= 0:
                pieces[prefix + c] = score
            gather(below, prefix + c)

    gather(own.trie, "")
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + own.longest) + 1):
            score = pieces.get(text[i:j])
            if score is not None:
                best[j] = max(best[j], best[i] + score)
        if text[i] not in pieces:
            best[i + 1] = max(best[i + 1], best[i] + own.unknown_score)
    return best[-1]


def score_of(own: codec.Codec, scores: list[float], ids: list[int], n_unknown: int) -> float:
    return sum(scores[i] for i in ids) + n_unknown * own.unknown_score


@needs_model
@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(model, text):
    assert model.decode(model.encode(text)) == text


def test_streaming_finds_the_best_path_of_the_whole_text():
    rng = random.Random(5)
    for turn in range(60):
        alphabet = "ab c"[: 2 + turn % 3]
        pieces = {c: -rng.randint(1, 9) for c in alphabet[: 1 + turn % 4]}
        for _ in range(12):
            pieces["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 5)))] = -rng.randint(1, 30)
        table = [("<unk>", 0.0, "unknown"), *((p, float(s), "normal") for p, s in pieces.items())]
        own = codec.Codec(table, prefix=False)
        own.cut = None
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400)))
        ids = [i for run in own.stream(text) for i in run]
        found = sum(table[i][1] if i else own.unknown_score for i in ids)
        assert found == best_path(own, text)


def test_ids_come_before_the_text_ends_and_memory_stays_small():
    own = codec.Codec([("<unk>", 0.0, "unknown"), ("a", -1.0, "normal"), ("ab", -1.5, "normal"), ("b", -1.0, "normal")], prefix=False)
    runs = list(own.stream("ab" * 5000))
    assert len(runs) > 500 and max(map(len, runs)) < 30 and sum(map(len, runs)) == 5000


def test_no_boundary_to_agree_on_until_the_end():
    # both tilings of the text cost the same until its last character decides
    own = codec.Codec([("<unk>", 0.0, "unknown"), ("aa", -1.0, "normal"), ("a", -10.0, "normal"), ("ab", -1.0, "normal")], prefix=False)
    for n in (400, 401):
        ids = [i for run in own.stream("a" * n + "b") for i in run]
        assert sum([0, -1.0, -10.0, -1.0][i] for i in ids) == best_path(own, "a" * n + "b")


@needs_model
def test_stretches_and_streaming_agree(model):
    for text in TEXTS:
        if text:
            keep, model.cut = model.cut, None
            try:
                plain = model.encode(text)
            finally:
                model.cut = keep
            assert model.encode(text) == plain


@needs_model
def test_the_library_agrees_on_a_unigram_model():
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    proto.ParseFromString(Path(codec.MODEL).read_bytes())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:  # single precision loses whole units beside scores of -1e9
        piece.score = max(piece.score, -40000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    pieces, prefix = codec.read_model()
    own = codec.Codec([(p, max(s, -40000.0), k) for p, s, k in pieces], prefix)
    words = "the quick brown fox jumps over lazy dogs while 漢字 und größere Häuser naïve 12345 www.example.org ☃".split()
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(20))
        assert own.encode(text) == library.encode(text)


@needs_model
def test_columns(spark):
    df = spark.createDataFrame([(1, "two words", 5), (2, None, 6), (3, "", 7), (1, "two words", 5)], "doc_id long, text string, pieces int")
    rows = codec.encode(df, check=True).collect()
    assert [(r.doc_id, r._exact) for r in rows] == [(1, True), (2, None), (3, True), (1, True)]
    assert rows[1]._ids is None and rows[2]._ids == [] and rows[0]._ids == rows[3]._ids
    decoded = codec.decode(codec.encode(df)).collect()
    assert [r._decoded for r in decoded] == ["two words", None, "", "two words"]
    counts = {r.id: r.n for r in codec.id_counts(codec.encode(df)).collect()}
    assert sum(counts.values()) == 2 * len(rows[0]._ids)
    assert codec.encode(df.limit(0), check=True).collect() == [] and codec.decode(codec.encode(df.limit(0))).collect() == []


def test_without_byte_pieces_a_strange_character_is_unknown():
    own = codec.Codec([("<unk>", 0.0, "unknown"), ("▁a", -1.0, "normal"), ("b", -1.0, "normal")])
    assert own.encode("ab☃b") == [1, 2, 0, 2] and own.decode([1, 2, 0, 2]) == "ab ⁇ b"
