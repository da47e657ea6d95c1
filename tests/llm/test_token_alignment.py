"""Alignment of two tokenizations against a plain merge of the libraries' own results."""

import hashlib
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidewatch.llm import token_alignment as ta

TEXTS = [
    None, "", " ", "\n", "a", "  two  blanks ", "line one\r\nline two\n\n\tx \r\n", "naïve Café — it's 12,345.67€", "日本語のテキスト", "a▁b", "🤖 robots 🤖🤖 go",
    "<|endoftext|> is <s> text </s><0x41>", "odd\xa0 spaces  and 　\xa0  lines  \n x", "the same the same the same", "the same the same the same", "x\x00y", "\x1c z \x85  q",
    "tab\tseparated\tvalues\n\n\nand \n more \n", "word " * 400, "ab" * 3000, "Ünïcödé́ combining á ́b", " leading", "trailing ", "▁",
]


def brute(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by place, and pair counts."""
    a_model, b_model = Tokenizer.from_file(ta.BYTE_MODEL), SentencePieceProcessor(model_file=ta.PIECE_MODEL)
    a_model.encode_special_tokens = True
    alphabet = ta.byte_alphabet()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(alphabet[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode()) for i in b_model.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    def spans(side):
        out, at = [], 0
        for i, raw in side:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    rows, counts, most = [], Counter(), Counter()
    for text in texts:
        a, b = map(spans, tokens(text))
        links, k = [], 0
        for i, start, end in a:
            while k < len(b) and b[k][2] <= start:
                k += 1
            j = k
            while j < len(b) and b[j][1] < end:
                links.append((i, b[j][0]))
                j += 1
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            sides = []
            for side, at in ((a, i), (b, j)):
                end = at
                while side[end][2] < cut:
                    end += 1
                sides.append(",".join(str(x[0]) for x in side[at : end + 1]))
                i, j = (end + 1, j) if side is a else (i, end + 1)
            groups.append("|".join(sides))
        counts.update(links)
        rows.append((len(a), len(b), groups, links))
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), ";".join(g)) for n_a, n_b, g, x in rows], counts


def rows(df):
    return [tuple(r) for r in df.orderBy("doc_id").select("_n_a", "_n_b", "_n_groups", "_n_links", "_n_best", "_count_sum", "_groups").collect()]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_brute_force(spark, limit):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    found = ta.align(docs, groups=True, broadcast_pairs=limit)
    wanted, _ = brute(TEXTS)
    assert rows(found) == wanted
    for r in found.collect():
        assert r._groups_sha256 == (hashlib.sha256(r._groups.encode()).hexdigest() if r._groups else "")
    assert [r[0] for r, t in zip(wanted, TEXTS, strict=True) if t and "▁" in t] == [0, 0] and sum(r[0] > 0 for r in wanted) == len(TEXTS) - 4


def test_counts(spark):
    docs = spark.createDataFrame([(1, "the cat"), (1, "the cat"), (None, "the dog")], "doc_id long, text string")
    _, counts = brute(["the cat", "the cat", "the dog"])
    assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): r.n for r in ta.pair_counts(ta.tokenize(docs)).collect()} == counts


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, _n_a int, `odd name` string")
    row = ta.align(docs).first()
    assert row["odd name"] == "x" and row["_n_a"] == 2
    for limit in (2_000_000, 0):
        assert ta.align(docs.where("doc_id > 1"), broadcast_pairs=limit).count() == 0


def test_a_text_is_one_row_however_it_is_cut(spark, monkeypatch):
    text = "many words, with signs; " * 500
    both = ta.models(ta.BYTE_MODEL, ta.PIECE_MODEL)
    short = ta.Merged.of([text, None, text], both)
    monkeypatch.setattr(ta, "PART_PIECES", 10**9)
    long = ta.Merged.of([text, None, text], both)
    assert short.groups()[1] == long.groups()[1] and (sorted(zip(short.left, short.right)) == sorted(zip(long.left, long.right)))
