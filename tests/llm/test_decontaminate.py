import random

from tidewatch.llm import decontaminate as d

RNG = random.Random(2)
WORDS = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


TRAIN = "A train leaves Boston at 3 pm and travels 120 km in 2 hours, so how fast does the train travel on average?"
ITEMS = [
    (1, TRAIN), (2, prose(40)), (3, "tiny one of five words"), (4, None), (5, ""), (6, "12 34 56 78 90 12 34 56 78 90"), (7, prose(9)), (8, prose(30)), (9, "of"),
]
ITEM = dict(ITEMS)


def found(spark, docs, items=ITEMS, **options):
    df = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, _slots string")
    table = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: r._items for r in d.flag(df, table, **options).collect()}


def test_passages(spark):
    changed = TRAIN.replace("Boston", "Chicago").replace("3 pm", "7 pm").replace("120 km", "300 miles").replace("2 hours", "5 minutes")
    mixed = "First read: 4 apples and 4 pears; then 4 plums, and so on, cost more than 9 plums with all of the rest of it."
    docs = [
        (1, f"{prose(50)} {ITEM[2]} {prose(30)}"), (2, f"{prose(10)}\n{TRAIN}\n{prose(10)}"), (3, f"{prose(10)}. {changed} {prose(5)}"), (4, prose(300)), (5, None), (6, ""),
        (7, ITEM[7]), (8, f"{prose(2000)} {ITEM[2].upper()} {ITEM[8]} {prose(9)}"), (9, "see tiny one of five words here"), (10, ITEM[6]), (11, " ".join(ITEM[2].split()[:10])),
        (12, mixed),
    ]
    got = found(spark, docs)
    assert got == {1: [2], 2: [1], 3: [1], 4: [], 5: [], 6: [], 7: [7], 8: [8] if 2 not in got[8] else [2, 8], 9: [3], 10: [], 11: [], 12: []}
    # a slot must keep its partner: 4, 4, 4 may become 6, 6, 6 but not 6, 7, 8
    items = [(1, mixed)]
    other = mixed.replace("4", "6").replace("9", "11")
    assert found(spark, [(1, other), (2, mixed.replace("4 apples", "6 apples").replace("4 pears", "7 pears").replace("4 plums", "8 plums"))], items) == {1: [1], 2: []}


def test_blocks_of_hashes_change_nothing(spark, monkeypatch):
    docs = [(i, f"{prose(20)} {ITEM[2 if i % 2 else 8]} {prose(20)}") for i in range(6)]
    whole = found(spark, docs)
    monkeypatch.setattr(d, "BLOCK_HASHES", 7)
    assert found(spark, docs) == whole == {i: [2 if i % 2 else 8] for i in range(6)}


def test_brute_force(spark):
    """Verbatim passages: an item is found if and only if 13 of its words in a row (80 % of a shorter one) are in the text."""
    items = [(i, prose(RNG.randint(8, 40))) for i in range(25)]
    docs = []
    for i in range(60):
        words = items[i % 25][1].split()
        a = RNG.randint(0, len(words))
        docs.append((i, f"{prose(30)} {' '.join(words[a : a + RNG.randint(5, 30)])} {prose(30)}"))
    expected = {}
    for i, text in docs:
        have = text.split()
        for k, item in items:
            words = item.split()
            need = min(13, -(-len(words) * 4 // 5))
            runs = {tuple(have[j : j + need]) for j in range(len(have))}
            if any(tuple(words[j : j + need]) in runs for j in range(len(words) - need + 1)):
                expected.setdefault(i, []).append(k)
    got = found(spark, docs, items)
    assert {i: v for i, v in got.items() if v} == expected


def test_repeated_rows_and_empty_tables(spark):
    twice = spark.createDataFrame([(1, ITEM[2]), (1, ITEM[2]), (1, "other"), (None, ITEM[2])], "doc_id long, text string")
    table = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted(len(r._items) for r in d.flag(twice, table).collect()) == [0, 1, 1, 1]
    assert [r._items for r in d.flag(twice.limit(1), table.limit(0)).collect()] == [[]]
    assert d.flag(twice.limit(0), table).collect() == []
    again = table.unionAll(table.where("item_id = 2")).unionAll(table.selectExpr("item_id + 100", "text").where("`(item_id + 100)` = 102"))
    assert [r._items for r in d.flag(twice.where("doc_id is null"), again).collect()] == [[2, 102]]


def test_verbatim_copies_of_numbers_names_and_capitals(spark):
    items = [
        (1, "What is 12 + 45 - 7?"), (2, prose(30)), (3, "Ann Lee Bob Ray Cy Dee Eve Fay and Gus Hal Ida Joe Kim Leo Max Ned"), (4, "Sum: " + " ".join(str(n) for n in range(30, 60))),
    ]
    text = dict(items)
    docs = [
        (1, f"{prose(9)} what is 12 + 45 - 7? {prose(9)}"), (2, f"{prose(50)} {text[2].upper()} {prose(9)}"), (3, f"{prose(9)}. {text[3]}"), (4, f"{prose(9)} {text[4]}"),
        (5, text[2].title()), (6, "What is 13 + 46 - 8?"), (7, text[4].replace("45", "99").replace("52", "99").replace("38", "99")), (8, text[3].replace("Ann", "Zoe").replace("Gus", "Yan")),
    ]
    assert found(spark, docs, items) == {1: [1], 2: [2], 3: [3], 4: [4], 5: [2], 6: [], 7: [], 8: []}


def test_other_names_at_sentence_starts_and_separate_runs(spark):
    tom = "Tom has 5 apples. Tom gives 2 apples to Ann. How many apples does Tom have left?"
    a, b = prose(8), prose(8)
    items = [(1, tom), (2, f"{a} {prose(3)} {b}")]
    eve = "Eve has 9 apples. Eve gives 4 apples to Bob. How many apples does Eve have left?"
    docs = [
        (1, f"{prose(9)}. {eve} {prose(9)}"), (2, f"{prose(9)}. {eve.replace('Bob', 'Bob Lee')} {prose(9)}"), (3, f"{prose(9)}: {eve}"),
        (4, f"{prose(9)}. {eve.replace('9', '8').replace('Eve have', 'Bob have')} {prose(9)}"), (5, f"{prose(9)} {a} {prose(3)} {b} {prose(9)}"),
        (6, f"{prose(9)} {a} {prose(9)}"),
    ]
    assert found(spark, docs, items) == {1: [1], 2: [1], 3: [1], 4: [], 5: [2], 6: []}
