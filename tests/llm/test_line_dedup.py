import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidewatch.llm import line_dedup


def brute(rows, min_docs, min_chars):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})

    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(seen[key(x)]) < min_docs]
        out.append((i, t if len(kept) == len(lines) else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_common_lines(df, **options).collect()), key=repr)


ROWS = [
    *[(i, f"  Shared LINE \t\nown {i}\n\n\x0b") for i in range(12)],
    *[(20 + i, f"almost {i}\nnine times") for i in range(9)],
    (40, "Äpfel\nÄPFEL\näpfel"), (41, None), (42, ""), (43, "\n\n"), (44, "shared line \nshared line"),
    (45, "nine times\n" * 5000 + "end"), (46, "repeated"), (46, "repeated"), (None, "no id\nshared line"), (46, "other text\nshared line"),
]


def test_other_line_ends_are_no_white_space(spark):
    rows = [(10 * k + i, f"own {k} {i}\nabc{end}") for k, end in enumerate([" \u2028", "\u2028", " \u2029", "\x85", " \x85", "\t\u2029"]) for i in range(5)]
    rows += [(100 + i, f"abc \u2028 \nown {i}") for i in range(10)]
    assert run(spark, rows) == brute(rows, 10, 1)
    assert sum(n for _, _, _, n in run(spark, rows)) == 15


def test_against_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS, 10, 1)
    assert run(spark, ROWS, min_docs=9, min_chars=11, batches=3, fanout=3) == brute(ROWS, 9, 11)


def test_the_result_does_not_follow_batches_and_levels(spark):
    assert run(spark, ROWS, batches=1, fanout=2) == run(spark, ROWS, batches=7, fanout=2)


def test_repeated_rows_count_once(spark):
    rows = [(1, "line")] * 30 + [(i, "line two") for i in range(10)]
    assert run(spark, rows) == brute(rows, 10, 1)
    assert (1, "line", 1, 0) in run(spark, rows)


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, h1 string, _other int")
    assert line_dedup.drop_common_lines(empty).collect() == []
    some = spark.createDataFrame([(i, "x\ny", "h", 5) for i in range(10)], "doc_id long, text string, h1 string, _other int")
    assert {(r.text, r.h1, r._other) for r in line_dedup.drop_common_lines(some).collect()} == {("", "h", 5)}


def test_runs_merge_into_levels(spark):
    runs = line_dedup.LineRuns(spark, min_docs=2, fanout=2, buckets=3)
    for doc in range(4):
        runs.add(spark.createDataFrame([(doc, h, 0) for h in range(doc, 4)], "_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert {r.h1 for r in runs.common().collect()} == {1, 2, 3}
    runs.close()


def test_only_built_in_functions(spark):
    plan = line_dedup.drop_common_lines(spark.createDataFrame(ROWS, "doc_id long, text string")).select(F.sha2("text", 256))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
    assert plan.count() == len(ROWS)
    assert hashlib.sha256(b"").hexdigest() in {r[0] for r in plan.collect()}
