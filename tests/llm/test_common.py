import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm.common import components, hash_strings, pack, tokens, unpack, window_hashes


def test_components_take_the_smallest_name(spark):
    chain = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame([*chain, (100, 101), (103, 101), (7, 7), (40, 0)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_star_of_many(spark):
    edges = spark.range(1, 5000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert components(edges).agg(F.max("component"), F.count("*")).first()[:] == (0, 5000)


def test_hashes_are_fixed():
    # fixed value: the hash must not follow the process
    assert hash_strings(np.array(["tide"], dtype=object))[0] == hash_strings(np.array(["a", "tide"], dtype=object))[1]
    h = np.arange(10, dtype=np.uint64)
    assert len(window_hashes(h, 3)) == 8 and len(window_hashes(h, 11)) == 0
    assert window_hashes(h[2:5], 3)[0] == window_hashes(h, 3)[2]


def test_tokens_keep_their_lists():
    codes, distinct, starts = tokens([["b", "a"], [], ["b"]])
    assert distinct[codes].tolist() == ["b", "a", "b"] and starts.tolist() == [0, 2, 2, 3]


def test_packing_hides_clashing_names(spark):
    df = spark.createDataFrame([(1, "x", 2, "y", 3)], ["doc_id", "text", "_toxic", "odd name:", "_ids"])
    assert unpack(pack(df), df.columns).collect() == df.collect()
    plain = df.select("doc_id", "text")
    assert unpack(pack(plain), plain.columns).collect() == plain.collect()
