"""Lines that many documents share are dropped, found through levelled sorted runs of line hashes.

A run is a table (h1, h2, n) of distinct line hashes and the number of documents that have them, hashed into buckets
and sorted there. Each new batch is anti-joined with the keys that a run already shows to be common, counted, and added as a
run of level 0. When a level holds ``fanout`` runs they are merged into one of the next level, by merge joins of equal buckets
without a shuffle. Everything is DataFrame operations.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` never go. A document is a distinct
doc_id (null counts as one id): repeated rows and equal ids count once, and every row of the input has its row in the result.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import materialize, shared_dir

# \z, as $ also matches before a last line end of other kinds (U+0085, U+2028, U+2029)
EDGE = r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"


def line_key(line: Column) -> Column:
    return F.translate(F.regexp_replace(line, EDGE, ""), string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


class LineRuns:
    """Levelled runs of line hashes under the shared folder of the session."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        )
        return name

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            other = run.withColumnRenamed("n", "_more").hint("merge")
            both = F.coalesce("n", F.lit(0)) + F.coalesce("_more", F.lit(0))
            out = out.join(other, ["h1", "h2"], "full").select("h1", "h2", both.alias("n"))
        return out

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc, h1, h2); no document may be in two batches."""
        counts = lines.distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        for run in self._runs():
            counts = counts.join(run.where(F.col("n") >= self.min_docs).hint("merge"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(counts))
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._write(self._merged([self.spark.table(name) for name in level])))
                self._drop(level)
                self.levels[k] = []

    def common(self) -> DataFrame:
        """(h1, h2) of the keys in at least ``min_docs`` documents."""
        return self._merged(self._runs()).where(F.col("n") >= self.min_docs).select("h1", "h2")

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = [[]]


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs``, the text without its common lines, and ``n_lines``, ``n_dropped``."""
    spark = docs.sparkSession
    key = F.transform(F.col("_lines"), line_key)
    slim = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"), lines_of(F.col(text_col)).alias("_lines")
    ).select("_id", "_text_hash", key.alias("_keys"))
    hashed = materialize(
        slim.select(
            "_id", "_text_hash", F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int").alias("_batch"),
            F.transform("_keys", lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2")))).alias("_keys"),
        ),
        "lines",
    )
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for batch in range(batches):
            own = hashed.where(F.col("_batch") == batch).select("_id", F.explode(F.array_distinct("_keys")).alias("_key")).where("_key IS NOT NULL")
            runs.add(own.select("_id", "_key.h1", "_key.h2"))
        common = materialize(runs.common(), "common")
    finally:
        runs.close()
    hits = (
        hashed.select("_id", "_text_hash", F.posexplode("_keys").alias("_pos", "_key")).where("_key IS NOT NULL")
        .select("_id", "_text_hash", "_pos", "_key.h1", "_key.h2").join(common, ["h1", "h2"], "left_semi")
        .groupBy(F.col("_id").alias("_hit_id"), F.col("_text_hash").alias("_hit_hash")).agg(F.collect_set("_pos").alias("_drop"))
    )
    names = docs.columns
    whole = docs.withColumn("_text_hash", F.xxhash64(text_col))
    found = whole.join(hits, whole[id_col].eqNullSafe(hits["_hit_id"]) & (whole["_text_hash"] == hits["_hit_hash"]), "left")
    found = found.withColumn("_all", lines_of(F.col(text_col)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.coalesce("_drop", F.array().cast("array<int>")))
    text = F.array_join(F.transform(stay, lambda p: F.get("_all", p)), "\n")
    rest = [c for c in names if c not in (text_col, "n_lines", "n_dropped")]
    return found.select(
        *rest, F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(text).alias(text_col),
        F.size("_all").cast("long").alias("n_lines"), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
