"""The corpus pipeline: documents through the stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of its documents, other columns than the usual ones included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, line_dedup, ngram_join, sentencepiece_codec, toxicity
from tidewatch.llm.common import pack, unpack
from tidewatch.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than clean go; the model is learned from the labels."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpack(toxicity.score(pack(docs), model).where(~F.col("_toxic")), docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten documents share go; every document stays, ``n_chars`` follows its text."""
    kept = unpack(line_dedup.drop_common_lines(pack(docs)), docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word n-grams link with a Jaccard index of 0.8, the one with the smallest id stays."""
    return unpack(ngram_join.keep_one(pack(docs)), docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    flagged = decontaminate.flag(pack(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return unpack(flagged.where(F.size("_items") == 0), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text."""
    rest = [c for c in ("doc_id", "lang", "source", "n_chars") if c in docs.columns]
    coded = sentencepiece_codec.encode(docs.select(*rest, "text"))
    return coded.select(*rest, F.size("_ids").alias("n_ids"), F.col("_ids").alias("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

# SQL has no regression, Viterbi or n-gram join at this size; tests/llm holds the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
