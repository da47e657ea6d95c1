"""String functions: whitespace, entropy, pseudonyms, display formats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a text is stripped of and split on.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANKS = r"[\p{IsWhite_Space}\x1c-\x1f]+"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def shannon_entropy(value: Column) -> Column:
    """Base-2 entropy of the characters of a string; empty or null gives 0."""
    size = F.length(value)

    def add(total, char):
        share = (size - F.length(F.replace(value, char, F.lit("")))) / size
        return total - share * F.log2(share)

    letters = F.array_distinct(F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0)))
    # a one-character alphabet gives -0.0; adding 0.0 turns that into 0.0
    return F.when(size > 0, F.aggregate(letters, F.lit(0.0), add) + F.lit(0.0)).otherwise(F.lit(0.0))


BLOCK_CHARS = 65_536


def _entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with the UTF-8 texts replaced by the base-2 entropy of their characters, counted in one pass over each text."""
    for batch in batches:
        found = np.zeros(batch.num_rows)
        for i, text in enumerate(batch.column("_text")):
            if text.is_valid and (raw := text.as_py()):
                codes = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                # characters outside the first 65,536 are rare: sorted instead of counted in place
                counts = np.bincount(codes) if codes.max() < 1 << 16 else np.unique(codes, return_counts=True)[1]
                share = counts[counts > 0] / len(codes)
                found[i] = max(0.0, -(share * np.log2(share)).sum())
        yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(found), batch.column("n_chars")], names=["_key", "entropy", "n_chars"])


def entropy_by_row(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, entropy, n_chars) of every row, for texts of any length.

    Texts of up to ``BLOCK_CHARS`` characters are counted inside their row, by numpy. Longer ones are cut into blocks, which give a row for each of their
    different characters. Rows are kept apart whatever their key is; a null text has entropy 0 and no length.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.length(text).cast("bigint").alias("n_chars"))
    long = F.coalesce(F.col("n_chars") > BLOCK_CHARS, F.lit(False))
    narrow = rows.where(~long).select("_key", F.col("_text").cast("binary"), "n_chars")
    short = narrow.mapInArrow(_entropies, f"_key {narrow.schema['_key'].dataType.simpleString()}, entropy double, n_chars long").withColumnRenamed("_key", key)
    starts = F.sequence(F.lit(0), F.floor((F.col("n_chars") - 1) / BLOCK_CHARS).cast("int"))
    blocks = rows.where(long).withColumn("_row", F.monotonically_increasing_id()).select(
        "_row", "_key", "n_chars",
        F.explode(F.transform(starts, lambda b: F.substring("_text", b * BLOCK_CHARS + 1, BLOCK_CHARS))).alias("_block"),
    )
    letters = F.array_distinct(F.regexp_extract_all(F.col("_block"), F.lit("(?s)."), F.lit(0)))
    own = F.transform(letters, lambda c: F.struct(c.alias("c"), (F.length("_block") - F.length(F.replace(F.col("_block"), c, F.lit("")))).cast("bigint").alias("k")))
    counts = blocks.select("_row", "_key", "n_chars", F.inline(own)).groupBy("_row", "c").agg(F.first("_key").alias("_key"), F.first("n_chars").alias("n_chars"), F.sum("k").alias("k"))
    share = F.col("k") / F.col("n_chars")
    summed = counts.groupBy("_row").agg(F.first("_key").alias(key), F.sum(-share * F.log2(share)).alias("entropy"), F.first("n_chars").alias("n_chars"))
    return short.unionByName(summed.select(key, (F.greatest("entropy", F.lit(0.0)) + 0.0).alias("entropy"), "n_chars"))


def pseudonymize(value: Column, key: bytes) -> Column:
    """``ps_`` and the first 16 hex digits of HMAC-SHA256(key, value); null stays null."""
    if not key:
        raise ValueError("a pseudonym key is required")
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in block))
    outer = F.lit(bytearray(b ^ 0x5C for b in block))
    digest = F.unhex(F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256))
    return F.concat(F.lit("ps_"), F.substring(F.sha2(F.concat(outer, digest), 256), 1, 16))


def thousands(digits: Column) -> Column:
    """Comma-grouped form of a string of decimal digits of any length."""
    return F.regexp_replace(digits, r"(?<=\d)(?=(?:\d{3})+$)", ",")


def title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
