"""Strict JSON parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = "end-of-record"


def parse_pair(text: Column) -> Column:
    """A text as the first of two elements of an array, for ``strict_value``."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def strict_value(pair: Column) -> Column:
    whole = F.try_variant_get(pair, "$[1]", "string") == _END
    return F.when(whole, F.try_variant_get(pair, "$[0]", "variant"))


def parse_strict(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, else null.

    The built-in parser stops after the first value, so the text is read as the first of two
    elements of an array, and the second must still be there.
    """
    return strict_value(parse_pair(text))
