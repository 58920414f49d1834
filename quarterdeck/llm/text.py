"""Words of a text, as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word, and the white space between words and around lines.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def whole(text: Column) -> Column:
    """The text, empty when null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` and the lambdas in it
    refer to it. A column referred to from a lambda may be inlined by the optimizer and would
    then be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)
