"""Text expressions. All of them stay inside Spark's built-in functions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a word, next to the blank.
_PUNCTUATION = ".,;:!?\"()[]#@\r\n\t"


def split_list(col: Column, separator: str) -> Column:
    """Split on a one-character separator and drop empty elements."""
    return F.filter(F.split(col, f"[{separator}]"), lambda t: t != "")


def split_pattern(pattern: Column) -> Column:
    """Tokens of a ``user+hashtag`` pattern."""
    return split_list(pattern, "+")


def equals_ignoring_case(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def in_parentheses(col: Column) -> Column:
    return F.concat(F.lit("("), col, F.lit(")"))


def one_line(col: Column) -> Column:
    """Line breaks become blanks, one for one."""
    return F.translate(col, "\r\n", "  ")


def quoted_field(col: Column) -> Column:
    """One field of a delimited line: escaped and quoted; NULL becomes a bare empty field."""
    escaped = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    quoted = F.concat(F.lit('"'), one_line(escaped), F.lit('"'))
    return F.coalesce(quoted, F.lit(""))


def word_split(text: Column) -> Column:
    """Lower-case words of a text, split at blanks, punctuation and line breaks.

    The first and last element may be empty; ``words`` drops those.
    """
    return F.split(F.lower(text), "[ " + re.escape(_PUNCTUATION) + "]+")


def words(text: Column) -> Column:
    return F.filter(word_split(text), lambda w: w != "")


def absent_id_to_null(col: Column) -> Column:
    """Source records use -1 for "no id"."""
    return F.when(col != -1, col)


def longest_field(columns: list[str]) -> Column:
    """UTF-8 length of the longest of the given text columns (0 when all are NULL)."""
    sizes = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in columns]
    return reduce(lambda a, b: F.greatest(a, b), sizes)
