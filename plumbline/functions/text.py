"""Text primitives as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{IsAlphabetic}\p{N}']+"


def joined(text: Column) -> Column:
    """The text's words, lower-cased, between single spaces, with a space at each end.

    A word is a run of alphabetic or numeric characters and apostrophes, without apostrophes at its
    ends.  Regular expressions do it in three passes, with no array of words.
    """
    lower = F.replace(F.lower(text), F.lit("’"), F.lit("'"))
    spaced = F.concat(F.lit(" "), F.regexp_replace(lower, NOT_WORD, " "), F.lit(" "))
    bare = F.regexp_replace(spaced, r"(?<= )'+|'+(?= )", "")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(bare, " +", " ")), F.lit(" "))


def words(joined_: Column) -> Column:
    return F.when(F.length(joined_) > 2, F.split(F.trim(joined_), " ")).otherwise(F.array().cast("array<string>"))


def has(joined_: Column, phrase: str) -> Column:
    return F.contains(joined_, F.lit(f" {phrase} "))


def times(joined_: Column, phrase: str) -> Column:
    """Non-overlapping occurrences; neighbours share a space, so adjacent repeats count once."""
    p = f" {phrase} "
    return ((F.length(joined_) - F.length(F.replace(joined_, F.lit(p), F.lit("")))) / len(p)).cast("int")


def blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"[^\p{IsWhite_Space}]")


def round2(x: Column) -> Column:
    return F.round(x * 100) / 100


def length_metric(text: Column) -> Column:
    return F.log(1 + F.length(text).cast("double"))


def head_chars(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(max(0, most - 1))), F.lit("…"))).otherwise(text)


def tail_chars(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.lit("…"), F.right(text, F.lit(max(0, most - 1))))).otherwise(text)


def fence(text: Column) -> Column:
    """Closing and opening tags of the judge's prompt made harmless."""
    for name in ("response", "context"):
        text = F.replace(text, F.lit(f"</{name}>"), F.lit(f"<\\/{name}>"))
        text = F.replace(text, F.lit(f"<{name}>"), F.lit(f"<\\{name}>"))
    return text
