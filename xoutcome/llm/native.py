"""Words and shingles as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"


def lowered(text: Column) -> Column:
    """A-Z to a-z, all other letters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The runs without ASCII white space; none give an empty array."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def windows(words_: Column, size: int, one, short) -> Column:
    """``one`` of every ``size`` neighbouring words; ``short`` of the whole sequence if it is shorter but not empty.

    ``words_`` should be a plain column, as the lambda evaluates it for every window.
    """
    n = F.size(words_)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))),
                                         lambda i: one([F.get(words_, i + k) for k in range(size)]))).when(
        n > 0, F.array(short(words_))).otherwise(F.array())


def shingle_hashes(words_: Column, size: int) -> Column:
    return windows(words_, size, lambda w: F.xxhash64(*w), lambda w: F.xxhash64(F.concat_ws(" ", w), F.lit(1)))


def shingle_texts(words_: Column, size: int) -> Column:
    return windows(words_, size, lambda w: F.concat_ws(" ", *w), lambda w: F.concat_ws(" ", w))
