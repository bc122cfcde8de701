"""Text rules shared by the operators, as Column expressions.

White space is the ASCII set ``[\\x20\\x09-\\x0D]`` and only A-Z are lower-cased,
so that every engine agrees on words and keys.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RE = r"[\x20\x09-\x0D]+"


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(col) == F.char_length(col)  # ASCII only: the fast built-in does the same
    return F.when(plain, F.lower(col)).otherwise(
        F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def strip_space(col: Column) -> Column:
    return F.trim(col, F.lit(SPACE))


def words(col: Column) -> Column:
    """Words in order; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), SPACE_RE), "")


def lines(col: Column) -> Column:
    """Lines split at \\n; a null or empty text is one empty line."""
    return F.split(F.coalesce(col, F.lit("")), "\n")


def shingles(word_array: Column, size: int) -> Column:
    """Distinct 64-bit hashes of ``size``-word shingles; fewer words: the whole
    sequence as one shingle; no words: empty array."""
    n = F.size(word_array)

    def at(start: Column) -> Column:
        return F.xxhash64(*[F.get(word_array, start + k) for k in range(size)])

    return (F.when(n == 0, F.array().cast("array<bigint>"))
             .when(n < size, F.array(F.xxhash64(word_array)))
             .otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), n - size), at))))


def hash128(*cols: Column) -> Column:
    """Two independently seeded 64-bit hashes, for keys whose equality stands
    for equality of long strings."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(7), *cols).alias("b"))


def without_positions(line_array: Column, drop: Column) -> Column:
    """The array without the elements at the ascending 0-based positions
    ``drop``: slices between them, so the work is linear in the array."""
    edges = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(line_array)))
    return F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(drop)),
        lambda k: F.slice(line_array, F.get(edges, k) + 2, F.get(edges, k + 1) - F.get(edges, k) - 1)))
