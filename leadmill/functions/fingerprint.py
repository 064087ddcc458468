"""Bit fingerprints as arrays of longs (32 bits in each), and their Tanimoto similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 32


def sign_bits(vector: Column, bits: int) -> Column:
    """A bit for each component above zero."""

    def word(start: int) -> Column:
        part = F.slice(vector, start + 1, WORD)
        bit = lambda x, k: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.transform(part, bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return F.array(*(word(s) for s in range(0, bits, WORD)))


def popcount(fp: Column) -> Column:
    return F.aggregate(F.transform(fp, lambda x: F.bit_count(x)), F.lit(0), lambda a, x: a + x).cast("long")


def common(a: Column, b: Column, words: int | None = None) -> Column:
    """Bits in both. Of few words, this is a plain sum, which Spark compiles; of 32 the compiled form is slower than the functions."""
    if words is not None and words <= 8:
        each = (F.coalesce(F.bit_count(F.get(a, F.lit(k)).bitwiseAND(F.get(b, F.lit(k)))), F.lit(0)) for k in range(words))
        return reduce(lambda x, y: x + y, each, F.lit(0)).cast("long")
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x).cast("long")


def set_bits(fp: Column) -> Column:
    """Numbers of the bits that are set, from 0, ascending."""
    word = lambda x, k: F.transform(F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("getbit", x, i) == 1), lambda i: i + WORD * k)
    return F.flatten(F.transform(fp, word))


def tanimoto(i: Column, na: Column, nb: Column) -> Column:
    """From the common bits and both counts; null if neither has a bit."""
    return i.cast("double") / F.nullif(na + nb - i, F.lit(0))
