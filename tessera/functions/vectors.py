"""Dense vectors and bit strings as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """A vector over its length (a billionth more, so zero vectors stay)."""
    length = F.sqrt(dot(v, v)) + 1e-9
    return F.transform(v, lambda x: x.cast("double") / length)


def bits_of(digits: Column) -> Column:
    """The 64 bits (long) of 16 hexadecimal digits, read by halves, as the top bit has no sign."""
    half = lambda at: F.conv(F.substring(digits, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit values in 16 hexadecimal digits."""
    return F.bit_count(bits_of(a).bitwiseXOR(bits_of(b)))


def difference_hash(pixels: Column) -> Column:
    """64-bit hash of a 9 by 8 grey image (72 values by rows): one bit for each value darker than its left neighbour."""
    rows = F.sequence(F.lit(0), F.lit(7))
    nibble = lambda r, c: F.aggregate(
        F.sequence(F.lit(0), F.lit(3)), F.lit(0), lambda s, k: s * 2 + F.when(F.get(pixels, r * 9 + c * 4 + k) > F.get(pixels, r * 9 + c * 4 + k + 1), 1).otherwise(0)
    )
    return F.array_join(F.flatten(F.transform(rows, lambda r: F.transform(F.sequence(F.lit(0), F.lit(1)), lambda c: F.lower(F.hex(nibble(r, c)))))), "")
