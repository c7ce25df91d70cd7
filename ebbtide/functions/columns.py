"""Column expressions shared by the operators; all stay inside codegen."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def flag(condition: Column) -> Column:
    """0/1 column; an unknown (NULL) comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def both(*flags: Column) -> Column:
    """Conjunction of 0/1 columns."""
    out = flags[0]
    for f in flags[1:]:
        out = out.bitwiseAND(f)
    return out


def number(column: Column) -> Column:
    """Lossy numeric coercion of text: what does not parse becomes NULL, as does NaN.

    The pattern keeps out what the JVM parser would accept on top of plain
    decimal notation (hexadecimal floats, a trailing `d` or `f`).
    """
    text = column.cast("string")
    value = F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(value), value)


def lookup(column: Column, mapping: Mapping, default) -> Column:
    """Value map with a default for unknown and NULL keys."""
    out = None
    for key, value in mapping.items():
        out = (F if out is None else out).when(column == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def count_equal(columns: Iterable[str], value: str) -> Column:
    """How many of the columns hold `value`."""
    return sum((flag(F.col(c) == value) for c in columns), F.lit(0))


def keyed_hash(columns: Iterable[str], seed: int) -> Column:
    """Uniform 32-hex order key: md5 of the key columns and the seed."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def double_bits(value: Column) -> Column:
    """A long that sorts as the double does: its IEEE 754 bits, negated for negative numbers. NaN sorts last; -0.0 is 0.0.

    Exponent and fraction come from exact steps (powers of two), as there is no built-in for the bits.
    """
    least, unit = 2.0 ** -1022, 2.0 ** 52
    size = F.abs(value)
    normal = F.greatest(F.least(size, F.lit(1.7976931348623157e308)), F.lit(least))
    guess = F.floor(F.log2(normal)).cast("int")  # rounding can put it off by one
    part = normal / F.pow(F.lit(2.0), guess.cast("double"))
    exponent = F.when(part >= 2, guess + 1).when(part < 1, guess - 1).otherwise(guess)
    fraction = ((normal / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * unit).cast("long")
    bits = (exponent + 1023).cast("long") * F.lit(1 << 52) + fraction
    image = (F.when(size == float("inf"), F.lit(2047 << 52))
             .when(size < least, (size * 2.0 ** 537 * 2.0 ** 537).cast("long")).otherwise(bits))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(value < 0, -image).when(value.isNotNull(), image)


def double_of(image: int) -> float:
    """The double that `double_bits` made an image of."""
    if image == (1 << 63) - 1:
        return float("nan")
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(image)))[0], image)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double that gives 0 on a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def stratum(columns: Iterable[str]) -> Column:
    """Composite stratum key joined by a double underscore."""
    return F.concat_ws("__", *[F.col(c).cast("string") for c in columns])


def doubles(values: Iterable[float]) -> Column:
    """Literal array of doubles, parsed in one call."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def level_of(cuts: Sequence[float], value: Column) -> Column:
    """Number of the sorted `cuts` that `value` reaches; a missing value reaches none. A balanced tree of comparisons, in codegen."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(float(cuts[middle])), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(cuts))


def with_cut_index(df: DataFrame, cuts: str, value: str, size: int, name: str) -> DataFrame:
    """Adds the number of values of the sorted array column `cuts`, of up to `size`, that are below `value`.

    Binary search by powers of two, a projection for each step, so that every step stays inside codegen. Never NULL: as a
    join key it then gets no inferred filter, which would be pushed under the aggregation and evaluated for every row.
    A step names the step before it twice: where the optimizer puts the steps into one expression, each further name in a
    step multiplies its size again, in the driver's memory.
    """
    step = 1 << size.bit_length()
    df = df.withColumn(name, F.lit(0))
    while step > 1:
        step //= 2
        below = F.get(cuts, F.col(name) + (step - 1)) < F.col(value)
        df = df.withColumn(name, F.col(name) + flag(below) * F.lit(step))
    return df
