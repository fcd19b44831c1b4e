"""human-readable file size, computed exactly in integer arithmetic.

Rule: 0 -> ``0 B``; below 100 -> ``n B``; otherwise divide by 1024 into KB and
keep dividing while the value is >= 1000 (up to TB). Values below 10 get two
decimals, below 100 one decimal, else the integer part. The divisor is a power
of two, so the quotient is exact: rounding is done on integers (shift and
mask) with round-half-even, which is what formatting the exact binary value
gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed unit names, smallest first.
UNITS = ["B", "KB", "MB", "GB", "TB"]


# (bits to shift, unit, exclusive upper bound of the byte count for this unit)
_STEPS = [(10, UNITS[1], 1000 * 1024), (20, UNITS[2], 1000 * 1024 ** 2),
          (30, UNITS[3], 1000 * 1024 ** 3), (40, UNITS[4], None)]


def _scaled(b: Column, mult: int, shift: int) -> Column:
    """round-half-even(b * mult / 2**shift) in exact integers."""
    n = b * F.lit(mult).cast("bigint")
    q = F.shiftright(n, shift)
    r = n - F.shiftleft(q, shift)
    half = F.lit(1 << (shift - 1)).cast("bigint")
    up = (r > half) | ((r == half) & (F.pmod(q, F.lit(2)) == 1))
    return q + F.when(up, F.lit(1)).otherwise(F.lit(0))


def _in_unit(b: Column, shift: int, unit: str) -> Column:
    q100, q10 = _scaled(b, 100, shift), _scaled(b, 10, shift)
    two = F.concat((q100 / 100).cast("bigint").cast("string"), F.lit("."),
                   F.lpad(F.pmod(q100, F.lit(100)).cast("string"), 2, "0"))
    one = F.concat((q10 / 10).cast("bigint").cast("string"), F.lit("."),
                   F.pmod(q10, F.lit(10)).cast("string"))
    whole = F.shiftright(b, shift).cast("string")
    d = F.lit(1 << shift).cast("bigint")
    # b / d < 10  <=>  b < 10 d ;  b / d < 100  <=>  b < 100 d
    num = F.when(b < d * 10, two).when(b < d * 100, one).otherwise(whole)
    return F.concat(num, F.lit(" " + unit))


def human_size(col) -> Column:
    b = (col if isinstance(col, Column) else F.col(col)).cast("bigint")
    out = F.when(b == 0, F.lit("0 B")).when(b < 100, F.concat(b.cast("string"), F.lit(" B")))
    for shift, unit, hi in _STEPS:
        out = out.when(b < hi, _in_unit(b, shift, unit)) if hi else out.when(b.isNotNull(), _in_unit(b, shift, unit))
    return out
