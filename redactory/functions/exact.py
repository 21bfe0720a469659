"""Rounding and sums of doubles that depend on the values alone, not on how the rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Doubles from here on are whole numbers.
WHOLE = float(2**52)
#: A sum's digits: a double is cut at these powers of two into whole numbers of less than 2^50.
POWERS = (40, -10, -60, -110)
LARGEST = float(2**90)


def round1(x: Column) -> Column:
    """One decimal, of the exact binary value, halves to the even digit: 2.25 gives 2.2, and 0.05, which is a little more
    than that, gives 0.1.

    Twenty times x is taken as a sum of two doubles without error (x is split in halves of 26 bits, whose products with
    20 are exact), so that the distance to the middle between two tenths is exact too."""
    x = x.cast("double")
    large = F.abs(x) >= F.lit(float(2**48))  # there the part below one is exact by itself, and smaller ones are scaled whole
    whole = F.when(large, F.floor(x).cast("double")).otherwise(0.0)
    y = F.when(large, x - F.floor(x).cast("double")).otherwise(x)
    high = y * F.lit(134217729.0) - (y * F.lit(134217729.0) - y)
    twenty = y * F.lit(20.0)
    error = (high * F.lit(20.0) - twenty) + (y - high) * F.lit(20.0)
    tenths = F.floor((twenty + F.lit(1.0)) / F.lit(2.0)).cast("double")
    low, top = tenths * F.lit(2.0) - F.lit(1.0), tenths * F.lit(2.0) + F.lit(1.0)  # the middles on both sides
    odd = F.pmod(tenths, F.lit(2.0)) == 1.0
    down = (twenty < low) | ((twenty == low) & ((error < 0.0) | ((error == 0.0) & odd)))
    up = (twenty > top) | ((twenty == top) & ((error > 0.0) | ((error == 0.0) & odd)))
    tenths = tenths + F.when(down, -1.0).when(up, 1.0).otherwise(0.0)
    return F.when((F.abs(x) >= WHOLE) | F.isnan(x), x).otherwise(whole + tenths / F.lit(10.0))


def exact_sum(x: Column) -> Column:
    """The sum of doubles below 2^90, in any order the same: their parts are summed as whole numbers, exactly to 2^-110, and
    put together once. Larger and infinite ones, and NaN, are summed as doubles. Null where there are none."""
    x = x.cast("double")
    wild = ~(F.abs(x) < LARGEST)
    tame = F.when(wild, 0.0).otherwise(x)
    at = [F.rint(tame / F.lit(2.0**p)) for p in POWERS]  # scaling by powers of two is exact
    parts = [at[0], *(low - high * F.lit(2.0**50) for high, low in zip(at, at[1:], strict=False))]
    sums = [F.sum(p.cast("long").cast("decimal(28,0)")) for p in parts]
    # what the second part holds beyond 2^50 is carried up, so that the first two do not overlap
    size = F.lit(2**50).cast("decimal(38,0)")
    low = sums[1] % size
    high = sums[0] + ((sums[1] - low) / size).cast("decimal(38,0)")
    whole = high.cast("double") * F.lit(2.0 ** POWERS[0]) + (low.cast("double") * F.lit(2.0 ** POWERS[1]) + (sums[2].cast("double") * F.lit(2.0 ** POWERS[2]) + sums[3].cast("double") * F.lit(2.0 ** POWERS[3])))
    return F.when(F.count_if(wild) > 0, F.sum(x)).otherwise(whole)
