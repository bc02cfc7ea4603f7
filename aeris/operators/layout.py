"""Files laid out along a space-filling curve over several columns.

A table sorted by day holds one sensor's history in every file, one sorted by sensor holds each day in every file. Along
a Z-order curve over the ranks of both, a file covers a small range of each, so that Parquet's minima and maxima let a
one-day and a one-sensor read alike skip most row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Quantiles by which a column's values are ranked; between two of them ranks are linear.
CUTS = 64
#: Bits of a rank; those of all columns make one long.
BITS = 16


def rank_cuts(df: DataFrame, by: dict[str, Column], cuts: int = CUTS) -> dict[str, list[float]]:
    """Distinct quantiles of each numeric expression, at most ``cuts + 1`` each: all that reaches the driver."""
    shares = [i / cuts for i in range(cuts + 1)]
    row = df.agg(*[F.percentile_approx(e.cast("double"), shares).alias(n) for n, e in by.items()]).first()
    return {n: sorted(set(row[n] or [])) for n in by}


def rank(x: Column, cuts: list[float], bits: int = BITS) -> Column:
    """Rank of ``x`` in [0, 2 ** bits), nondecreasing in ``x`` and spread evenly over the values that ``cuts`` are the
    quantiles of. NULL has the rank 0; values outside the cuts have that of the nearest."""
    top = (1 << bits) - 1
    if len(cuts) < 2:
        return F.lit(0).cast("long")
    x, steps = x.cast("double"), len(cuts) - 1

    def among(lo: int, hi: int) -> Column:  # a binary search as nested conditions
        if hi - lo == 1:
            return F.lit(float(lo)) + (x - F.lit(cuts[lo])) / F.lit(cuts[hi] - cuts[lo])
        mid = (lo + hi) // 2
        return F.when(x < F.lit(cuts[mid]), among(lo, mid)).otherwise(among(mid, hi))

    place = F.floor(among(0, steps) / F.lit(float(steps)) * F.lit(float(top + 1)))
    return F.when(x.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(top), place))).cast("long")


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """The bits of all ranks by turns, the highest first: the place on the Z-order curve."""
    if bits * len(ranks) > 62:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit a long")
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, r in enumerate(ranks):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(ranks) + k))
    return out


def along_curve(df: DataFrame, by: dict[str, Column], bits: int = BITS, files: int | None = None) -> DataFrame:
    """``df`` dealt in ranges of the curve over the numeric expressions ``by``, and sorted along it in each. ``df`` is read
    for its quantiles, for the ranges and for the rows, so it should be a stored table. Rows at one place of the curve are
    told apart by a hash of their content, so that a hot one is split. ``files`` names the number of ranges; otherwise
    Spark's partition sizes do."""
    cuts = rank_cuts(df, by)
    names = [f"__rank{i}" for i in range(len(by))]
    ranked = df.select("*", *[rank(e, cuts[n], bits).alias(name) for name, (n, e) in zip(names, by.items())])
    hashed = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    keyed = ranked.select(*df.columns, interleaved([F.col(n) for n in names], bits).alias("__curve"), F.xxhash64(*hashed).alias("__tie"))
    ranges = keyed.repartitionByRange(*([files] if files else []), "__curve", "__tie")
    return ranges.sortWithinPartitions("__curve", "__tie").drop("__curve", "__tie")


def day_and_sensor(day: str = "day", sensor: str = "sensor_id") -> dict[str, Column]:
    """The two columns that measurements are asked for by. A text that is no day counts as NULL."""
    return {day: F.unix_date(F.try_to_date(day)), sensor: F.col(sensor)}
