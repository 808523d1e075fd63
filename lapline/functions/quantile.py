"""Exact quantiles of a column of any size (C08): a rank is sought in counted ranges.

A pass counts the rows of ``BUCKETS`` equal parts of each range still sought, with their smallest and largest value; the part
that holds the rank is the next range.  It ends when that part is one value.  Each pass keeps at most
``BUCKETS`` counts a rank in any task or on the driver, and cuts the rows looked at by as much.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _ranked(values: DataFrame, ranks: list[int], low: float, high: float) -> list[float]:
    """The values at ``ranks`` (from 0, ascending) of column ``v``, whose range is [low, high]."""
    ranges = {r: (low, high, 0) for r in ranks}        # smallest and largest value, rows below
    while open_ := sorted({(a, b) for a, b, _ in ranges.values() if a < b}):
        part = F.lit(None).cast("long")
        for i, (a, b) in enumerate(open_):
            by = 2.0 if math.isinf(b - a) else 1.0     # halves of a range wider than the largest double
            place = F.floor((F.col("v") / by - F.lit(a / by)) / F.lit(b / by - a / by) * BUCKETS)
            part = F.when(F.col("v").between(a, b), i * BUCKETS + F.least(place, F.lit(BUCKETS - 1))).otherwise(part)
        counts = values.select("v", part.cast("long").alias("p")).filter("p IS NOT NULL").groupBy("p").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        rows = sorted(map(tuple, counts.collect()))
        for rank, (a, b, below) in ranges.items():
            if a < b:
                mine = open_.index((a, b))
                for p, n, lo, hi in rows:
                    if p // BUCKETS == mine:
                        if rank < below + n:
                            ranges[rank] = (lo, hi, below)
                            break
                        below += n
    return [ranges[r][0] for r in ranks]


def exact_quantile(df: DataFrame, value: Column, q: float = 0.5) -> float | None:
    """The exact quantile, interpolated between neighbouring values (nulls, NaN and infinities left out); None without values."""
    v = value.cast("double")
    values = df.select(v.alias("v")).filter("v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')")
    n, low, high = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return None
    place = (n - 1) * q
    ranks = [math.floor(place), math.ceil(place)]
    below, above = _ranked(values, ranks, low, high)
    return below if ranks[0] == ranks[1] else (ranks[1] - place) * below + (place - ranks[0]) * above
