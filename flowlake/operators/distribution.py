"""Histograms, density curves and exact quantiles of one numeric column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from flowlake.sinks.tables import stored

#: Fixed value: grid points of a density curve.
DENSITY_POINTS = 200


def _values(df: DataFrame, column: str, upper: float | None) -> DataFrame:
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    return values if upper is None else values.where(F.col("v") <= F.lit(upper))


def _bounds(values: DataFrame) -> Row:
    """lo, hi, n, sd of the values; a single-valued column gets a range of one around it."""
    half = F.when(F.min("v") == F.max("v"), F.lit(0.5)).otherwise(F.lit(0.0))
    return values.agg(
        (F.min("v") - half).alias("lo"),
        (F.max("v") + half).alias("hi"),
        F.count("v").alias("n"),
        F.stddev_samp("v").alias("sd"),
    ).first()


def histogram(df: DataFrame, column: str, bins: int = 50, upper: float | None = None) -> DataFrame:
    """Equal-width bins over the full range, or over the values up to ``upper``.

    Every bin appears, also empty ones; the maximum belongs to the last bin. The range is read
    first, so the counting pass is one aggregation with literal bounds.
    """
    values = _values(df, column, upper)
    bounds = _bounds(values)
    count = bins if bounds.n else 0
    lo, hi = (bounds.lo, bounds.hi) if bounds.n else (0.0, 1.0)
    share = (F.col("v") - F.lit(lo)) / F.lit(hi - lo)
    counted = (
        values.select(F.least(F.floor(share * bins) + 1, F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    width = (hi - lo) / bins
    numbers = df.sparkSession.range(1, count + 1, 1, 1).select(F.col("id").cast("int").alias("bin"))
    return numbers.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.lit(width) * (F.col("bin") - 1)).alias("lower"),
        (F.lit(lo) + F.lit(width) * F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("frequency"),
    )


def density(df: DataFrame, column: str, bins: int = 50, upper: float | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid, in the count units of the histogram.

    Scott bandwidth ``sd · n^(-1/5)``; no curve for values without spread. Equal values collapse
    into counts; each distinct one adds to every grid point, and the sums combine inside each task, so what is shuffled is one row per
    grid point and task.
    """
    values = _values(df, column, upper)
    bounds = _bounds(values)
    if not bounds.sd:
        values, bounds = values.limit(0), Row(lo=0.0, hi=1.0, n=1, sd=1.0)
    span, last = bounds.hi - bounds.lo, DENSITY_POINTS - 1
    bandwidth = bounds.sd * bounds.n**-0.2
    scale = span / bins / (bandwidth * math.sqrt(2 * math.pi))
    x = F.lit(bounds.lo) + F.lit(span) * F.col("point") / last
    distance = (x - F.col("v")) / F.lit(bandwidth)
    return (
        values.groupBy("v")
        .agg(F.count("*").alias("n"))
        .select("v", "n", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("point"))
        .groupBy("point")
        .agg((F.sum(F.col("n") * F.exp(-0.5 * distance * distance)) * F.lit(scale)).alias("density"))
        .select("point", x.alias("x"), "density")
    )


#: So many distinct values are read and walked through on the driver; more are narrowed first.
WALKED_VALUES = 4096


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], buckets: int = 128, walked: int = WALKED_VALUES
) -> list[float]:
    """Linearly interpolated quantiles, exact, without sorting many values in one task.

    Equal values collapse into counts, which are written. Approximate cut points split the distinct
    values into buckets of like size, whose totals tell which ones hold the wanted ranks; those are cut
    again until ``walked`` distinct values or fewer are left to read.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    counts = stored(values.groupBy("v").agg(F.count("*").alias("n")), "value-counts")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return []
    positions = [p * (total - 1) for p in probabilities]
    ranks = {f(position) for position in positions for f in (math.floor, math.ceil)}
    at = values_at(counts, ranks, 0, buckets, walked)

    def between(position: float) -> float:
        low, high = at[math.floor(position)], at[math.ceil(position)]
        return low + (high - low) * (position - math.floor(position))

    return [between(position) for position in positions]


def values_at(counts: DataFrame, ranks: set[int], before: int, buckets: int, walked: int) -> dict[int, float]:
    """The value at each rank, where ``before`` values come ahead of these (value, count) rows."""
    found = {}
    if counts.count() <= walked:
        for row in sorted(counts.collect()):
            found |= {k: row.v for k in ranks if before <= k < before + row.n}
            before += row.n
        return found
    shares = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(counts.agg(F.percentile_approx("v", shares, 10_000)).first()[0]))
    bucket = F.size(F.filter(F.lit(cuts), lambda cut: cut < F.col("v")))
    for number, size in sorted(counts.groupBy(bucket).agg(F.sum("n")).collect()):
        if wanted := {k for k in ranks if before <= k < before + size}:
            inside = counts.where(F.col("v") > cuts[number - 1]) if number else counts
            inside = inside.where(F.col("v") <= cuts[number]) if number < len(cuts) else inside
            found |= values_at(inside, wanted, before, buckets, walked)
        before += size
    return found


def quantile_class(df: DataFrame, column: str, classes: int = 5, out: str = "class") -> DataFrame:
    """Colour class 1 … n of a value: one more than the number of quantile cuts at or below it."""
    cuts = exact_quantiles(df, column, [i / classes for i in range(1, classes)])
    value: Column = F.col(column)
    passed = sum((F.when(value >= cut, 1).otherwise(0) for cut in cuts), F.lit(1))
    return df.withColumn(out, F.when(value.isNotNull(), passed))
