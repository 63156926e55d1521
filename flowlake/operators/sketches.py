"""Moments and quantile sketches by day, merged over any range of days.

A day's summary is written once, beside the daily table. A range then needs its summaries only: moments
add up exactly, and the merged sketch says between which values a quantile lies, so that the exact pass
over the range's rows sorts the few values inside that bracket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.operators.distribution import WALKED_VALUES, exact_quantiles, values_at
from flowlake.operators.incremental import as_day, between_days
from flowlake.sinks.tables import stored

#: Size parameter of the sketches, and the share of ranks by which a bracket reaches beyond the wanted one.
SKETCH_SIZE, SLACK = 400, 0.02


def day_summaries(df: DataFrame, day: str, value: str, keys: list[str], sketch: bool = False) -> DataFrame:
    """(date, keys, n, mean, spread, low, high and, if wanted, sketch) of the values that are not null or NaN.

    ``spread`` is the sum of squared deviations from the mean.
    """
    v = F.col(value).cast("double")
    known = df.select(as_day(df, day).alias("date"), *keys, v.alias("v")).where(v.isNotNull() & ~F.isnan(v))
    made = [
        F.count("*").alias("n"),
        F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("*")).alias("spread"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    ]
    if sketch:
        made.append(F.kll_sketch_agg_double("v", F.lit(SKETCH_SIZE)).alias("sketch"))
    return known.groupBy("date", *keys).agg(*made)


def range_moments(summaries: DataFrame, start: str, end: str, keys: list[str]) -> DataFrame:
    """(keys, n, mean, sd, low, high) over a closed range of days; sd is null for a single value."""
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    merged = between_days(summaries, "date", start, end).groupBy(*keys).agg(
        n.alias("n"),
        (total / n).alias("mean"),
        F.sum("spread").alias("spread"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    apart = F.greatest(F.col("squares") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    sd: Column = F.when(F.col("n") > 1, F.sqrt((F.col("spread") + apart) / (F.col("n") - 1)))
    return merged.select(*keys, "n", "mean", sd.alias("sd"), "low", "high").where("n > 0")


def range_quantiles(
    df: DataFrame, day: str, value: str, summaries: DataFrame, start: str, end: str, probabilities: list[float]
) -> list[float]:
    """Exact, linearly interpolated quantiles of a closed range of days, bracketed by its merged sketches.

    ``summaries`` are the days' of :func:`day_summaries` with a sketch and without keys. One pass counts the
    rows below each bracket and keeps the values inside; if a wanted rank should lie outside, which the sketch makes
    unlikely, that quantile is found from all values. A range without values has none.
    """
    merged = between_days(summaries, "date", start, end).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch")
    )
    total = merged.first().n
    if not total:
        return []
    positions = [p * (total - 1) for p in probabilities]
    ends = [(math.floor(p) / total - SLACK, (math.ceil(p) + 1) / total + SLACK) for p in positions]
    shares = F.array(*[F.lit(min(max(share, 0.0), 1.0)) for pair in ends for share in pair])
    cuts = merged.select(F.kll_sketch_get_quantile_double("sketch", shares).alias("q")).first().q
    brackets = [
        (-math.inf if low <= 0 else cuts[2 * i], math.inf if high >= 1 else cuts[2 * i + 1]) for i, (low, high) in enumerate(ends)
    ]
    v = F.col(value).cast("double")
    rows = between_days(df, day, start, end)
    values = rows.select(v.alias("v")).where(v.isNotNull() & ~F.isnan(v))
    within = [F.col("v").between(F.lit(low), F.lit(high)) for low, high in brackets]
    below = values.agg(*[F.count_if(F.col("v") < F.lit(low)).alias(f"b{i}") for i, (low, _) in enumerate(brackets)]).first()
    wanted = within[0]
    for more in within[1:]:
        wanted = wanted | more
    counts = stored(values.where(wanted).groupBy("v").agg(F.count("*").alias("n")), "bracket-counts")
    held = counts.agg(*[F.coalesce(F.sum(F.when(w, F.col("n"))), F.lit(0)).alias(f"h{i}") for i, w in enumerate(within)]).first()
    found = []
    for i, position in enumerate(positions):
        low, high = math.floor(position), math.ceil(position)
        if not below[i] <= low <= high < below[i] + held[i]:
            found += exact_quantiles(values, "v", [probabilities[i]])
            continue
        at = values_at(counts.where(within[i]), {low, high}, below[i], 128, WALKED_VALUES)
        found.append(at[low] + (at[high] - at[low]) * (position - low))
    return found
