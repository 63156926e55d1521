"""Gravity model: expected trips from population, companies and distance."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.geo import distance_km
from flowlake.operators.incremental import between_days
from flowlake.operators.joins import role_join
from flowlake.plans.od import wanted_days
from flowlake.sinks.tables import stored

# The grid on which the scale factor is chosen.
K_LOW, K_HIGH, K_POINTS = 10e-5, 1.0, 5000


def latest_year(od: DataFrame, column: str = "fecha") -> int:
    """The year of the newest flow; a table with a year partition answers without a data scan."""
    newest = F.max("year") if "year" in od.columns else F.year(F.max(column))
    year = od.agg(newest.alias("year")).first().year
    if year is None:
        raise ValueError("no flows to take a year from")
    return year


def _attributes(zones: DataFrame, profile: DataFrame, year: int | None) -> DataFrame:
    """Zone points with population and companies, NULL where the profile (of the year) lacks them."""
    if year is not None:
        profile = profile.where(F.col("year").cast("string").try_cast("int") == year)
    indicators = profile.select(
        "id",
        F.col("poblacion_total").alias("population"),
        F.col("empresas").alias("activity"),
    )
    repeated = indicators.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError("the profile must hold one row per zone; filter it to one year")
    points = zones.select(
        "id", F.col("centroid")["lon"].alias("lon"), F.col("centroid")["lat"].alias("lat")
    )
    return points.join(indicators, "id", "left")


def daily_pairs(od: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Trips by (origin, destination, date): all the model reads of the fact."""
    return (
        od.where(wanted_days(od, "fecha", days))
        .groupBy(
            F.col("origen_zone_id").alias("origin_id"),
            F.col("destino_zone_id").alias("destination_id"),
            F.to_date("fecha").alias("date"),
        )
        .agg(F.sum("viajes").alias("actual_trips"))
    )


def _oriented(daily: DataFrame, symmetric: bool) -> DataFrame:
    """Pairs that have a distance: origin before destination, or any two zones if symmetric."""
    o, d = F.col("origin_id"), F.col("destination_id")
    return daily.where(o != d if symmetric else o < d)


def _with_pull(pairs: DataFrame, attributes: DataFrame) -> DataFrame:
    """Add ``pull``: population of the origin × companies of the destination / distance².

    The distance comes from the two centroids of each pair, so no table of all pairs is needed.
    """
    placed = role_join(
        pairs,
        attributes,
        "id",
        {
            "origin_id": {"population": "population", "lon": "lon1", "lat": "lat1"},
            "destination_id": {"activity": "activity", "lon": "lon2", "lat": "lat2"},
        },
    )
    km = distance_km(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    pull = F.try_divide(F.col("population") * F.col("activity"), F.pow(km, 2))
    return placed.select(*pairs.columns, pull.alias("pull"))


def gravity_base(
    od: DataFrame,
    zones: DataFrame,
    profile: DataFrame,
    year: int | None = None,
    symmetric: bool = False,
) -> DataFrame:
    """Trips of one year by zone pair with the unscaled expectation ``gravity_no_k``."""
    year = latest_year(od) if year is None else year
    of_year = between_days(od, "fecha", f"{year}-01-01", f"{year}-12-31")
    return gravity_base_of(daily_pairs(of_year), zones, profile, year, symmetric)


def gravity_base_of(
    daily: DataFrame, zones: DataFrame, profile: DataFrame, year: int, symmetric: bool = False
) -> DataFrame:
    """The same from daily pair totals."""
    pairs = (
        _oriented(between_days(daily, "date", f"{year}-01-01", f"{year}-12-31"), symmetric)
        .groupBy("origin_id", "destination_id")
        .agg(F.sum("actual_trips").alias("actual_trips"))
    )
    return _with_pull(pairs, _attributes(zones, profile, year)).withColumnRenamed(
        "pull", "gravity_no_k"
    )


def fit_gravity_k(base: DataFrame) -> DataFrame:
    """One row: the grid value of k with the smallest root mean square error, and that error.

    The squared error is a parabola in k with its vertex at Σ(a·g) / Σ(g²), so its minimum on the
    grid is the grid point nearest the vertex: one aggregate instead of a scan per grid point. A
    second aggregate over the pairs gives the error itself, which those sums would cancel. Pairs
    without an expectation take no part.
    """
    a, g = F.col("actual_trips"), F.col("gravity_no_k")
    expected = base.where(g.isNotNull())
    sums = expected.agg(F.sum(a * g).alias("ag"), F.sum(g * g).alias("gg")).first()
    vertex = sums.ag / sums.gg if sums.ag is not None and sums.gg else K_LOW
    step = (K_HIGH - K_LOW) / (K_POINTS - 1)
    index = min(max(math.ceil((vertex - K_LOW) / step - 0.5), 0), K_POINTS - 1)
    k = F.lit(K_LOW + index * step)
    rmse = F.sqrt(F.avg(F.pow(a - k * g, F.lit(2.0))))
    return expected.agg(k.alias("k"), rmse.alias("rmse"), F.count("*").alias("pairs"))


def best_k(od: DataFrame, zones: DataFrame, profile: DataFrame, symmetric: bool = False) -> float:
    """The scale factor fitted on the newest year."""
    return fit_gravity_k(gravity_base(od, zones, profile, symmetric=symmetric)).first().k


def gravity_mismatch(
    od: DataFrame, zones: DataFrame, profile: DataFrame, k: float, symmetric: bool = False
) -> DataFrame:
    """Actual and expected trips by (origin, destination, date), and their ratio.

    Where nothing is expected the ratio is NULL.
    """
    return gravity_mismatch_of(daily_pairs(od), zones, profile, k, symmetric)


def gravity_mismatch_of(
    daily: DataFrame, zones: DataFrame, profile: DataFrame, k: float, symmetric: bool = False
) -> DataFrame:
    """The same from daily pair totals."""
    placed = _with_pull(_oriented(daily, symmetric), _attributes(zones, profile, None))
    expected = placed.withColumn(
        "estimated_trips", F.lit(k) * F.col("pull")
    )
    return expected.drop("pull").withColumn(
        "mismatch_ratio", F.try_divide("actual_trips", "estimated_trips")
    )


def gravity_model(
    od: DataFrame, zones: DataFrame, profile: DataFrame, daily: DataFrame | None = None, year: int | None = None
) -> DataFrame:
    """Fit the scale factor on the newest year, then compare every day's flows with the expectation.

    The fact is read once, for its daily pair totals, which are written; ``daily`` gives them where
    they exist already.
    """
    daily = stored(daily_pairs(od), "daily-pairs") if daily is None else daily
    year = latest_year(daily, "date") if year is None else year
    k = fit_gravity_k(gravity_base_of(daily, zones, profile, year)).first().k
    return gravity_mismatch_of(daily, zones, profile, k)
