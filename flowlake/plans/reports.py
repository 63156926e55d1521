"""Report datasets over a date range and a polygon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.geo import geojson, within_polygon
from flowlake.functions.numeric import service_class, service_rank
from flowlake.operators.distribution import density, histogram
from flowlake.operators.incremental import between_days
from flowlake.operators.joins import lookup_join, role_join
from flowlake.operators.picks import top
from flowlake.plans.zone_function import zone_rhythm
from flowlake.sinks.reports import ReportParams
from flowlake.sinks.tables import stored


def zones_in(zones: DataFrame, polygon: str) -> DataFrame:
    """Zones whose centroid lies inside the polygon, with plain lon and lat."""
    lon, lat = F.col("centroid")["lon"], F.col("centroid")["lat"]
    inside = zones.where(within_polygon(lon, lat, polygon))
    return inside.withColumn("lon", lon).withColumn("lat", lat)


def _ends(rows: DataFrame, zones: DataFrame, polygon: str, names: tuple[str, str]) -> DataFrame:
    """Keep rows with both ends inside, and add both ends' name and point."""
    inside = zones_in(zones, polygon).select("id", "nombre", "lon", "lat")
    origin, destination = names
    return role_join(
        rows,
        inside,
        "id",
        {
            "origin_id": {"nombre": origin, "lon": "origin_lon", "lat": "origin_lat"},
            "destination_id": {"nombre": destination, "lon": "dest_lon", "lat": "dest_lat"},
        },
    )


def _origin(rows: DataFrame, zones: DataFrame, polygon: str, name: str) -> DataFrame:
    inside = zones_in(zones, polygon).select("id", F.col("nombre").alias(name))
    return lookup_join(rows, inside, {"origin_id": "id"})


ARC = ["origin", "destination", "origin_lon", "origin_lat", "dest_lon", "dest_lat"]


def od_arcs(
    typical: DataFrame, zones: DataFrame, p: ReportParams, min_trips: float = 10
) -> DataFrame:
    """Arcs between zones inside the polygon with enough average trips."""
    rows = between_days(typical, "date", p.start, p.end)
    arcs = _ends(rows, zones, p.polygon, ("origin", "destination"))
    return arcs.groupBy(*ARC).agg(F.avg("avg_trips").alias("avg_trips")).where(
        F.col("avg_trips") >= min_trips
    )


def top_origins(typical: DataFrame, zones: DataFrame, p: ReportParams, n: int = 10) -> DataFrame:
    """The n origins with the most average trips; equal ones by name."""
    rows = between_days(typical, "date", p.start, p.end)
    named = _origin(rows, zones, p.polygon, "origin")
    totals = named.groupBy("origin").agg(F.avg("avg_trips").alias("total_trips"))
    return top(totals, [F.col("total_trips").desc_nulls_last(), F.col("origin")], n)


def hourly_distribution(typical: DataFrame, zones: DataFrame, p: ReportParams) -> DataFrame:
    """Average trips by origin and hour, and their sum as the series of all municipalities."""
    rows = between_days(typical, "date", p.start, p.end)
    named = _origin(rows, zones, p.polygon, "municipality")
    series = named.groupBy("municipality", "hour").agg(F.avg("avg_trips").alias("total_trips"))
    return _with_all(series, ["municipality"], "hour", ["total_trips"], "All municipalities")


def _with_all(
    series: DataFrame, members: list[str], axis: str, measures: list[str], label: str
) -> DataFrame:
    """Series per member plus the sum over members, by grouping sets over the series rows."""
    keys = [F.col(c) for c in [*members, axis]]
    summed = series.groupingSets([keys, [F.col(axis)]], *keys).agg(
        F.grouping_id().alias("level"), *[F.sum(m).alias(m) for m in measures]
    )
    return summed.select(
        *[
            F.when(F.col("level") > 0, F.lit(label)).otherwise(F.col(m)).alias(m) for m in members
        ],
        axis,
        *measures,
    )


def mismatch_ratios(mismatch: DataFrame, zones: DataFrame, p: ReportParams) -> DataFrame:
    """Average ratio per zone pair with its origin inside the polygon."""
    pairs = (
        between_days(mismatch, "date", p.start, p.end)
        .groupBy("origin_id", "destination_id")
        .agg(F.avg("mismatch_ratio").alias("mm_ratio"))
    )
    inside = zones_in(zones, p.polygon).select("id")
    return lookup_join(pairs, inside, {"origin_id": "id"}, "left_semi")


def mismatch_histogram(
    mismatch: DataFrame, zones: DataFrame, p: ReportParams, upper: float | None = None
) -> DataFrame:
    """Fifty bins of the pair ratios, over the full range or up to ``upper``; the ratios are stored."""
    return histogram(stored(mismatch_ratios(mismatch, zones, p), "ratios"), "mm_ratio", 50, upper)


def mismatch_density(
    mismatch: DataFrame, zones: DataFrame, p: ReportParams, upper: float | None = None
) -> DataFrame:
    """The curve over those bins, over the full range or up to ``upper``."""
    return density(stored(mismatch_ratios(mismatch, zones, p), "ratios"), "mm_ratio", upper=upper)


def mismatch_table(mismatch: DataFrame, zones: DataFrame, p: ReportParams) -> DataFrame:
    """Average actual and expected trips by pair, rounded, lowest ratio first."""
    rows = _ends(
        between_days(mismatch, "date", p.start, p.end),
        zones,
        p.polygon,
        ("origin_name", "destination_name"),
    )
    return (
        rows.groupBy("origin_name", "destination_name")
        .agg(
            F.round(F.avg("actual_trips"), 2).alias("actual_trips"),
            F.round(F.avg("estimated_trips"), 2).alias("estimated_trips"),
            F.round(F.avg("mismatch_ratio"), 4).alias("mm_ratio"),
        )
        .orderBy(F.col("mm_ratio").asc_nulls_last(), "origin_name", "destination_name")
    )


def ratio_bounds(table: DataFrame) -> DataFrame:
    """Smallest and largest ratio of a mismatch table."""
    return table.agg(F.min("mm_ratio").alias("mm_min"), F.max("mm_ratio").alias("mm_max"))


def as_json_rows(report: DataFrame) -> DataFrame:
    """Each report row as one JSON text."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("json"))


def mismatch_arcs(mismatch: DataFrame, zones: DataFrame, p: ReportParams) -> DataFrame:
    """Mismatch arcs with their service band."""
    rows = _ends(
        between_days(mismatch, "date", p.start, p.end),
        zones,
        p.polygon,
        ("origin", "destination"),
    )
    arcs = rows.groupBy(*ARC).agg(
        F.avg("actual_trips").alias("actual_trips"),
        F.avg("estimated_trips").alias("estimated_trips"),
        F.avg("mismatch_ratio").alias("mm_ratio"),
    )
    banded = arcs.withColumn("service_class", service_class(F.col("mm_ratio")))
    return banded.withColumn("service_rank", service_rank(F.col("service_class")))


def in_out_distribution(
    od: DataFrame,
    functions: DataFrame,
    zones: DataFrame,
    p: ReportParams,
    end_inclusive_day: bool = True,
) -> DataFrame:
    """Departures and arrivals by municipality, type and hour, and over all of them.

    The whole last day counts. With ``end_inclusive_day=False`` it counts only at midnight, as
    when time stamps are compared with bare dates.
    """
    flows = between_days(od, "fecha", p.start, p.end)
    if not end_inclusive_day:
        flows = flows.where(F.col("fecha") <= F.lit(p.end).cast("timestamp_ntz"))
    inside = zones_in(zones, p.polygon).select("id", F.col("nombre").alias("municipality"))
    rhythm = lookup_join(zone_rhythm(flows, inside.select("id")), inside, {"zone_id": "id"})
    typed = lookup_join(rhythm, functions, {"zone_id": "zone_id"})
    measures = ["avg_out_trips", "avg_in_trips"]
    series = typed.groupBy("municipality", "functional_type", "hour").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return _with_all(series, ["municipality", "functional_type"], "hour", measures, "All")


def zone_geojson(zones: DataFrame, functions: DataFrame, polygon: str) -> DataFrame:
    """Name, GeoJSON geometry and functional type of the zones inside the polygon."""
    typed = lookup_join(zones_in(zones, polygon), functions, {"id": "zone_id"})
    return typed.select(
        F.col("nombre").alias("name"), geojson(F.col("geometry")).alias("geometry"), "functional_type"
    )
