"""Zone dimension: name mapping, boundaries, distances, socio-economic profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.geo import centroid, distance_km, is_valid_geometry, parse_wkt
from flowlake.functions.text import label_token, normalise_name
from flowlake.operators.joins import role_join

INCOME_SERIES = "renta neta media por persona"


def name_map(municipalities: DataFrame, relation: DataFrame) -> DataFrame:
    """Distinct (normalised name, municipality code, zone).

    Both sides shrink to distinct pairs first: the relation has a row per census section, and
    what is joined afterwards is one row per code and name with one per code and zone.
    """
    named = (
        municipalities.where(F.col("Codigo").isNotNull() & F.col("Nombre").isNotNull())
        .select(normalise_name(F.col("Nombre")).alias("nombre"), F.col("Codigo").alias("codigo_ine"))
        .distinct()
    )
    zones = (
        relation.where(F.col("municipio_mitma").isNotNull() & F.col("municipio_ine").isNotNull())
        .select(F.col("municipio_ine").alias("codigo_ine"), "municipio_mitma")
        .distinct()
    )
    return named.join(zones, "codigo_ine").select("nombre", "codigo_ine", "municipio_mitma")


def ambiguous_names(mapping: DataFrame) -> DataFrame:
    """Names that stand for more than one municipality code, which share one series value."""
    codes = mapping.select("nombre", "codigo_ine").distinct()
    return codes.groupBy("nombre").agg(F.count("*").alias("n_codes")).where("n_codes > 1")


def zones(zone_raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapped zones with parsed geometry and centroid.

    Duplicates go while the geometry is still text, so no parsed array is shuffled.
    """
    complete = zone_raw.where(
        F.col("ID").isNotNull() & F.col("Nombre").isNotNull() & F.col("geometry").isNotNull()
    ).select(F.col("ID").alias("id"), F.col("Nombre").alias("nombre"), F.col("geometry").alias("wkt"))
    known = mapping.select(F.col("municipio_mitma").alias("id")).distinct()
    mapped = complete.distinct().join(known, "id", "left_semi")
    parsed = mapped.select("id", "nombre", parse_wkt(F.col("wkt")).alias("geometry"))
    return parsed.withColumn("centroid", centroid(F.col("geometry")))


def invalid_zones(zone_raw: DataFrame) -> DataFrame:
    """Zones whose geometry text is not a usable (multi)polygon."""
    bad = F.col("geometry").isNotNull() & ~is_valid_geometry(F.col("geometry"))
    return zone_raw.where(bad).select(F.col("ID").alias("id"), "geometry")


def pair_distances(pairs: DataFrame, zones: DataFrame, swap_axes: bool = False) -> DataFrame:
    """Great-circle kilometres for given (origin, destination) pairs, by two zone lookups."""
    x, y = ("lat", "lon") if swap_axes else ("lon", "lat")
    points = zones.select(
        "id", F.col("centroid")[x].alias("lon"), F.col("centroid")[y].alias("lat")
    )
    placed = role_join(
        pairs,
        points,
        "id",
        {"origin": {"lon": "lon1", "lat": "lat1"}, "destination": {"lon": "lon2", "lat": "lat2"}},
    )
    km = distance_km(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    return placed.withColumn("distance_km", km).drop("lon1", "lat1", "lon2", "lat2")


def flow_distances(od: DataFrame, zones: DataFrame) -> DataFrame:
    """Distances of the unordered pairs that occur in the flows; grows with the flows only."""
    o, d = F.col("origen_zone_id"), F.col("destino_zone_id")
    pairs = (
        od.where(o != d)
        .select(F.least(o, d).alias("origin"), F.greatest(o, d).alias("destination"))
        .distinct()
    )
    return pair_distances(pairs, zones)


def _zone_names(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("municipio_mitma").alias("zone_id"), "nombre").distinct()


def _observations(series: DataFrame, *columns) -> DataFrame:
    return series.select(
        normalise_name(F.col("Nombre")).alias("nombre"),
        *columns,
        F.explode("Data").alias("item"),
    ).withColumn("valor", F.col("item")["Valor"].cast("double"))


def companies(series: DataFrame, mapping: DataFrame, year: str) -> DataFrame:
    """Companies per zone: the largest value per name, summed over the names of a zone.

    The maximum per name is taken before the join, so homonyms never pair up row by row.
    """
    per_name = (
        _observations(series.where(F.col("Nombre").ilike("%CNAE%")))
        .groupBy("nombre")
        .agg(F.max(F.coalesce("valor", F.lit(0.0))).alias("valor"))
    )
    joined = _zone_names(mapping).join(per_name, "nombre", "left")
    return joined.groupBy("zone_id").agg(
        F.coalesce(F.sum("valor"), F.lit(0.0)).alias("empresas"), F.lit(year).alias("year")
    )


def population(series: DataFrame, mapping: DataFrame, year: str) -> DataFrame:
    """Population per zone: total, men, women."""
    kinds = {
        "poblacion_total": "total",
        "poblacion_hombres": "hombres",
        "poblacion_mujeres": "mujeres",
    }
    tipo = label_token(F.col("Nombre"), 2).alias("tipo")
    value = F.coalesce("valor", F.lit(0.0))
    per_name = (
        _observations(series.where(F.col("Nombre").isNotNull()), tipo)
        .groupBy("nombre")
        .agg(*[F.max(F.when(F.col("tipo") == k, value)).alias(out) for out, k in kinds.items()])
    )
    joined = _zone_names(mapping).join(per_name, "nombre", "left")
    return joined.groupBy("zone_id").agg(
        *[F.coalesce(F.sum(out), F.lit(0.0)).alias(out) for out in kinds],
        F.lit(year).alias("year"),
    )


def income(series: DataFrame, mapping: DataFrame, year: str) -> DataFrame:
    """Mean net income per zone; of several values of a zone the highest counts.

    The filters look at the label as published, accents included, not at the cleaned name.
    """
    label = F.col("Nombre")
    municipal = ~label.ilike("%sección%") & ~label.ilike("%distrito%")
    wanted = series.where((label_token(label, 3) == INCOME_SERIES) & municipal)
    per_name = (
        _observations(wanted)
        .groupBy("nombre")
        .agg(F.max("valor").alias("valor"), F.lit(True).alias("matched"))
    )
    joined = _zone_names(mapping).join(per_name, "nombre", "left")
    best = joined.groupBy("zone_id").agg(
        F.max("valor").alias("valor"), F.bool_or(F.coalesce("matched", F.lit(False))).alias("matched")
    )
    return best.select(
        "zone_id",
        F.when(F.col("matched"), F.lit(INCOME_SERIES)).alias("tipo"),
        F.coalesce(F.round("valor", 2), F.lit(0.0)).alias("renta_media"),
        F.lit(year).alias("year"),
    )


def zone_profile(
    zones: DataFrame, companies: DataFrame, income: DataFrame, population: DataFrame, year: str
) -> DataFrame:
    """One row per zone with every indicator, missing ones as 0."""
    measures = (
        "empresas",
        "renta_media",
        "poblacion_total",
        "poblacion_hombres",
        "poblacion_mujeres",
    )
    profile = zones.select("id", "nombre")
    for indicator in (companies, income, population):
        columns = [c for c in indicator.columns if c in measures]
        keyed = indicator.select(F.col("zone_id").alias("id"), *columns)
        profile = profile.join(keyed, "id", "left")
    return profile.select(
        "id",
        "nombre",
        *[F.coalesce(m, F.lit(0.0)).alias(m) for m in measures],
        F.lit(year).alias("year"),
    )
