"""Hourly OD fact, its quality table, and the typed daily surveys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.numeric import is_outlier, positive_ratio
from flowlake.functions.temporal import add_hours, day_key, day_stamp, is_weekend, parse_day
from flowlake.functions.text import EXTERNAL_ZONE
from flowlake.operators.incremental import PARTS
from flowlake.operators.joins import lookup_join


def wanted_days(df: DataFrame, column: str, days: list[str] | None) -> Column:
    """Predicate for a list of ``yyyyMMdd`` days; it prunes partitions by year, month and day."""
    if days is None:
        return F.lit(True)
    if not days:
        return F.lit(False)
    iso = [f"{d[:4]}-{d[4:6]}-{d[6:]}" for d in days]
    dates = [F.lit(d).cast("date") for d in iso]
    parts = F.lit(True)
    if set(PARTS) <= set(df.columns):
        kinds = dict(df.dtypes)
        day = F.make_date(*[F.col(p).cast("int") for p in PARTS]) if kinds["year"] == "string" else F.make_date(*PARTS)
        parts = day.isin(dates)
    if dict(df.dtypes)[column] == "string":
        return parts & F.col(column).isin(days)
    stamp = F.col(column)
    low = F.lit(min(iso)).cast("timestamp_ntz")
    high = F.date_add(F.lit(max(iso)).cast("date"), 1).cast("timestamp_ntz")
    return parts & (stamp >= low) & (stamp < high) & F.to_date(column).isin(dates)


def od_hourly(
    od_raw: DataFrame,
    holidays: DataFrame,
    days: list[str] | None = None,
    require_residence: bool = False,
    tolerant: bool = False,
) -> DataFrame:
    """Hourly trips and trip-km by (hour, origin, destination, residence) with day flags.

    External and incomplete rows are left out. A value that is not a number raises, unless
    ``tolerant``: then it counts as missing (see :func:`rejected`).
    """
    cast = _number(tolerant)
    rows = od_raw.where(wanted_days(od_raw, "fecha", days) & _complete())
    if require_residence:
        rows = rows.where(F.col("residencia").isNotNull() & F.col("periodo").isNotNull())
    hour = cast("periodo", "int")
    typed = rows.select(
        day_stamp(rows).alias("day"),
        hour.alias("hour"),
        F.col("origen").alias("origen_zone_id"),
        F.col("destino").alias("destino_zone_id"),
        cast("viajes", "double").alias("viajes"),
        cast("viajes_km", "double").alias("viajes_km"),
        "residencia",
    ).withColumn("date", F.to_date("day"))
    flagged = lookup_join(
        typed, holidays.select("date", F.lit(True).alias("holiday")), {"date": "date"}, "left"
    )
    return flagged.groupBy(
        add_hours(F.col("day"), F.col("hour")).alias("fecha"),
        "origen_zone_id",
        "destino_zone_id",
        "residencia",
    ).agg(
        F.sum("viajes").alias("viajes"),
        F.sum("viajes_km").alias("viajes_km"),
        F.bool_or(is_weekend(F.col("day"))).alias("is_weekend"),
        F.bool_or(F.coalesce("holiday", F.lit(False))).alias("is_holiday"),
    ).select(
        "fecha",
        "origen_zone_id",
        "destino_zone_id",
        "viajes",
        "viajes_km",
        "residencia",
        "is_weekend",
        "is_holiday",
    )


def hourly_windows(od_raw: DataFrame, delay: str) -> DataFrame:
    """The hourly fact of a stream, with the rows behind each figure (``n_rows``) and without day flags.

    Every hour is open until the newest hour seen, of any row, lies ``delay`` past its end; then its rows leave the
    state, once and for good. Rows that come later than that, and rows without an hour, count nowhere
    (see :func:`late_rows`). The state holds one row per open hour and key.
    """
    at = add_hours(day_stamp(od_raw), F.col("periodo").cast("int")).cast("timestamp")
    marked = od_raw.withColumn("at", at).withWatermark("at", delay)
    # The hour is part of the condition, so that rows left out move the watermark as well.
    kept = marked.where(F.when(_complete(), F.col("at")).isNotNull())
    hours = kept.groupBy(
        F.window("at", "1 hour").alias("hour"),
        F.col("origen").alias("origen_zone_id"),
        F.col("destino").alias("destino_zone_id"),
        "residencia",
    ).agg(
        F.sum(F.col("viajes").cast("double")).alias("viajes"),
        F.sum(F.col("viajes_km").cast("double")).alias("viajes_km"),
        F.count("*").alias("n_rows"),
    )
    return hours.select(F.col("hour.start").cast("timestamp_ntz").alias("fecha"), *hours.columns[1:])


def with_day_flags(hours: DataFrame, holidays: DataFrame) -> DataFrame:
    """Hourly rows with the weekend and holiday flags of their day."""
    days = holidays.select("date", F.lit(True).alias("is_holiday"))
    dated = hours.withColumn("date", F.to_date("fecha"))
    flagged = lookup_join(dated, days, {"date": "date"}, "left").drop("date")
    return flagged.withColumns(
        {"is_weekend": is_weekend(F.col("fecha")), "is_holiday": F.coalesce("is_holiday", F.lit(False))}
    )


def late_rows(od_raw: DataFrame, hours: DataFrame) -> DataFrame:
    """(fecha, n_late): complete rows of the source that came when their hour was closed, by day.

    ``hours`` is what a stream wrote with ``n_rows``. Hours close in order, so up to the newest one written
    every row that is in no figure was late; later hours are still open.
    """
    newest = hours.agg(F.max("fecha").alias("at")).first().at
    at = add_hours(day_stamp(od_raw), F.col("periodo").cast("int"))
    closed = at <= F.lit(newest).cast("timestamp_ntz")
    given = od_raw.where(_complete() & closed).groupBy(day_key(at).alias("fecha")).agg(F.count("*").alias("given"))
    counted = hours.groupBy(day_key(F.col("fecha")).alias("fecha")).agg(F.sum("n_rows").alias("counted"))
    late = F.col("given") - F.coalesce("counted", F.lit(0))
    return given.join(counted, "fecha", "left").select("fecha", late.alias("n_late")).where("n_late > 0")


def _number(tolerant: bool):
    def cast(name: str, kind: str) -> Column:
        return F.col(name).try_cast(kind) if tolerant else F.col(name).cast(kind)

    return cast


def _complete() -> Column:
    internal = [
        F.col(end).isNotNull() & (F.col(end) != EXTERNAL_ZONE) for end in ("origen", "destino")
    ]
    return internal[0] & internal[1] & F.col("viajes").isNotNull() & F.col("viajes_km").isNotNull()


def rejected(od_raw: DataFrame) -> DataFrame:
    """How many complete rows hold text that is not a number, by column."""
    rows = od_raw.where(_complete())
    return rows.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c)
            for c, kind in (("periodo", "int"), ("viajes", "double"), ("viajes_km", "double"))
        ]
    )


def month_totals(od: DataFrame) -> DataFrame:
    """Trips and trip-km by OD pair and month."""
    return od.groupBy(
        F.year("fecha").alias("year"),
        F.month("fecha").alias("month"),
        "origen_zone_id",
        "destino_zone_id",
    ).agg(F.sum("viajes").alias("viajes"), F.sum("viajes_km").alias("viajes_km"))


def typical_day(od: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Trips and km by (origin, destination, date, hour).

    There is one value per group and day, so its average is the sum itself and one aggregation
    is enough.
    """
    return (
        od.where(wanted_days(od, "fecha", days))
        .groupBy(
            F.col("origen_zone_id").alias("origin_id"),
            F.col("destino_zone_id").alias("destination_id"),
            F.to_date("fecha").alias("date"),
            F.hour("fecha").alias("hour"),
        )
        .agg(F.sum("viajes").alias("avg_trips"), F.sum("viajes_km").alias("avg_km"))
    )


def day_moments(od: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Flows, their mean and their squared deviations by (date, origin): what scores compare with."""
    measured = od.where(wanted_days(od, "fecha", days) & _measured())
    return measured.groupBy(F.to_date("fecha").alias("date"), "origen_zone_id").agg(
        F.count("*").alias("flows"),
        F.avg("viajes").alias("mean"),
        (F.var_pop("viajes") * F.count("*")).alias("spread"),
    )


def _measured() -> Column:
    return F.col("viajes").isNotNull() & F.col("viajes_km").isNotNull()


def _score_scale(moments: DataFrame, people: DataFrame) -> tuple[float, float]:
    """Mean and sample deviation of the per-capita trips of all flows, from merged moments."""
    known = lookup_join(moments, people, {"origen_zone_id": "id"}).where("people > 0")
    mean, n = F.col("mean") / F.col("people"), F.col("flows")
    total = known.agg(
        F.sum(n).alias("n"),
        F.sum(n * mean).alias("s"),
        F.sum(n * mean * mean + F.col("spread") / F.pow("people", F.lit(2))).alias("q"),
    ).first()
    if not total.n:
        return 0.0, 1.0
    variance = max(total.q - total.s**2 / total.n, 0.0) / (total.n - 1) if total.n > 1 else 0.0
    return total.s / total.n, math.sqrt(variance) or 1.0


def od_quality(
    od: DataFrame, profile: DataFrame, days: list[str] | None = None, moments: DataFrame | None = None
) -> DataFrame:
    """Per-capita rates, negative flags and outliers of the hourly fact.

    The score compares with the mean and deviation over the whole fact, also when only some days
    are asked for. They come from ``moments`` (see :func:`day_moments`), a table that is small and
    kept day by day, and enter the plan as literals; without one the fact is read for them.
    """
    people = profile.select("id", F.col("poblacion_total").alias("people"))
    per_capita = positive_ratio(F.col("viajes"), F.col("people"))
    mean, deviation = _score_scale(day_moments(od) if moments is None else moments, people)
    measured = od.where(wanted_days(od, "fecha", days) & _measured())
    scored = lookup_join(measured, people, {"origen_zone_id": "id"}, "left").select(
        "fecha",
        "origen_zone_id",
        "destino_zone_id",
        "residencia",
        per_capita.alias("viajes_per_capita"),
        positive_ratio(F.col("viajes_km"), F.col("people")).alias("km_per_capita"),
        (F.col("viajes") < 0).alias("flag_negative_viajes"),
        (F.col("viajes_km") < 0).alias("flag_negative_viajes_km"),
        ((per_capita - F.lit(mean)) / F.lit(deviation)).alias("z_viajes_per_capita"),
    )
    return scored.withColumn(
        "flag_outlier_viajes_per_capita", is_outlier(F.col("z_viajes_per_capita"))
    )


def people_day(raw: DataFrame) -> DataFrame:
    """Typed persons by residence zone, age, sex and trip count."""
    return _survey(raw, ["zona_pernoctacion", "edad", "sexo", "numero_viajes"])


def overnight_stay(raw: DataFrame) -> DataFrame:
    """Typed persons by overnight zone and residence zone."""
    return _survey(raw, ["zona_pernoctacion", "zona_residencia"])


def _survey(raw: DataFrame, keys: list[str]) -> DataFrame:
    return raw.dropna(subset=["fecha", *keys, "personas"]).select(
        parse_day(F.col("fecha")).cast("date").alias("fecha"),
        *keys,
        F.col("personas").cast("double").alias("personas"),
    )


def day_counts(od: DataFrame) -> DataFrame:
    """Rows and flags per day key."""
    return od.groupBy(day_key(F.col("fecha")).alias("fecha")).agg(
        F.count("*").alias("n_rows"),
        F.bool_or("is_weekend").alias("is_weekend"),
        F.bool_or("is_holiday").alias("is_holiday"),
    )
