"""Finding what is still to be done: day differences, file differences, coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.temporal import day_key, parse_day
from flowlake.operators.joins import missing_from_large, missing_rows

PARTS = ("year", "month", "day")


def date_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day from start to end, both included, as ``date`` and ``fecha`` (yyyyMMdd)."""
    days = F.sequence(
        F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"), F.expr("interval 1 day")
    )
    return spark.range(1).select(F.explode(days).alias("date")).select("date", day_key(F.col("date")).alias("fecha"))


def span_days(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last day of a column, as :func:`date_spine`."""
    ends = df.agg(F.min(as_day(df, column)).alias("a"), F.max(as_day(df, column)).alias("b"))
    days = F.explode(F.sequence("a", "b", F.expr("interval 1 day")))
    return ends.where("a is not null").select(days.alias("date")).select(
        "date", day_key(F.col("date")).alias("fecha")
    )


def as_day(df: DataFrame, column: str) -> Column:
    """A text, timestamp or date column as a date."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return parse_day(F.col(column)).cast("date")
    return F.to_date(column)


def present_days(table: DataFrame, column: str) -> DataFrame:
    """Distinct days in a table.

    A table partitioned by year, month and day answers from its partition columns, so the scan
    reads no data column.
    """
    if set(PARTS) <= set(table.columns):
        day = F.make_date(*PARTS)
    else:
        day = as_day(table, column)
    return table.select(day.alias("date")).where(F.col("date").isNotNull()).distinct()


def pending_days(
    wanted: DataFrame,
    done: DataFrame | None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Days of ``wanted`` not in ``done`` (both with a ``date`` column), in an optional range.

    Whole days are compared. No ``done`` table yet means that everything is pending.
    """
    days = wanted.select("date").distinct()
    if start and end:
        days = days.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if done is not None:
        days = days.subtract(done.select("date"))
    return days.select("date", day_key(F.col("date")).alias("fecha"))


def day_batches(days: DataFrame, size: int) -> DataFrame:
    """Number the days in order and cut them into batches: ``batch_index``, ``fecha``.

    The list holds one entry per calendar day, so gathering it in one array is bounded by the
    calendar whatever the size of the tables behind it.
    """
    ordered = days.agg(F.array_sort(F.collect_set("fecha")).alias("fechas"))
    return ordered.select(F.posexplode("fechas").alias("position", "fecha")).select(
        F.floor(F.col("position") / size).cast("int").alias("batch_index"), "fecha"
    )


def pending_files(manifest: DataFrame, table: DataFrame | None, provenance: str, *, large: bool = False) -> DataFrame:
    """Manifest rows (column ``url``) whose url is not among the table's provenance values.

    ``large``: the table has far more rows than the manifest, see
    :func:`flowlake.operators.joins.missing_from_large`.
    """
    if table is None:
        return manifest
    return (missing_from_large if large else missing_rows)(manifest, table, {"url": provenance})


def coverage_gap(profile: DataFrame, name_map: DataFrame, year: str) -> DataFrame:
    """Profile zones of a year that the mapping lacks."""
    zones = profile.where(F.col("year") == year).select("id").distinct()
    mapped = name_map.select(F.col("municipio_mitma").alias("id")).distinct()
    return zones.join(mapped, "id", "left_anti")


def needs_rebuild(profile: DataFrame | None, name_map: DataFrame, year: str | None) -> bool:
    """Whether the socio-economic tables have to be built again.

    Yes without a year, without a profile, when the year has no profile rows, or on a gap.
    """
    if year is None or profile is None or profile.where(F.col("year") == year).isEmpty():
        return True
    return not coverage_gap(profile, name_map, year).isEmpty()


def mark_processed(processed: DataFrame | None, days: DataFrame) -> DataFrame:
    """Rows to append to a processed-day log, with the time of processing.

    A day is its ``fecha`` and, where both have it, its ``state``: a day in a new state is new.
    """
    keys = [c for c in ("fecha", "state") if c in days.columns and (processed is None or c in processed.columns)]
    fresh = days.select(*keys).distinct()
    if processed is not None:
        fresh = fresh.join(processed.select(*keys).distinct(), keys, "left_anti")
    return fresh.withColumn("processed_at", F.current_timestamp())


def day_states(source: DataFrame, column: str) -> DataFrame:
    """(fecha, state) of every day of a source: the state changes with any row that comes, goes or changes.

    It is made of whole rows, with their file where they have one, but for the time of loading: that
    is another at every read.
    """
    content = [c for c in source.columns if c not in (*PARTS, "loaded_at")]
    mark = F.pmod(F.xxhash64(*content), F.lit(1 << 31))
    return source.groupBy(day_key(as_day(source, column)).alias("fecha")).agg(
        F.concat_ws(":", F.count("*"), F.sum(mark)).alias("state")
    ).where("fecha is not null")


def changed_days(states: DataFrame, logged: DataFrame | None, complete: bool) -> DataFrame:
    """(fecha, state) of the days to build, and with a null state of those to forget.

    A day is built when its state is not the logged one. It is forgotten when the log still has it and the
    source says it is gone: by a null state, or, where the source is ``complete``, by having no row of it.
    """
    if logged is None:
        return states.where("state is not null")
    known = logged.select("fecha", F.col("state").alias("known"))
    both = states.withColumn("told", F.lit(True)).join(known, "fecha", "full")
    build = F.col("state").isNotNull() & ~F.col("state").eqNullSafe(F.col("known"))
    told = F.col("told").isNotNull() | F.lit(complete)
    forget = F.col("state").isNull() & F.col("known").isNotNull() & told
    return both.where(build | forget).select("fecha", "state")


def last_states(log: DataFrame) -> DataFrame:
    """The newest state of every day of a processed-day log."""
    return log.groupBy("fecha").agg(F.max_by("state", "processed_at").alias("state"))


def between_days(table: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows of a closed day range, with a predicate on the partition columns where they exist."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    rows = table
    if set(PARTS) <= set(table.columns):
        rows = rows.where(F.make_date(*PARTS).between(first, last))
    if isinstance(table.schema[column].dataType, T.DateType):
        return rows.where(F.col(column).between(first, last))
    stamp = F.col(column)
    return rows.where(
        (stamp >= F.lit(start).cast("timestamp_ntz"))
        & (stamp < F.date_add(last, 1).cast("timestamp_ntz"))
    )
