"""Daily tables kept up to date: each run builds the days whose source is new or has changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators.incremental import changed_days, day_states, needs_rebuild
from flowlake.operators.sketches import day_summaries
from flowlake.plans.gravity import daily_pairs, fit_gravity_k, gravity_base_of, gravity_mismatch_of, latest_year
from flowlake.plans.od import day_moments, od_hourly, od_quality, typical_day, wanted_days
from flowlake.plans.zone_function import zone_function
from flowlake.sinks.days import DayTable, DayVersions, day_table
from flowlake.sinks.tables import replace
from flowlake.sinks.versions import read_table


def refresh_days(
    source: DataFrame,
    build: Callable[[list[str]], DataFrame],
    table: str | DayTable,
    column: str,
    start: str | None = None,
    end: str | None = None,
    parent: str | DayTable | None = None,
    complete: bool = False,
) -> list[str]:
    """Bring the days whose source has changed up to date, and forget those it lost; returns both.

    A late row, a corrected value or another file changes a day's state, and the whole day is built
    anew; where nothing valid is left the day loses its old rows. A day without valid rows is logged
    like others, so it is not built again. ``complete`` says that ``source`` has all there is in the
    range: days that are logged but missing there are then withdrawn. Otherwise a missing day is one the
    source does not speak of.

    ``parent`` is the daily table that ``source`` reads: its log then gives the states and the withdrawn days
    without a look at the rows. A run that breaks off before it logs its days repeats them. Only the
    list of days comes to the driver, one entry per calendar day.
    """
    spark = source.sparkSession
    table = day_table(spark, table)
    if parent is None:
        states = day_states(source, "fecha")
    else:
        states = day_table(spark, parent).states()
        if states is None:
            raise ValueError("the parent table has no log; refresh it first or leave the parent out")
    fresh = changed_days(states, table.states(), complete)
    if start and end:
        day = F.to_date("fecha", "yyyyMMdd")
        fresh = fresh.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    rows = sorted(tuple(r) for r in fresh.select("fecha", "state").collect())
    days = [day for day, state in rows if state is not None]
    if rows:
        table.commit(build(days) if days else None, column, rows)
    return [day for day, _ in rows]


def pinned(od: DataFrame | DayVersions, parent: str | DayTable | None) -> tuple[DataFrame, str | DayTable | None]:
    """A table of versions as one of them: rows and states that belong together."""
    if isinstance(od, DayVersions):
        version = od.at()
        rows = version.read()
        if rows is None:
            raise ValueError("the table below has no version yet")
        return rows, version
    return od, parent


def refresh_od(
    od_raw: DataFrame,
    holidays: DataFrame,
    path: str | DayTable,
    start: str | None = None,
    end: str | None = None,
    complete: bool = False,
) -> list[str]:
    return refresh_days(
        od_raw, lambda days: od_hourly(od_raw, holidays, days), path, "fecha", start, end, complete=complete
    )


def refresh_quality(
    od: DataFrame | DayVersions, profile: DataFrame, path: str | DayTable, parent: str | DayTable | None = None
) -> list[str]:
    """New days are scored against all flows present now; older days keep their scores.

    The scale comes from a table of moments beside the scores, so a run reads its own days of the fact
    and that table.
    """
    od, parent = pinned(od, parent)
    table = day_table(od.sparkSession, path)
    moments = table.beside("_moments")
    refresh_days(od, lambda days: day_moments(od, days), moments, "date", parent=parent)

    def scored(days: list[str]) -> DataFrame:
        return od_quality(od, profile, days, moments.read())

    return refresh_days(od, scored, table, "fecha", parent=parent)


def refresh_typical_day(
    od: DataFrame | DayVersions, path: str | DayTable, parent: str | DayTable | None = None
) -> list[str]:
    od, parent = pinned(od, parent)
    return refresh_days(od, lambda days: typical_day(od, days), path, "date", parent=parent)


def refresh_summaries(
    od: DataFrame | DayVersions, path: str | DayTable, parent: str | DayTable | None = None
) -> tuple[DayTable, DayTable]:
    """Summaries of the trips by day, with a sketch, and by day and pair; the two tables.

    Ranges of days are then described from them: see :mod:`flowlake.operators.sketches`.
    """
    od, parent = pinned(od, parent)
    table = day_table(od.sparkSession, path)
    pairs = table.beside("_pairs")
    ends = ["origen_zone_id", "destino_zone_id"]

    def of_days(keys: list[str], sketch: bool):
        return lambda days: day_summaries(od.where(wanted_days(od, "fecha", days)), "fecha", "viajes", keys, sketch)

    refresh_days(od, of_days([], True), table, "date", parent=parent)
    refresh_days(od, of_days(ends, False), pairs, "date", parent=parent)
    return table, pairs


def refresh_gravity(
    od: DataFrame | DayVersions,
    zones: DataFrame,
    profile: DataFrame,
    path: str | DayTable,
    parent: str | DayTable | None = None,
) -> list[str]:
    """Daily pair totals for the changed days, then the whole mismatch with the k they give now."""
    od, parent = pinned(od, parent)
    spark = od.sparkSession
    table = day_table(spark, path)
    pairs = table.beside("_pairs")
    days = refresh_days(od, lambda days: daily_pairs(od, days), pairs, "date", parent=parent)
    if days:
        daily = pairs.read()
        frame = None
        if daily is not None and not daily.isEmpty():
            daily = daily.drop("year", "month", "day")
            year = latest_year(daily, "date")
            k = fit_gravity_k(gravity_base_of(daily, zones, profile, year)).first().k
            frame = gravity_mismatch_of(daily, zones, profile, k)
        table.commit(frame, "date", sorted(tuple(r) for r in pairs.states().select("fecha", "state").collect()))
    return days


def refresh_zone_function(od: DataFrame, path: str) -> None:
    replace(zone_function(od), path)


def refresh_profile(
    build: Callable[[], DataFrame], name_map: DataFrame, path: str, spark: SparkSession, year: str | None
) -> bool:
    """Build the profile again when its year lacks rows or zones; says whether it did."""
    if not needs_rebuild(read_table(spark, path), name_map, year):
        return False
    replace(build(), path)
    return True
