"""Daily tables with a log of what each day was made of: plain folders, and versions of immutable files.

The log has one row per day that a commit touched: ``fecha``, the ``state`` its source had, null once the
source has the day no more. Days come one entry each, so lists of days are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.temporal import date_parts
from flowlake.operators.incremental import PARTS, as_day
from flowlake.sinks.folders import names, remove
from flowlake.sinks.tables import append, write_days
from flowlake.sinks.versions import PartVersions, read_table

LOG = "fecha string, state string"


def day_folder(fecha: str) -> str:
    """Partition folder of a ``yyyyMMdd`` day."""
    return f"year={int(fecha[:4])}/month={int(fecha[4:6])}/day={int(fecha[6:])}"


class DayFolder:
    """A plain table partitioned by day: readers read the path, a commit replaces whole days in place.

    Days are swapped one after the other and the log follows, so a reader may meet a commit half done; a
    run that breaks off before the log is repeated by the next one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def beside(self, suffix: str) -> DayFolder:
        return DayFolder(self.spark, self.path + suffix)

    def states(self) -> DataFrame | None:
        """(fecha, state) of every day committed so far; None before the first commit."""
        log = read_table(self.spark, self.path + "_log")
        return None if log is None else log.groupBy("fecha").agg(F.max_by("state", "processed_at").alias("state"))

    def read(self) -> DataFrame | None:
        return read_table(self.spark, self.path)

    def commit(self, frame: DataFrame | None, column: str, rows: list[tuple[str, str | None]]) -> None:
        """Make the listed days hold what ``frame`` has for them; days it has no rows for lose their files."""
        folders = [f"{self.path}/{day_folder(fecha)}" for fecha, _ in rows]
        before = {folder: names(self.spark, folder) for folder in folders}
        if frame is not None:
            write_days(frame, self.path, column)
        for folder, held in before.items():
            if held and held == names(self.spark, folder):  # a written day has new files
                remove(self.spark, folder)
        seen = self.spark.createDataFrame(rows, LOG)
        append(seen.withColumn("processed_at", F.current_timestamp()).coalesce(1), self.path + "_log")


class DayVersions(PartVersions):
    """A daily table of versions: see :class:`PartVersions`; its parts are days as ``yyyyMMdd`` text."""

    #: Column that tells the day; a commit sets it.
    column = ""

    def beside(self, suffix: str) -> DayVersions:
        return type(self)(self.spark, self.path + suffix)

    def part_folder(self, part: str) -> str:
        return day_folder(part)

    def part_name(self) -> Column:
        return F.date_format(F.make_date(*PARTS), "yyyyMMdd")

    def write_parts(self, frame: DataFrame, folder: str) -> T.StructType:
        write_days(frame, folder, self.column)
        return frame.select("*", *date_parts(as_day(frame, self.column))).schema

    def states(self) -> DataFrame | None:
        parts = self.parts()
        return None if parts.isEmpty() else parts.select(F.col("part").alias("fecha"), "state")

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame | None:
        """Rows of all days, or of a closed range of ISO days; only their files are listed."""
        wanted = None
        if start and end:
            wanted = F.to_date("part", "yyyyMMdd").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        return self.read_parts(wanted)

    def commit(self, frame: DataFrame | None, column: str, rows: list[tuple[str, str | None]]) -> None:
        """Make the listed days hold exactly what ``frame`` has for them, in one step for readers."""
        self.column = column
        self.commit_parts(frame, rows)


DayTable = DayFolder | DayVersions


def day_table(spark: SparkSession, table: str | DayTable) -> DayTable:
    """A path stands for a plain folder."""
    return DayFolder(spark, table) if isinstance(table, str) else table
