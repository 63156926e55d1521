"""Report output: run ids, the folder layout, and the record of a run's parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from flowlake.functions.geo import polygon_edges


@dataclass(frozen=True)
class ReportParams:
    """Date range (``YYYY-MM-DD``, end after start) and polygon of a report."""

    start: str
    end: str
    polygon: str

    def __post_init__(self) -> None:
        first = datetime.strptime(self.start, "%Y-%m-%d")
        last = datetime.strptime(self.end, "%Y-%m-%d")
        if last <= first:
            raise ValueError(f"end date {self.end} must be after start date {self.start}")
        polygon_edges(self.polygon)


def run_id(day: str | date | None = None) -> str:
    """``DDMMYYYY_`` and six hexadecimal digits."""
    if isinstance(day, str):
        day = datetime.strptime(day, "%Y-%m-%d").date()
    return f"{(day or date.today()):%d%m%Y}_{uuid.uuid4().hex[-6:]}"


def report_path(base: str, question: int, run: str, artifact: str) -> str:
    return f"{base.rstrip('/')}/gold/question{question}/{run}/{artifact}"


Hook = Callable[[DataFrame], DataFrame]


def hooked(report: DataFrame, hooks: Iterable[Hook] = (), keep: Iterable[str] = ()) -> DataFrame:
    """A report after its hooks, each a function from DataFrame to DataFrame, in order.

    A hook may add columns and rows and drop them, but not the columns in ``keep``: what reads the report relies on
    them. Functions are passed as they are, never as text; a body over pandas fits in ``mapInPandas``.
    """
    for hook in hooks:
        report = report.transform(hook)
        if lost := [c for c in keep if c not in report.columns]:
            raise ValueError(f"{getattr(hook, '__name__', 'hook')} dropped {lost}")
    return report


def write_report(
    report: DataFrame, base: str, question: int, run: str, artifact: str, hooks: Iterable[Hook] = ()
) -> str:
    """Write report rows, after the hooks, as JSON lines under the run's folder; returns the path."""
    path = report_path(base, question, run, artifact)
    hooked(report, hooks).write.mode("overwrite").json(path)
    return path


def write_run_info(
    spark: SparkSession, params: ReportParams, base: str, question: int, run: str
) -> str:
    path = report_path(base, question, run, "info")
    record = [(run, params.start, params.end, params.polygon)]
    columns = "run_id string, start_date string, end_date string, polygon_wkt string"
    spark.createDataFrame(record, columns).write.mode("overwrite").json(path)
    return path
