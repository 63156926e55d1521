"""The hourly fact as a stream with event-time state, and numbered batches beside it."""

import pytest

from flowlake import schemas
from flowlake.plans import od
from flowlake.streaming import ingest
from tests.conftest import rows
from tests.test_plans import holiday


def flows(spark, *given):
    """Raw rows from (day of January 2024, hour, trips, origin)."""
    data = [(f"202401{d:02d}", h, o, "2", str(t), "1", "r") for d, h, t, o in given]
    return spark.createDataFrame(data, schemas.OD_RAW)


@pytest.fixture
def run(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "hours")

    def add(part=None):
        if part is not None:
            part.write.mode("append").option("header", True).csv(source)
        stream = ingest.new_files(spark, source, schemas.OD_RAW, header="true").drop("loaded_at", "source_file")
        ingest.hourly_available(stream, holiday(spark), target, target + "-log", "2 days")
        try:
            return spark.read.parquet(target).drop("batch", "year", "month", "day")
        except Exception:
            return None

    return add


def test_hours_out_of_order_and_late(spark, run):
    first = flows(spark, (6, "3", 5, "1"), (6, "4", 1, "9"), (5, "7", 2, "1"), (5, None, 8, "1"))
    second = flows(spark, (5, "7", 4, "1"), (6, "3", 1, "1"), (7, "0", 1, "1"))
    early = run(first)
    assert early is None or early.isEmpty()  # all hours are open
    run(second)
    # Day 10 closes the hours up to day 8; an external row moves time as well.
    hours = run(flows(spark, (10, "1", 3, "externo")))
    whole = od.with_day_flags(
        od.od_hourly(first.union(second).where("periodo is not null"), holiday(spark)).drop("is_weekend", "is_holiday"), holiday(spark)
    )
    names = sorted(whole.columns)
    assert rows(hours.select(names)) == rows(whole.select(names))
    assert sorted(r.n_rows for r in hours.collect()) == [1, 1, 2, 2]
    # Too late by then: counted, and in no figure. A row of an open hour is not late.
    late = flows(spark, (6, "3", 7, "1"), (7, "1", 7, "1"), (9, "5", 2, "1"))
    assert rows(run(late).select(names)) == rows(whole.select(names))
    raw = first.union(second).union(late)
    assert rows(od.late_rows(raw, run())) == [("20240106", 1)]  # 7, 1 h lies past the newest hour written
    closed = run(ingest.closing_row(spark, "20990101"))
    assert closed.where("fecha = timestamp_ntz'2024-01-09 05:00:00'").first().viajes == 2
    assert rows(od.late_rows(raw, closed)) == [("20240106", 1), ("20240107", 1)]
    again = run()
    assert rows(again) == rows(closed)


def test_loads_number_themselves(spark, tmp_path):
    target = str(tmp_path / "t")
    assert ingest.load_batch(flows(spark, (5, "0", 1, "1")), target) == -1
    assert ingest.load_batch(flows(spark, (5, "0", 1, "1"), (6, "0", 1, "1")), target) == -2
    ingest.write_batch(flows(spark, (5, "1", 1, "1")), 0, target)
    assert spark.read.parquet(target).count() == 4
    assert ingest.load_batch(flows(spark, (5, "0", 9, "1")), target, -2) == -2  # load 2, corrected
    got = spark.read.parquet(target).where("batch = -2")
    assert rows(got.select("viajes", "day")) == [("9", 5)]
    with pytest.raises(ValueError):
        ingest.load_batch(flows(spark, (5, "0", 9, "1")), target, 3)
