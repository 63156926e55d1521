"""Daily tables: incremental runs end where one run over everything ends."""

import pytest

from flowlake import schemas
from flowlake.plans import lake, od
from tests.conftest import rows
from tests.test_plans import holiday


@pytest.fixture
def raw(spark):
    data = [
        (f"202401{day:02d}", str(hour), str(day % 3), str(hour % 4), str(day + hour), "1", "r")
        for day in range(1, 6)
        for hour in (0, 7, 23)
    ]
    return spark.createDataFrame(data, schemas.OD_RAW)


def test_incremental_equals_batch(spark, raw, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("od", "quality", "typical")}
    profile = spark.createDataFrame(
        [("0", 10.0), ("1", 20.0), ("2", 30.0)], "id string, poblacion_total double"
    )
    first = raw.where("fecha <= '20240103'")
    assert lake.refresh_od(first, holiday(spark), paths["od"]) == ["20240101", "20240102", "20240103"]
    assert lake.refresh_od(first, holiday(spark), paths["od"]) == []
    assert lake.refresh_od(raw, holiday(spark), paths["od"], "2024-01-04", "2024-01-04") == ["20240104"]
    assert lake.refresh_od(raw, holiday(spark), paths["od"]) == ["20240105"]
    flows = spark.read.parquet(paths["od"]).drop("year", "month", "day")
    assert rows(flows) == rows(od.od_hourly(raw, holiday(spark)))

    table = spark.read.parquet(paths["od"])
    assert lake.refresh_typical_day(table.where("day < 3"), paths["typical"]) == ["20240101", "20240102"]
    assert len(lake.refresh_typical_day(table, paths["typical"])) == 3
    typical = spark.read.parquet(paths["typical"]).drop("year", "month", "day")
    assert rows(typical) == rows(od.typical_day(flows))

    assert len(lake.refresh_quality(table, profile, paths["quality"])) == 5
    quality = spark.read.parquet(paths["quality"]).drop("year", "month", "day")
    assert rows(quality) == rows(od.od_quality(flows, profile))
    assert lake.refresh_quality(table, profile, paths["quality"]) == []


def test_late_rows_and_empty_days(spark, raw, tmp_path):
    path = str(tmp_path / "od")
    outside = spark.createDataFrame([("20240109", "1", "externo", "1", "1", "1", "r")], schemas.OD_RAW)
    early = raw.where("periodo = '0'").union(outside)
    assert len(lake.refresh_od(early, holiday(spark), path)) == 6
    assert lake.refresh_od(early, holiday(spark), path) == []  # also the day without valid rows
    late = raw.where("periodo = '0' or fecha = '20240102'").union(outside)
    assert lake.refresh_od(late, holiday(spark), path) == ["20240102"]
    table = spark.read.parquet(path).drop("year", "month", "day")
    assert rows(table) == rows(od.od_hourly(late, holiday(spark)))

    # Tables above take the states from the log of the one below.
    typical = str(tmp_path / "typical")
    assert len(lake.refresh_typical_day(spark.read.parquet(path), typical, path)) == 6
    assert lake.refresh_typical_day(spark.read.parquet(path), typical, path) == []
    assert lake.refresh_od(raw.union(outside), holiday(spark), path) == ["20240101", "20240103", "20240104", "20240105"]
    assert len(lake.refresh_typical_day(spark.read.parquet(path), typical, path)) == 4
    flows = spark.read.parquet(path).drop("year", "month", "day")
    assert rows(spark.read.parquet(typical).drop("year", "month", "day")) == rows(od.typical_day(flows))


def scans(df):
    return [line for line in df._jdf.queryExecution().toString().splitlines() if "FileScan" in line]


def test_wanted_days_prune_partitions(spark, raw, tmp_path):
    path = str(tmp_path / "od")
    lake.refresh_od(raw, holiday(spark), path)
    table = spark.read.parquet(path)
    profile = spark.createDataFrame([("0", 10.0)], "id string, poblacion_total double")
    moments = spark.createDataFrame([], "date date, origen_zone_id string, flows long, mean double, spread double")
    days = ["20240102", "20240104"]
    for df in (od.typical_day(table, days), od.od_quality(table, profile, days, moments)):
        for line in scans(df):
            assert "PartitionFilters: [" in line and "make_date(year" in line
        assert len(set(df.inputFiles())) >= 1
    staged = str(tmp_path / "raw")
    raw.selectExpr("*", "substr(fecha, 1, 4) year", "substr(fecha, 5, 2) month", "substr(fecha, 7, 2) day").write.partitionBy(
        "year", "month", "day"
    ).parquet(staged)
    hourly = od.od_hourly(spark.read.parquet(staged), holiday(spark), days)
    assert "make_date(" in scans(hourly)[0].split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert rows(hourly.selectExpr("date_format(fecha, 'yyyyMMdd') d").distinct()) == [("20240102",), ("20240104",)]


def test_gravity_refresh_is_repeatable(spark, tmp_path):
    from tests.test_plans import gravity_inputs

    flows, zones, profile = gravity_inputs(spark)
    path = str(tmp_path / "mismatch")
    assert len(lake.refresh_gravity(flows, zones, profile, path)) == 4
    first = rows(spark.read.parquet(path).drop("year", "month", "day"))
    assert lake.refresh_gravity(flows, zones, profile, path) == []
    from flowlake.plans import gravity

    whole = gravity.gravity_model(flows, zones, profile)
    assert first == rows(whole)


def test_profile_is_built_again_on_a_gap_only(spark, tmp_path):
    path = str(tmp_path / "profile")
    mapping = spark.createDataFrame([("z1",)], "municipio_mitma string")

    def build():
        return spark.createDataFrame([("z1", "2024")], "id string, year string")

    assert lake.refresh_profile(build, mapping, path, spark, "2024")
    assert not lake.refresh_profile(build, mapping, path, spark, "2024")
    assert lake.refresh_profile(build, mapping, path, spark, "2025")
