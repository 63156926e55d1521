"""Refreshes that forget, and daily tables of versions."""

import pytest
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.operators import merge
from flowlake.plans import lake, od
from flowlake.sinks.buckets import KeyBuckets
from flowlake.sinks.days import DayFolder, DayVersions
from tests.conftest import rows
from tests.test_plans import holiday

WITH_FILE = schemas.OD_RAW.simpleString().removeprefix("struct<").removesuffix(">") + ",source_file:string"


def delivery(spark, days, viajes="5", outside=(), destinations=2):
    data = [
        (f"202401{day:02d}", str(hour), "externo" if day in outside else "1", str(to), viajes, "1", "r", f"f{day}")
        for day in days
        for hour in (0, 7)
        for to in range(destinations)
    ]
    return spark.createDataFrame(data, WITH_FILE)


def plain(df):
    return rows(df.drop("year", "month", "day"))


@pytest.fixture(params=[DayFolder, DayVersions])
def tables(request, spark, tmp_path):
    return [request.param(spark, str(tmp_path / name)) for name in ("od", "typical", "quality", "mismatch")]


def test_days_that_shrink_empty_or_vanish(spark, tables):
    fact, typical, quality, _ = tables
    profile = spark.createDataFrame([("1", 10.0)], "id string, poblacion_total double")
    below = fact if isinstance(fact, DayVersions) else None

    def above():
        flows = below or fact.read()
        done = lake.refresh_typical_day(flows, typical, None if below else fact)
        assert lake.refresh_quality(flows, profile, quality, None if below else fact) == done
        return done

    first = delivery(spark, range(1, 6))
    assert len(lake.refresh_od(first, holiday(spark), fact, complete=True)) == 5
    assert len(above()) == 5
    # Day 2 corrected, same file and row count; day 3 shrinks; day 4 has nothing valid; day 5 is withdrawn.
    second = (
        delivery(spark, [1])
        .union(delivery(spark, [2], viajes="9"))
        .union(delivery(spark, [3], destinations=1))
        .union(delivery(spark, [4], outside=[4]))
    )
    changed = ["20240102", "20240103", "20240104", "20240105"]
    assert lake.refresh_od(second, holiday(spark), fact, complete=True) == changed
    assert above() == changed and above() == []
    assert lake.refresh_od(second, holiday(spark), fact, complete=True) == []
    flows = od.od_hourly(second.drop("source_file"), holiday(spark))
    assert plain(fact.read()) == rows(flows)
    assert plain(typical.read()) == rows(od.typical_day(flows))
    days = {r[0] for r in quality.read().selectExpr("date_format(fecha, 'yyyyMMdd')").distinct().collect()}
    assert days == {"20240101", "20240102", "20240103"}
    # A withdrawn day may come back.
    assert lake.refresh_od(second.union(delivery(spark, [5])), holiday(spark), fact, complete=True) == ["20240105"]
    assert above() == ["20240105"]


def test_a_partial_source_withdraws_nothing(spark, tables):
    fact = tables[0]
    lake.refresh_od(delivery(spark, range(1, 6)), holiday(spark), fact)
    assert lake.refresh_od(delivery(spark, [2, 3]), holiday(spark), fact) == []
    assert lake.refresh_od(delivery(spark, [2]), holiday(spark), fact, "2024-01-02", "2024-01-03", complete=True) == ["20240103"]
    assert {r.day for r in fact.read().select("day").distinct().collect()} == {1, 2, 4, 5}


def test_everything_withdrawn(spark, tables):
    from tests.test_plans import gravity_inputs

    fact, typical, _, mismatch = tables
    flows, zones, profile = gravity_inputs(spark)
    assert len(lake.refresh_gravity(flows, zones, profile, mismatch)) == 4
    lake.refresh_od(delivery(spark, [1, 2]), holiday(spark), fact, complete=True)
    none = delivery(spark, [])
    assert lake.refresh_od(none, holiday(spark), fact, complete=True) == ["20240101", "20240102"]
    left = fact.read()
    assert left is None or left.isEmpty()
    assert lake.refresh_od(none, holiday(spark), fact, complete=True) == []


def test_a_table_above_needs_the_log_below(spark, tables):
    fact, typical, *_ = tables
    flows = od.od_hourly(delivery(spark, [1]).drop("source_file"), holiday(spark))
    with pytest.raises(ValueError, match="no log"):
        lake.refresh_typical_day(flows, typical, fact)
    if isinstance(fact, DayVersions):
        with pytest.raises(ValueError, match="no version"):
            lake.refresh_typical_day(fact, typical)


class Broken(DayVersions):
    """Stops between its data and the commit."""

    def publish(self, *_):
        raise InterruptedError


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "od")
    fact, hold = DayVersions(spark, path), holiday(spark)
    assert fact.version() == 0 and fact.read() is None and fact.states() is None
    lake.refresh_od(delivery(spark, range(1, 4)), hold, fact)
    old = fact.read()
    before = plain(old)
    with pytest.raises(InterruptedError):
        lake.refresh_od(delivery(spark, range(1, 4), viajes="9"), hold, Broken(spark, path))
    assert fact.version() == 1 and plain(fact.read()) == before
    assert len(lake.refresh_od(delivery(spark, range(1, 4), viajes="9"), hold, fact)) == 3
    assert fact.version() == 2 and plain(fact.read()) != before
    assert plain(old) == before  # a reader that began before goes on
    assert plain(fact.at(1).read()) == before
    assert fact.at(1).version() == 1


def test_reading_a_range_lists_its_files_only(spark, tmp_path):
    fact = DayVersions(spark, str(tmp_path / "od"))
    lake.refresh_od(delivery(spark, range(1, 4)), holiday(spark), fact)
    lake.refresh_od(delivery(spark, [2], viajes="7"), holiday(spark), fact)
    some = fact.read("2024-01-02", "2024-01-03")
    assert {f.rsplit("/", 2)[1] for f in some.inputFiles()} == {"day=2", "day=3"}
    assert {r.day for r in some.collect()} == {2, 3}
    assert fact.read("2025-01-01", "2025-01-02").columns == fact.read().columns


def test_vacuum_keeps_what_kept_versions_read(spark, tmp_path):
    path = str(tmp_path / "od")
    fact, hold = DayVersions(spark, path), holiday(spark)
    for days, viajes in ((range(1, 4), "5"), ([2], "7"), ([2, 3], "8")):
        lake.refresh_od(delivery(spark, days, viajes), hold, fact)
    with pytest.raises(InterruptedError):
        lake.refresh_od(delivery(spark, [1], "6"), hold, Broken(spark, path))
    newest, second = plain(fact.read()), plain(fact.at(2).read())
    gone = fact.vacuum(keep=2)
    assert plain(fact.read()) == newest and plain(fact.at(2).read()) == second
    assert sum("/day=2" in g for g in gone) == 1 and sum("/" not in g for g in gone) == 1 and len(gone) == 2
    fact.vacuum()
    assert plain(fact.read()) == newest


def test_a_commit_lists_its_days(spark, tmp_path):
    fact = DayVersions(spark, str(tmp_path / "od"))
    flows = od.od_hourly(delivery(spark, [1, 2]).drop("source_file"), holiday(spark))
    with pytest.raises(ValueError, match="20240102"):
        fact.commit(flows, "fecha", [("20240101", "x")])
    assert fact.version() == 0


def kept_files(table):
    """Bucket to (file, time of change) of what the newest version reads."""
    files = table.read_parts().select("key_bucket", "_metadata.file_path", "_metadata.file_modification_time").distinct()
    found = {}
    for r in files.collect():
        found.setdefault(r[0], set()).add(tuple(r[1:]))
    return found


KEYED = "id long, zone string, amount double"


def test_an_upsert_rewrites_its_buckets_only(spark, tmp_path):
    data = [(k, f"z{k % 3}", float(k)) for k in range(200)] + [(None, "z0", 1.0)]
    target = spark.createDataFrame(data, KEYED)
    table = KeyBuckets.create(target, str(tmp_path / "t"), ["id", "zone"], 16)
    assert rows(table.read()) == rows(target) and table.layout() == (16, ["id", "zone"])
    before = kept_files(table)
    # One replaced key, twice in the source, a new key, a key that differs in one part, a NULL key.
    change = [(5, "z2", -1.0), (5, "z2", -2.0), (900, "z9", 9.0), (7, "z9", 7.5), (None, "z0", 2.0)]
    source = spark.createDataFrame(change, KEYED)
    touched = KeyBuckets(spark, str(tmp_path / "t")).upsert(source)
    assert 1 <= len(touched) <= 4
    assert rows(table.read()) == rows(merge.upsert(source, target, ["id", "zone"]))
    after = kept_files(table)
    assert {str(b) for b in after if after[b] != before.get(b)} == set(touched)
    assert rows(table.at(1).read()) == rows(target)
    found = table.lookup(spark.createDataFrame([(5, "z2"), (12345, "z1")], "id long, zone string"))
    assert rows(found) == [(5, "z2", -1.0), (5, "z2", -2.0)]
    assert table.upsert(source.limit(0)) == [] and table.version() == 2
    with pytest.raises(ValueError, match="there is a table"):
        KeyBuckets.create(target, str(tmp_path / "t"), ["id"], 4)
    with pytest.raises(ValueError, match="no table"):
        KeyBuckets(spark, str(tmp_path / "u")).layout()


def test_an_empty_keyed_table_fills(spark, tmp_path):
    table = KeyBuckets.create(spark.createDataFrame([], KEYED), str(tmp_path / "t"), ["id"], 4)
    assert table.read().count() == 0
    source = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], KEYED)
    table.upsert(source.select("amount", "zone", "id"))
    assert rows(table.read()) == rows(source)
    table.upsert(source.limit(1).withColumn("amount", F.lit(5.0)))
    assert sorted(r.amount for r in table.read().collect()) == [2.0, 5.0]
    assert len(table.vacuum()) >= 1 and table.read().count() == 2
