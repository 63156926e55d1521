"""Joins, merges, picks, distributions and incremental differences on small rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.operators import clusters, distribution, incremental, joins, merge, picks, sketches, spatial
from flowlake.sinks import tables
from flowlake.sources import feed
from tests.conftest import rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_either_way(spark, how):
    """Two thirds of the rows sit on one key; broadcast and shuffled joins agree."""
    left = spark.createDataFrame(
        [("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)] + [(None, -1)], "k string, v int"
    )
    right = spark.sql("SELECT * FROM VALUES ('hot', 1.0D), ('k0', 2.0D), ('zzz', 3.0D) AS t(key, w)")
    found = {}
    for limit in ("10MB", "-1"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            joined = joins.lookup_join(left, right, {"k": "key"}, how)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == (limit != "-1")
            found[limit] = rows(joined)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found["10MB"] == found["-1"]
    kept = {"inner": 215, "left": 301, "left_semi": 215, "left_anti": 86}
    assert len(found["-1"]) == kept[how]


def test_hot_key_is_split_when_the_keyed_side_is_large(spark):
    """A third of the rows on one key: the shuffled join runs with a skew split."""
    left = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    right = spark.range(0, 400_000, 2).select(F.col("id").alias("key"), F.lit("x").alias("w"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for how in ("inner", "left", "left_semi", "left_anti"):
            joined = joins.lookup_join(left, right, {"k": "key"}, how)
            counted = joined.groupBy(F.col("k") % 5).agg(F.max("v"), F.count("*"))
            counted.collect()
            assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_no_job_runs_while_a_difference_is_planned(spark):
    """Each side stands once in the plan, and building it starts no job."""
    tracker = spark.sparkContext.statusTracker()
    source = spark.range(100).select(F.col("id").alias("k"))
    target = spark.range(50, 150).select(F.col("id").alias("t"))
    before = len(tracker.getJobIdsForGroup())
    late = joins.missing_rows(source, target, {"k": "t"})
    early = joins.present_rows(source, target, {"k": "t"})
    assert len(tracker.getJobIdsForGroup()) == before
    assert late._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2
    assert late.count() == early.count() == 50


def test_insert_only_keeps_source_duplicates_and_null_keys(spark):
    target = spark.createDataFrame([("a", 2023), ("b", 2023)], "COD string, year int")
    source = spark.createDataFrame(
        [("a", 2023, 1), ("a", 2024, 2), ("c", 2023, 3), ("c", 2023, 4), (None, 2023, 5)],
        "COD string, year int, v int",
    )
    got = merge.insert_only(source, target, ["COD", "year"])
    assert sorted(r.v for r in got.collect()) == [2, 3, 4, 5]


def test_upsert(spark):
    target = spark.createDataFrame([("1", "old"), ("2", "kept")], "ID string, n string")
    source = spark.createDataFrame([("1", "new"), ("3", "added")], "ID string, n string")
    got = merge.upsert(source, target, ["ID"])
    assert rows(got) == [("1", "new"), ("2", "kept"), ("3", "added")]


def test_null_safe_merge_ignores_audit_columns(spark):
    schema = "a string, b string, loaded_at string, source_file string"
    target = spark.createDataFrame([("x", None, "t0", "f0"), ("y", "1", "t0", "f0")], schema)
    source = spark.createDataFrame(
        [("x", None, "t1", "f1"), ("x", "2", "t1", "f1"), (None, None, "t1", "f1")], schema
    )
    got = merge.insert_new_rows(source, target)
    assert rows(got.select("a", "b")) == [("x", "2"), (None, None)]
    assert merge.data_columns(target) == ["a", "b"]


def test_first_per_key_and_majority(spark):
    df = spark.createDataFrame(
        [("a", 2.0, 0), ("a", 1.0, 1), ("a", None, 1), ("b", None, 1), ("c", 1.0, 0), ("c", 1.0, 1)],
        "k string, v double, c int",
    )
    first = picks.first_per_key(df, ["k"], [F.col("v").isNull(), -F.col("v"), F.col("c")])
    assert rows(first) == [("a", 2.0, 0), ("b", None, 1), ("c", 1.0, 0)]
    assert rows(picks.majority(df, "k", "c", "m")) == [("a", 1), ("b", 1), ("c", 0)]


def test_random_rows(spark):
    df = spark.range(100)
    assert picks.random_rows(df, 10, ["id"], 3).count() == 10
    assert rows(picks.random_rows(df, 10, ["id"], 3)) == rows(picks.random_rows(df.repartition(7), 10, ["id"], 3))
    assert rows(picks.random_rows(df, 10, ["id"], 3)) != rows(picks.random_rows(df, 10, ["id"], 4))
    assert picks.random_rows(df, 200, ["id"], 3).count() == 100


def test_histogram_matches_numpy(spark):
    rng = random.Random(2)
    values = [rng.gauss(3, 2) for _ in range(500)] + [3.0] * 250
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    counts, edges = np.histogram(values, bins=50)
    got = distribution.histogram(df, "x").orderBy("bin").collect()
    assert [r.frequency for r in got] == counts.tolist()
    assert [r.lower for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.upper for r in got] == pytest.approx(edges[1:].tolist())
    assert sum(r.frequency for r in distribution.histogram(df, "x", upper=3).collect()) == sum(
        v <= 3 for v in values
    )


def test_histogram_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    got = distribution.histogram(one, "x", 4).orderBy("bin").collect()
    assert [r.frequency for r in got] == [0, 0, 2, 0] and got[0].lower == 1.5
    assert distribution.histogram(one.limit(0), "x", 4).count() == 0
    assert distribution.density(one, "x").count() == 0


def test_density_matches_direct_sum(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(120)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = distribution.density(df, "x", bins=50).orderBy("point").collect()
    n, h = len(values), np.std(values, ddof=1) * len(values) ** -0.2
    grid = np.linspace(min(values), max(values), 200)
    width = (max(values) - min(values)) / 50
    want = [
        width / (h * math.sqrt(2 * math.pi)) * sum(math.exp(-0.5 * ((g - v) / h) ** 2) for v in values)
        for g in grid
    ]
    assert len(got) == 200 and n == 120
    assert [r.density for r in got] == pytest.approx(want)


@pytest.mark.parametrize("kind", ["continuous", "ties", "constant", "tiny"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(4)
    values = {
        "continuous": [rng.random() for _ in range(3000)],
        "ties": [7.0] * 1000 + [float(rng.randrange(40)) for _ in range(1500)],
        "constant": [5.0] * 50,
        "tiny": [1.0, 2.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    shares = [0.0, 0.2, 0.4, 0.5, 0.8, 1.0]
    for walked in (4096, 5):  # the second cuts the buckets again and again
        got = distribution.exact_quantiles(df, "x", shares, 16, walked)
        assert got == pytest.approx(np.quantile(values, shares).tolist())


def test_quantile_class(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)], "x double")
    got = distribution.quantile_class(df, "x").orderBy(F.col("x").asc_nulls_last()).collect()
    assert [r["class"] for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, None]
    assert distribution.exact_quantiles(df.limit(0), "x", [0.5]) == []


def test_pending_days_compare_whole_days(spark):
    """A last day that only has afternoon hours counts as done."""
    wanted = incremental.date_spine(spark, "2024-01-01", "2024-01-05")
    table = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 17:00' AS fecha UNION ALL SELECT NULL")
    done = incremental.present_days(table, "fecha")
    got = incremental.pending_days(wanted, done, "2024-01-03", "2024-01-05")
    assert sorted(r.fecha for r in got.collect()) == ["20240103", "20240104"]
    assert incremental.pending_days(wanted, None).count() == 5


def test_day_batches(spark):
    days = incremental.date_spine(spark, "2024-01-30", "2024-02-05")
    got = sorted((r.batch_index, r.fecha) for r in incremental.day_batches(days, 3).collect())
    assert [b for b, _ in got] == [0, 0, 0, 1, 1, 1, 2]
    assert [d for _, d in got] == sorted(d for _, d in got)
    assert incremental.day_batches(days.limit(0), 3).count() == 0


def test_present_days_of_a_partitioned_table_read_no_data(spark, tmp_path):
    from flowlake.sinks.tables import write_days

    flows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 17:00' AS fecha, 1.0D AS v")
    write_days(flows, str(tmp_path / "t"), "fecha")
    days = incremental.present_days(spark.read.parquet(str(tmp_path / "t")), "fecha")
    assert rows(days.select(F.col("date").cast("string"))) == [("2024-01-05",)]
    assert "ReadSchema: struct<>" in days._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_pending_files_and_processed_log(spark):
    manifest = spark.createDataFrame([("u1",), ("u2",)], "url string")
    table = spark.createDataFrame([("u1",), (None,)], "source_file string")
    assert rows(incremental.pending_files(manifest, table, "source_file")) == [("u2",)]
    assert incremental.pending_files(manifest, None, "source_file").count() == 2
    log = spark.createDataFrame([("20240101",)], "fecha string")
    days = spark.createDataFrame([("20240101",), ("20240102",), ("20240102",)], "fecha string")
    assert rows(incremental.mark_processed(log, days).select("fecha")) == [("20240102",)]


def test_coverage(spark):
    profile = spark.createDataFrame([("z1", "2024"), ("z2", "2023")], "id string, year string")
    mapping = spark.createDataFrame([("z1",)], "municipio_mitma string")
    assert rows(incremental.coverage_gap(profile, mapping, "2023")) == [("z2",)]
    assert not incremental.needs_rebuild(profile, mapping, "2024")
    assert incremental.needs_rebuild(profile, mapping, "2023")
    assert incremental.needs_rebuild(profile, mapping, "2022")  # a year without rows
    assert incremental.needs_rebuild(None, mapping, "2024")
    assert incremental.needs_rebuild(profile, mapping, None)


def test_url_batches_hold_at_most_size_and_follow_the_days(spark):
    """Two thirds of the files share one day."""
    files = [(f"u{i}", "20240102" if i % 3 else f"202401{10 + i % 5}") for i in range(200)]
    df = spark.createDataFrame(files, "url string, fecha string")
    got = feed.url_batches(df, 7, slot_rows=10).collect()
    assert sorted(r.url for r in got) == sorted(u for u, _ in files)
    sizes = {}
    for r in got:
        sizes[r.batch_index] = sizes.get(r.batch_index, 0) + 1
    assert sorted(sizes) == list(range(29)) and set(sizes.values()) == {7, 4}
    ordered = [d for _, d in sorted((r.batch_index, r.fecha) for r in got)]
    assert ordered == sorted(ordered)


def test_feed_patterns(spark):
    base = "https://h.example/x/estudios_basicos/por-municipios/viajes/ficheros-diarios"
    text = [
        f"<link>{base}/2024-01/20240105_Viajes_municipios.csv.gz</link> twice: "
        f"{base}/2024-01/20240105_Viajes_municipios.csv.gz",
        f'"{base}/2024-01/20240106_viajes_MUNICIPIOS.csv.gz"',
        f"{base}/2024-01/20240107_Viajes_distritos.csv.gz",
        "https://h.example/zonificacion/zonificacion_municipios/zonas.shp",
        "https://h.example/zonificacion/zonificacion_municipios/zonas.dbf",
        "https://h.example/zonificacion/zonificacion_municipios/nombres_municipios.csv",
        "https://h.example/zonificacion/zonificacion_GAU/poblacion_gaus.csv",
    ]
    df = spark.createDataFrame([(t,) for t in text], "value string")
    assert sorted(r.fecha for r in feed.od_files(df, "value", "municipios").collect()) == [
        "20240105",
        "20240106",
    ]
    days = spark.createDataFrame([("2024-01-06",)], "fecha string")
    assert [r.fecha for r in feed.od_files(df, "value", "municipios", days).collect()] == ["20240106"]
    kinds = [r.kind for r in feed.boundary_files(df, "value", "municipios").collect()]
    assert sorted(kinds) == ["nombres", "shape", "shape"]
    assert [r.kind for r in feed.boundary_files(df, "value", "gau").collect()] == ["poblacion"]
    with pytest.raises(ValueError):
        feed.od_files(df, "value", "provincias")


def test_request_manifest(spark):
    ids = spark.createDataFrame([(i,) for i in feed.INCOME_TABLE_IDS], "id int")
    got = feed.requests(ids, "id", [2022, 2023], "https://h.example/%d?date=%d0101")
    assert got.count() == 104 and got.select("url").distinct().count() == 104
    assert got.where("table_id = 31295 and year = 2023").first().url == (
        "https://h.example/31295?date=20230101"
    )


def test_a_filter_decides_what_a_large_target_lacks(spark):
    kinds = "a int, b string, c double"
    target = spark.createDataFrame([(k, f"b{k % 7}", k / 2) for k in range(5000)] + [(None, "x", 0.0), (1, None, float("nan"))], kinds)
    given = [(k, f"b{k % 7}", k / 2) for k in range(4990, 5200)] + [(None, "x", -0.0), (1, None, float("nan")), (None, None, None), (5300, "n", 1.0), (5300, "n", 1.0)]
    source = spark.createDataFrame([(*g, n) for n, g in enumerate(given)], kinds + ", n int")
    for null_safe in (False, True):
        on = {"a": "a", "b": "b", "c": "c"}
        for words in (joins.FILTER_WORDS, 64, 1):  # roomy, crowded, full
            got = joins.missing_from_large(source, target, on, null_safe=null_safe, words=words)
            assert rows(got.select("n")) == rows(joins.missing_rows(source, target, on, null_safe=null_safe).select("n"))
    bits = joins.key_filter(target, ["a", "b"], 64)
    assert bits.count() <= 64 and bits.columns == ["word", "bits"]
    # Types that do not hash alike go the plain way.
    other = target.withColumn("a", F.col("a").cast("long"))
    assert joins.missing_from_large(source, other, {"a": "a"}).count() == joins.missing_rows(source, other, {"a": "a"}).count()
    assert joins.missing_from_large(source, target.limit(0), {"a": "a"}).count() == len(given)


def test_a_filtered_target_is_not_shuffled(spark, tmp_path):
    spark.range(50_000).selectExpr("id as k", "cast(id as string) as v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(49_990, 80_000).selectExpr("id as k")
    got = joins.missing_from_large(source, target, {"k": "k"})
    assert got.count() == 30_000
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    # What is shuffled: words of the filter, and keys it could not decide; the target joins by broadcast.
    exchanges = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("word" in line or "k#" in line for line in exchanges)
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_kmeans_depends_on_the_points_alone(spark):
    rng = random.Random(4)
    middles = [(0, 0, 90), (500, -300, 0), (-400, 800, 7)]
    data = [(n, *(m + rng.randint(-120, 120) for m in middles[n % 3])) for n in range(300)]
    points = [d[1:] for d in data]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    centres = []
    while len(centres) < 3:
        near = [min(apart(p, c) for c in centres) if centres else apart(p, (0, 0, 0)) for p in points]
        centres.append(points[near.index(max(near))])
    assert clusters.farthest_points(spark.createDataFrame(data, "id int, x long, y long, z long"), ["x", "y", "z"], ["id"], 3) == list(map(list, centres))
    for rounds in (0, 1, 20):
        moving = list(centres)
        for _ in range(rounds):
            told = [min(range(3), key=lambda c: (apart(p, moving[c]), c)) for p in points]
            for c in range(3):
                own = [p for p, t in zip(points, told) if t == c]
                moving[c] = tuple(sum(column) // len(own) for column in zip(*own)) if own else moving[c]
        want = sorted((n, min(range(3), key=lambda c: (apart(p, moving[c]), c))) for n, p in enumerate(points))
        for partitions in (1, 7):
            df = spark.createDataFrame(rng.sample(data, len(data)), "id int, x long, y long, z long").repartition(partitions)
            assert rows(clusters.kmeans(df, ["x", "y", "z"], ["id"], 3, rounds).select("id", "cluster")) == sorted(want, key=repr)
    same = spark.createDataFrame([(1, 5, 5, 5), (2, 5, 5, 5)], "id int, x long, y long, z long")
    assert rows(clusters.kmeans(same, ["x", "y", "z"], ["id"], 3).select("cluster")) == [(0,), (0,)]
    assert clusters.kmeans(same.limit(0), ["x", "y", "z"], ["id"], 3).count() == 0


@pytest.mark.parametrize("slack", [0.02, -0.3])
def test_ranges_from_day_summaries(spark, monkeypatch, slack):
    """Also where every bracket misses: a negative slack leaves none."""
    monkeypatch.setattr(sketches, "SLACK", slack)
    rng = np.random.default_rng(2)
    day = rng.integers(1, 29, 20_000)
    value = np.round(rng.lognormal(2, 1, 20_000), 2)
    data = [(f"202401{d:02d}", "a" if k % 3 else "b", float(x)) for k, (d, x) in enumerate(zip(day, value))]
    data += [("20240103", "a", None), ("20240103", "a", float("nan")), ("20240131", "c", 7.0)]
    df = spark.createDataFrame(data, "fecha string, k string, v double").withColumn("at", F.to_timestamp_ntz("fecha", F.lit("yyyyMMdd")))
    summaries = sketches.day_summaries(df, "at", "v", [], True)
    shares = [0.0, 0.25, 0.5, 0.999, 1.0]
    for first, last in ((3, 9), (8, 28), (31, 31), (30, 30)):
        span = (f"2024-01-{first:02d}", f"2024-01-{last:02d}")
        inside = value[(day >= first) & (day <= last)] if first < 30 else np.array([7.0][: 32 - last])
        if first == 30:
            inside = inside[:0]
        got = sketches.range_quantiles(df, "at", "v", summaries, *span, shares)
        assert got == pytest.approx(list(np.quantile(inside, shares)) if len(inside) else [])
    by_key = sketches.day_summaries(df, "at", "v", ["k"])
    got = {r.k: r for r in sketches.range_moments(by_key, "2024-01-03", "2024-01-31", ["k"]).collect()}
    for k, part in (("a", np.arange(20_000) % 3 > 0), ("b", np.arange(20_000) % 3 == 0)):
        inside = value[(day >= 3) & part]
        r = got[k]
        assert r.n == len(inside) and (r.low, r.high) == (inside.min(), inside.max())
        assert (r["mean"], r.sd) == pytest.approx((inside.mean(), inside.std(ddof=1)))
    assert (got["c"].n, got["c"].sd) == (1, None)


def test_points_in_many_polygons(spark):
    from flowlake.functions.geo import parse_wkt, within_polygon

    rng = random.Random(12)
    shapes = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))", "POLYGON ((10 10, 10.00001 10, 10.00001 10.00001, 10 10))"]
    shapes.append("MULTIPOLYGON (((-170 -80, 170 -80, 0 80, -170 -80)), ((20 70, 21 70, 21 71, 20 71, 20 70)))")
    for _ in range(12):
        x, y, size = rng.uniform(-20, 20), rng.uniform(-20, 20), 10 ** rng.uniform(-2, 1)
        ring = [(x + size * rng.uniform(0.3, 1) * math.cos(k), y + size * rng.uniform(0.3, 1) * math.sin(k)) for k in np.linspace(0, 6, 9)]
        shapes.append("POLYGON ((" + ", ".join(f"{a} {b}" for a, b in [*ring, ring[0]]) + "))")
    points = [(k, rng.uniform(-22, 22), rng.uniform(-22, 22)) for k in range(1500)]
    points += [(2000 + k, float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (1, 1), (2, 2), (3, 2), (0.5, 0.5), (4, 1), (1, 3)])]
    points += [(2100, 10.000006, 10.000002), (2101, None, 1.0), (2102, float("nan"), 1.0), (2000, 0.5, 0.5)]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    table = spark.createDataFrame([*enumerate(shapes), (90, None), (0, shapes[0])], "name int, wkt string")
    got = spatial.points_in_polygons(df, table.withColumn("geometry", parse_wkt(F.col("wkt"))), "name")
    want = []
    for name, wkt in [*enumerate(shapes), (0, shapes[0])]:
        inside = df.where(within_polygon(F.col("lon"), F.col("lat"), wkt)).where("not isnan(lon)").select("id", F.lit(name).alias("name"))
        want += rows(inside)
    assert rows(got.select("id", "name")) == sorted(want, key=repr) and len(want) > 300
    assert got.columns == ["id", "lon", "lat", "name"]
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = table.limit(0).withColumn("geometry", parse_wkt(F.col("wkt")))
    assert spatial.points_in_polygons(df, none, "name").count() == 0


def test_points_in_polygons_deal_out_cells_and_places(spark, monkeypatch):
    """Polygons of one task make cells in several, with the edges near them; rows of a place are joined as one."""
    from flowlake.functions.geo import edges, parse_wkt, within_edges

    kept = {}

    def stored(df, name):
        kept[name] = tables.stored(df, name)
        return kept[name]

    monkeypatch.setattr(spatial, "stored", stored)
    monkeypatch.setattr(spatial, "TOGETHER", 3, raising=False)  # several lists a place
    corners = [(8 * math.cos(k * math.pi / 200), 8 * math.sin(k * math.pi / 200)) for k in range(400)]
    disc = "POLYGON ((" + ", ".join(f"{a} {b}" for a, b in [*corners, corners[0]]) + "))"
    unclosed = "POLYGON ((0 0, 9 0, 9 9, 0 9, x))"
    wkts = [(k, disc) for k in range(12)] + [(3, disc), (None, disc), (20, unclosed)]
    shapes = spark.createDataFrame(wkts, "name int, wkt string").coalesce(1).withColumn("geometry", parse_wkt(F.col("wkt")))
    places = [(0.0, -0.0)] * 7 + [(0.0, 0.0)] * 2 + [(7.9, 0.1)] * 4 + [(8.0, 0.0), (9.0, 0.5), (None, 1.0)]
    df = spark.createDataFrame([(k % 5, *place, {"n": k}) for k, place in enumerate(places)], "id int, lon double, lat double, more map<string,int>")
    got = spatial.points_in_polygons(df, shapes, "name")
    tried = df.crossJoin(shapes.select("name", edges(F.col("geometry")).alias("e"))).where(within_edges(F.col("lon"), F.col("lat"), F.col("e")))
    want = rows(tried.drop("e"))
    assert rows(got) == want and len(want) == 13 * 14 + 4
    cells = kept["polygon-cells"]
    assert len(cells.inputFiles()) > 1
    assert cells.where("border").agg(F.max(F.size("edges"))).first()[0] < 200
    assert cells.where("not border and edges is not null").isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2
