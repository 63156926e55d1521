"""Flows, zones, gravity model, functional type and reports on hand-made rows."""

import math
import random
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.plans import gravity, od, reports, zone_function
from flowlake.plans import zones as Z
from flowlake.sinks.reports import ReportParams
from tests.conftest import rows

SQUARE = "POLYGON (({0} {1}, {2} {1}, {2} {3}, {0} {3}, {0} {1}))"


def od_raw(spark, *tuples):
    return spark.createDataFrame(list(tuples), schemas.OD_RAW)


def holiday(spark):
    return spark.createDataFrame([(date(2024, 1, 1), "New year")], "date date, name string")


def zone(spark, **points):
    data = [(z, f"Zone {z}", SQUARE.format(x - 1, y - 1, x + 1, y + 1)) for z, (x, y) in points.items()]
    raw = spark.createDataFrame(data, "ID string, Nombre string, geometry string")
    mapping = raw.select(F.col("ID").alias("municipio_mitma"))
    return Z.zones(raw, mapping)


def hourly(spark, *tuples):
    """(day, hour, origin, destination, trips) as hourly flows."""
    data = [
        (datetime.fromisoformat(f"{d} {h:02d}:00"), o, t, float(v), 2.0 * v, "r", False, False)
        for d, h, o, t, v in tuples
    ]
    return spark.createDataFrame(data, schemas.OD_HOURLY)


def test_od_hourly(spark):
    raw = od_raw(
        spark,
        ("20240101", "8", "1", "2", "1.5", "3", "a"),
        ("20240101", "8", "1", "2", "2.5", "4", "a"),  # another demographic segment
        ("20240101", "8", "1", "2", "1", "1", None),
        ("20240106", "23", "2", "1", "1", "1", "a"),
        ("20240102", "0", "externo", "1", "9", "9", "a"),
        ("20240102", "0", "1", None, "9", "9", "a"),
        ("20240102", "0", "1", "2", None, "9", "a"),
    )
    got = od.od_hourly(raw, holiday(spark))
    assert rows(got) == rows(
        spark.createDataFrame(
            [
                (datetime(2024, 1, 1, 8), "1", "2", 4.0, 7.0, "a", False, True),
                (datetime(2024, 1, 1, 8), "1", "2", 1.0, 1.0, None, False, True),
                (datetime(2024, 1, 6, 23), "2", "1", 1.0, 1.0, "a", True, False),
            ],
            schemas.OD_HOURLY,
        )
    )
    assert got.agg(F.sum("viajes")).first()[0] == 6.0
    assert od.od_hourly(raw, holiday(spark), ["20240106"]).count() == 1
    assert od.od_hourly(raw, holiday(spark), require_residence=True).count() == 2
    parsed = raw.withColumn("fecha", F.to_timestamp_ntz("fecha", F.lit("yyyyMMdd")))
    assert rows(od.od_hourly(parsed, holiday(spark), ["20240101", "20240106"])) == rows(got)


def test_bad_numbers_raise_or_are_counted(spark):
    raw = od_raw(
        spark,
        ("20240101", "8", "1", "2", "x", "3", "a"),
        ("20240101", "8", "1", "2", "1", "3", "a"),
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        od.od_hourly(raw, holiday(spark)).collect()
    assert od.od_hourly(raw, holiday(spark), tolerant=True).first().viajes == 1.0
    assert od.rejected(raw).first().asDict() == {"periodo": 0, "viajes": 1, "viajes_km": 0}


def test_typical_day_in_batches_equals_all_at_once(spark):
    flows = hourly(
        spark,
        ("2024-01-01", 8, "1", "2", 3),
        ("2024-01-01", 8, "1", "2", 4),
        ("2024-01-02", 8, "1", "2", 5),
    )
    everything = od.typical_day(flows)
    assert rows(everything) == rows(
        od.typical_day(flows, ["20240101"]).union(od.typical_day(flows, ["20240102"]))
    )
    assert rows(everything.select("hour", "avg_trips", "avg_km")) == [(8, 5.0, 10.0), (8, 7.0, 14.0)]
    assert rows(od.typical_day(flows, [])) == []


def test_od_quality(spark):
    flows = hourly(spark, *[("2024-01-01", h, "1", "2", 10) for h in range(20)])
    flows = flows.union(
        hourly(
            spark,
            ("2024-01-02", 1, "1", "2", 500),
            ("2024-01-02", 1, "2", "1", -5),
            ("2024-01-02", 1, "3", "1", 5),
        )
    )
    profile = spark.createDataFrame([("1", 10.0), ("2", 0.0)], "id string, poblacion_total double")
    got = od.od_quality(flows, profile, ["20240102"]).orderBy("origen_zone_id").collect()
    assert [r.viajes_per_capita for r in got] == [50.0, None, None]
    assert [r.flag_negative_viajes for r in got] == [False, True, False]
    assert [r.flag_outlier_viajes_per_capita for r in got] == [True, False, False]
    values = [1.0] * 20 + [50.0]
    assert got[0].z_viajes_per_capita == pytest.approx(
        (50 - np.mean(values)) / np.std(values, ddof=1)
    )
    alone = od.od_quality(hourly(spark, ("2024-01-01", 1, "1", "2", 10)), profile).first()
    assert alone.z_viajes_per_capita == 0.0  # no spread: deviation 1
    moments = od.day_moments(flows)
    kept = od.od_quality(flows, profile, ["20240102"], moments).orderBy("origen_zone_id").collect()
    assert kept[0].z_viajes_per_capita == pytest.approx(got[0].z_viajes_per_capita)


def test_surveys(spark):
    people = spark.createDataFrame(
        [("20240105", "1", "a", "H", "2", "3.5"), ("20240105", "1", None, "H", "2", "3")],
        "fecha string, zona_pernoctacion string, edad string, sexo string, numero_viajes string, personas string",
    )
    assert rows(od.people_day(people)) == [(date(2024, 1, 5), "1", "a", "H", "2", 3.5)]
    nights = spark.createDataFrame(
        [("20240105", "1", "2", "7"), ("20240105", "1", None, "7")],
        "fecha string, zona_pernoctacion string, zona_residencia string, personas string",
    )
    assert rows(od.overnight_stay(nights)) == [(date(2024, 1, 5), "1", "2", 7.0)]


def series(spark, *labelled):
    data = [(f"S{i}", name, [(v,) for v in values]) for i, (name, values) in enumerate(labelled)]
    return spark.createDataFrame(data, schemas.SERIES_RAW)


@pytest.fixture
def mapping(spark):
    municipalities = spark.createDataFrame(
        [
            ("1", "01", "Ávila. x"), ("2", "02", "Alacant/Alicante"), ("3", "03", "San Juan"),
            ("4", "04", "San-Juan"), ("5", None, "Nowhere"), ("6", "06", None), ("7", "07", "Lone"),
        ],
        schemas.MUNICIPALITY_RAW,
    )
    relation = spark.createDataFrame(
        [("01", "z1"), ("01", "z1"), ("02", "z1"), ("03", "z2"), ("04", "z3"), ("07", None)],
        "municipio_ine string, municipio_mitma string",
    )
    return Z.name_map(municipalities, relation)


def test_name_map(mapping):
    assert rows(mapping) == [
        ("alicante", "02", "z1"), ("avila", "01", "z1"), ("san juan", "03", "z2"),
        ("san juan", "04", "z3"),
    ]
    assert rows(Z.ambiguous_names(mapping)) == [("san juan", 2)]


def test_socio_economic_tables(spark, mapping):
    companies = series(
        spark,
        ("AVILA. Total CNAE", [5.0, 7.0]),
        ("Alicante. cnae", [None, 3.0]),
        ("Ávila. Otros", [99.0]),
        ("San Juan. CNAE", []),
    )
    assert rows(Z.companies(companies, mapping, "2024")) == [
        ("z1", 10.0, "2024"), ("z2", 0.0, "2024"), ("z3", 0.0, "2024"),
    ]
    people = series(
        spark,
        ("Ávila. Total. P", [10.0, 11.0]),
        ("Ávila. Hombres. P", [6.0]),
        ("Alicante. Mujeres. P", [4.0]),
        ("San Juan. Total. P", [8.0]),
    )
    assert rows(Z.population(people, mapping, "2024")) == [
        ("z1", 11.0, 6.0, 4.0, "2024"), ("z2", 8.0, 0.0, 0.0, "2024"),
        ("z3", 8.0, 0.0, 0.0, "2024"),
    ]
    kind = "Renta neta media por persona"
    money = series(
        spark,
        (f"Ávila. Dato base. {kind}", [100.456, 90.0]),
        (f"Alicante. Dato base. {kind}", [120.0]),
        (f"Ávila sección 3. Dato base. {kind}", [999.0]),
        (f"Alicante Distrito 1. Dato base. {kind}", [999.0]),
        ("Alicante. Dato base. Renta bruta", [999.0]),
        (f"San Juan. Dato base. {kind}", [None]),
    )
    kind = kind.lower()
    assert rows(Z.income(money, mapping, "2024")) == [
        ("z1", kind, 120.0, "2024"), ("z2", kind, 0.0, "2024"), ("z3", kind, 0.0, "2024"),
    ]
    assert rows(Z.income(money.limit(1), mapping, "2024"))[1] == ("z2", None, 0.0, "2024")


def test_zones_and_profile(spark, mapping):
    raw = spark.createDataFrame(
        [("z1", "One", SQUARE.format(0, 0, 2, 2))] * 2
        + [("z2", "Two", SQUARE.format(4, 0, 6, 2)), ("z9", "Unmapped", SQUARE.format(0, 0, 1, 1))]
        + [("z3", None, SQUARE.format(0, 0, 1, 1)), ("z3", "Broken", "POLYGON ((0 0, 1 1))")],
        "ID string, Nombre string, geometry string",
    )
    zones = Z.zones(raw, mapping)
    assert rows(zones.select("id", "centroid.lon", "centroid.lat")) == [
        ("z1", 1.0, 1.0), ("z2", 5.0, 1.0), ("z3", None, None),
    ]
    assert rows(Z.invalid_zones(raw).select("id")) == [("z3",)]
    companies = spark.createDataFrame([("z1", 4.0)], "zone_id string, empresas double")
    income = spark.createDataFrame([("z2", 9.5)], "zone_id string, renta_media double")
    people = spark.createDataFrame(
        [("z1", 3.0, 2.0, 1.0)],
        "zone_id string, poblacion_total double, poblacion_hombres double, poblacion_mujeres double",
    )
    got = Z.zone_profile(zones, companies, income, people, "2024").drop("nombre")
    assert rows(got) == [
        ("z1", 4.0, 0.0, 3.0, 2.0, 1.0, "2024"), ("z2", 0.0, 9.5, 0.0, 0.0, 0.0, "2024"),
        ("z3", 0.0, 0.0, 0.0, 0.0, 0.0, "2024"),
    ]


def km(a, b):
    (x1, y1), (x2, y2) = (tuple(map(math.radians, p)) for p in (a, b))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_distances_against_brute_force(spark):
    """Every pair that has flows, with ids that compare as text."""
    rng = random.Random(5)
    points = {str(i): (rng.uniform(-9, 3), rng.uniform(36, 43)) for i in range(45)}
    zones = zone(spark, **points)
    every = hourly(spark, *[("2024-01-01", 1, a, b, 1) for a in points for b in points])
    got = {(r.origin, r.destination): r.distance_km for r in Z.flow_distances(every, zones).collect()}
    want = {(a, b): km(points[a], points[b]) for a in points for b in points if a < b}
    assert got.keys() == want.keys() and len(got) == 45 * 44 // 2
    assert all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    flows = hourly(spark, ("2024-01-01", 1, "9", "10", 1), ("2024-01-01", 1, "3", "3", 1))
    assert rows(Z.flow_distances(flows, zones).select("origin", "destination")) == [("10", "9")]
    swapped = Z.pair_distances(
        spark.createDataFrame([("1", "2")], "origin string, destination string"), zones, swap_axes=True
    ).first()
    assert swapped.distance_km == pytest.approx(km(points["1"][::-1], points["2"][::-1]), rel=1e-6)


POINTS = {"a": (0.0, 40.0), "b": (1.0, 40.5), "c": (2.0, 41.0), "d": (3.0, 41.5)}


def gravity_inputs(spark, seed=6):
    rng = random.Random(seed)
    pairs = [(o, d) for o in POINTS for d in POINTS]
    flows = hourly(
        spark,
        *[
            (f"{year}-06-0{day}", rng.randrange(24), o, d, rng.randrange(1, 50))
            for year in (2023, 2024)
            for day in (1, 2)
            for o, d in pairs
        ],
    )
    profile = spark.createDataFrame(
        [("a", 3000.0, 5.0, "2024"), ("b", 2000.0, 0.0, "2024"), ("c", 1000.0, 7.0, "2024"), ("d", 500.0, 9.0, "2024")],
        "id string, poblacion_total double, empresas double, year string",
    )
    return flows, zone(spark, **POINTS), profile


def test_gravity_k_equals_the_grid_scan(spark):
    base = gravity.gravity_base(*gravity_inputs(spark)).collect()
    assert len(base) == 6  # a < b orientation only, newest year only
    actual = np.array([r.actual_trips for r in base])
    pull = np.array([r.gravity_no_k for r in base])
    grid = np.linspace(10e-5, 1, 5000)
    errors = [np.sqrt(np.mean((actual - k * pull) ** 2)) for k in grid]
    frame = spark.createDataFrame(
        [(float(a), float(g)) for a, g in zip(actual, pull)] + [(5.0, None)],
        "actual_trips double, gravity_no_k double",
    )
    fit = gravity.fit_gravity_k(frame).first()
    assert fit.k == pytest.approx(grid[int(np.argmin(errors))])
    assert fit.rmse == pytest.approx(min(errors)) and fit.pairs == 6


@pytest.mark.parametrize(
    ("actual", "pull", "k"), [(100.0, 1.0, 1.0), (1.0, 1e9, 1e-4), (5.0, 0.0, 1e-4), (5.0, None, 1e-4)]
)
def test_gravity_k_stays_on_the_grid(spark, actual, pull, k):
    frame = spark.createDataFrame([(actual, pull)], "actual_trips double, gravity_no_k double")
    assert gravity.fit_gravity_k(frame).first().k == pytest.approx(k)


def test_gravity_mismatch(spark):
    flows, zones, profile = gravity_inputs(spark)
    got = gravity.gravity_mismatch(flows, zones, profile, 0.5).collect()
    assert len(got) == 6 * 4
    for r in got:
        people = {"a": 3000, "b": 2000, "c": 1000, "d": 500}[r.origin_id]
        firms = {"a": 5, "b": 0, "c": 7, "d": 9}[r.destination_id]
        distance = km(POINTS[r.origin_id], POINTS[r.destination_id])
        want = 0.5 * people * firms / distance**2
        assert r.estimated_trips == pytest.approx(want, rel=1e-6)
        assert r.mismatch_ratio == (pytest.approx(r.actual_trips / want, rel=1e-6) if firms else None)
    assert gravity.gravity_mismatch(flows, zones, profile, 0.5, symmetric=True).count() == 12 * 4
    with pytest.raises(ValueError, match="one row per zone"):
        gravity.gravity_mismatch(flows, zones, profile.union(profile), 0.5)
    assert gravity.latest_year(flows) == 2024


def test_rhythm_equals_the_full_outer_join(spark):
    flows, _, _ = gravity_inputs(spark, 7)
    flows = flows.union(hourly(spark, ("2024-01-07", 5, "only_out", "only_in", 4)))
    parts = [F.expr("dayofweek(fecha) - 1 AS dow"), F.expr("hour(fecha) AS hour")]
    leave = flows.groupBy(F.col("origen_zone_id").alias("zone_id"), *parts)
    arrive = flows.groupBy(F.col("destino_zone_id").alias("zone_id"), *parts)
    keys = ["zone_id", "dow", "hour"]
    leave, arrive = leave.agg(F.avg("viajes").alias("o")), arrive.agg(F.avg("viajes").alias("i"))
    joined = leave.join(arrive, keys, "full_outer").select(
        *keys, F.coalesce("o", F.lit(0.0)).alias("avg_out_trips"), F.coalesce("i", F.lit(0.0)).alias("avg_in_trips")
    )
    got = zone_function.zone_rhythm(flows)
    assert rows(got) == rows(joined)
    assert rows(got.where("zone_id like 'only%'")) == [
        ("only_in", 0, 5, 0.0, 4.0), ("only_out", 0, 5, 4.0, 0.0),
    ]


def test_zone_function_separates_two_rhythms(spark):
    tuples = []
    for day in range(1, 15):
        for h in range(24):
            for z in range(3):
                tuples.append((f"2024-01-{day:02d}", h, f"home{z}", f"work{z}", 900 + z))
                tuples.append((f"2024-01-{day:02d}", h, f"work{z}", f"home{z}", 10 + z))
    flows = hourly(spark, *tuples)
    got = dict(rows(zone_function.zone_function(flows)))
    assert {z: k for z, k in got.items() if z.startswith("home")} == {
        f"home{z}": "Residential" for z in range(3)
    }
    assert {k for z, k in got.items() if z.startswith("work")} == {"Non-residential"}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got == dict(rows(zone_function.zone_function(flows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


INSIDE = ReportParams("2024-01-01", "2024-01-03", SQUARE.format(-0.5, 39, 2.5, 45))


def report_flows(spark):
    return hourly(
        spark,
        ("2024-01-01", 8, "a", "b", 30), ("2024-01-02", 8, "a", "b", 10), ("2024-01-02", 9, "b", "a", 5),
        ("2024-01-03", 8, "c", "c", 40), ("2024-01-03", 9, "a", "d", 70), ("2024-01-09", 8, "a", "b", 999),
    )


def test_typical_day_reports(spark):
    typical, zones = od.typical_day(report_flows(spark)), zone(spark, **POINTS)
    arcs = reports.od_arcs(typical, zones, INSIDE)
    assert rows(arcs.select("origin", "destination", "avg_trips")) == [
        ("Zone a", "Zone b", 20.0), ("Zone c", "Zone c", 40.0),
    ]
    top = [tuple(r) for r in reports.top_origins(typical, zones, INSIDE, 2).collect()]
    assert top == [("Zone c", 40.0), ("Zone a", pytest.approx(110 / 3))]
    hourly_rows = rows(reports.hourly_distribution(typical, zones, INSIDE))
    assert hourly_rows == [
        ("All municipalities", 8, 60.0), ("All municipalities", 9, 75.0), ("Zone a", 8, 20.0),
        ("Zone a", 9, 70.0), ("Zone b", 9, 5.0), ("Zone c", 8, 40.0),
    ]
    assert reports.as_json_rows(arcs.select("origin").limit(1)).first()[0].startswith('{"origin":"Zone')


def test_mismatch_reports(spark):
    mismatch = spark.createDataFrame(
        [
            ("a", "b", date(2024, 1, 1), 10.0, 20.0, 0.5), ("a", "b", date(2024, 1, 2), 20.0, 20.0, 1.0),
            ("a", "d", date(2024, 1, 2), 30.0, 10.0, 3.0), ("b", "c", date(2024, 1, 3), 1.0, None, None),
            ("d", "a", date(2024, 1, 3), 1.0, 1.0, 1.0), ("a", "b", date(2024, 2, 2), 9.0, 1.0, 9.0),
        ],
        "origin_id string, destination_id string, date date, actual_trips double, estimated_trips double, mismatch_ratio double",
    )
    zones = zone(spark, **POINTS)
    ratios = reports.mismatch_ratios(mismatch, zones, INSIDE)
    assert rows(ratios.where("mm_ratio is not null").select("mm_ratio")) == [(0.75,), (3.0,)]
    bins = reports.mismatch_histogram(mismatch, zones, INSIDE).collect()
    assert len(bins) == 50 and sum(r.frequency for r in bins) == 2
    table = [tuple(r) for r in reports.mismatch_table(mismatch, zones, INSIDE).collect()]
    assert table == [("Zone a", "Zone b", 15.0, 20.0, 0.75), ("Zone b", "Zone c", 1.0, None, None)]
    bounds = reports.ratio_bounds(reports.mismatch_table(mismatch, zones, INSIDE)).first()
    assert tuple(bounds) == (0.75, 0.75)
    arcs = reports.mismatch_arcs(mismatch, zones, INSIDE)
    assert rows(arcs.select("origin", "service_class", "service_rank")) == [
        ("Zone a", "balanced", 3), ("Zone b", None, None),
    ]


def test_in_out_report_last_day(spark):
    zones = zone(spark, **POINTS)
    kinds = spark.createDataFrame([("a", "Residential"), ("c", "Non-residential")], "zone_id string, functional_type string")
    got = reports.in_out_distribution(report_flows(spark), kinds, zones, INSIDE)
    assert rows(got.where("hour = 9")) == [("All", "All", 9, 70.0, 5.0), ("Zone a", "Residential", 9, 70.0, 5.0)]
    strict = reports.in_out_distribution(report_flows(spark), kinds, zones, INSIDE, end_inclusive_day=False)
    assert strict.where("municipality = 'Zone c'").count() == 0
    shapes = reports.zone_geojson(zones, kinds, INSIDE.polygon)
    assert rows(shapes.select("name", "functional_type")) == [
        ("Zone a", "Residential"), ("Zone c", "Non-residential"),
    ]
    assert '"type":"MultiPolygon"' in shapes.first().geometry
