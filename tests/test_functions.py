"""Column expressions against hand-made values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowlake.functions import geo, numeric, temporal, text
from tests.conftest import rows


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("label", "expected"),
    [
        ("Alacant/Alicante. Total", "alicante"),
        ("Sóller/", "soller"),
        (" Peñón-del-Río . x", "penon del rio"),
        (" Ávila ", "avila"),
        ("Vic.Total.CNAE", "vic"),
        ("Ávila", "avila"),
        (None, None),
    ],
)
def test_normalise_name(spark, label, expected):
    assert one(spark, label, "string", text.normalise_name) == expected


def test_label_tokens(spark):
    label = "Vic. Hombres . Renta Neta"
    assert one(spark, label, "string", lambda c: text.label_token(c, 2)) == "hombres"
    assert one(spark, label, "string", lambda c: text.label_token(c, 3)) == "renta neta"
    assert one(spark, label, "string", lambda c: text.label_token(c, 4)) == ""


@pytest.mark.parametrize(
    ("raw", "expected"), [("1.234", 1234), ("1234.0", 1234), (" 12 ", 12), ("n/a", 0), (None, 0)]
)
def test_clean_population(spark, raw, expected):
    assert one(spark, raw, "string", text.clean_population) == expected


def test_clean_id(spark):
    assert one(spark, " 01002.0 ", "string", text.clean_id) == "01002"


def test_hours_have_no_zone(spark):
    """The hour that a summer-time change skips stays as it is."""
    stamp = spark.createDataFrame([("20230326", 2)], "d string, h int").select(
        temporal.add_hours(temporal.parse_day(F.col("d")), F.col("h"))
    )
    assert stamp.first()[0] == datetime(2023, 3, 26, 2)


def test_weekdays_start_on_sunday(spark):
    days = spark.createDataFrame([(date(2024, 1, 6 + i),) for i in range(3)], "d date")
    got = days.select(temporal.day_of_week(F.col("d")), temporal.is_weekend(F.col("d")))
    assert [tuple(r) for r in got.collect()] == [(6, True), (0, True), (1, False)]
    assert one(spark, 0, "int", temporal.weekday_name) == "sunday"


def test_text_partition_parts(spark):
    parts = spark.createDataFrame([("20240105",)], "c string").select(
        *temporal.day_text_parts(F.col("c"))
    )
    assert tuple(parts.first()) == (2024, 1, 5)


def test_service_bands(spark):
    values = [0.1, 0.25, 0.75, 1.25, 1.3, 2.5, 2.6, None]
    df = spark.createDataFrame([(v,) for v in values], "r double").select(
        numeric.service_class(F.col("r")).alias("c")
    )
    got = [tuple(r) for r in df.select("c", numeric.service_rank(F.col("c"))).collect()]
    assert got == [
        ("very_low", 1), ("low", 2), ("balanced", 3), ("balanced", 3), ("high", 4), ("high", 4),
        ("very_high", 5), (None, None),
    ]


SHAPES = {
    "two_parts_and_hole": (
        "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)),"
        " ((6 0, 8 0, 8 2, 6 2, 6 0)))"
    ),
    "clockwise_square": "polygon((0 0,0 1,1 1,1 0,0 0))",
    "with_height": "POLYGON Z ((0 0 5, 2 0 5, 2 2 5, 0 2 5, 0 0 5))",
    "far_away": "SRID=4326;POLYGON ((100 50, 100.001 50, 100.001 50.001, 100 50.001, 100 50))",
}


def test_centroids(spark):
    df = spark.createDataFrame(list(SHAPES.items()), "name string, w string")
    g = geo.parse_wkt(F.col("w"))
    got = {
        r.name: (r.a, r.c.lon, r.c.lat)
        for r in df.select("name", geo.area(g).alias("a"), geo.centroid(g).alias("c")).collect()
    }
    assert got["two_parts_and_hole"] == pytest.approx((19, 58.5 / 19, 34.5 / 19))
    assert got["clockwise_square"] == pytest.approx((1, 0.5, 0.5))
    assert got["with_height"] == pytest.approx((4, 1, 1))
    assert got["far_away"] == pytest.approx((1e-6, 100.0005, 50.0005))


def test_malformed_geometry_is_flagged(spark):
    texts = [*SHAPES.values(), "POLYGON((0 0,1 0,x 1,0 1,0 0))", "POLYGON((0 0,1 0,1 1,0 1))"]
    texts += ["POINT (0 0)", "POLYGON EMPTY", "junk", None]
    df = spark.createDataFrame([(t,) for t in texts], "w string")
    valid = [r[0] for r in df.select(geo.is_valid_geometry(F.col("w"))).collect()]
    assert valid == [True] * 4 + [False] * 6
    centroids = df.select(geo.centroid(geo.parse_wkt(F.col("w")))).collect()
    assert all(r[0] is None for r in centroids[6:])


def test_within_polygon_excludes_boundary_and_hole(spark):
    polygon = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    points = {
        (1.0, 1.0): True, (5.0, 5.0): False, (0.0, 5.0): False, (10.0, 10.0): False,
        (4.0, 5.0): False, (3.0, 4.0): True, (-1.0, 5.0): False, (7.0, 6.0): True,
    }
    df = spark.createDataFrame(list(points), "x double, y double")
    inside = geo.within_polygon(F.col("x"), F.col("y"), polygon)
    got = {(r.x, r.y): r.i for r in df.withColumn("i", inside).collect()}
    assert got == points


@pytest.mark.parametrize("bad", ["POINT (1 1)", "POLYGON ((0 0, 1 0, 1 1))", ""])
def test_polygon_parameter_is_checked(bad):
    with pytest.raises(ValueError):
        geo.polygon_edges(bad)


def test_distance_and_geojson(spark):
    madrid_barcelona = geo.distance_km(*map(F.lit, (-3.7038, 40.4168, 2.1734, 41.3851)))
    assert spark.range(1).select(madrid_barcelona).first()[0] == pytest.approx(504.6, abs=1)
    shape = one(
        spark, SHAPES["clockwise_square"], "string", lambda c: geo.geojson(geo.parse_wkt(c))
    )
    assert shape == (
        '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[0.0,1.0],[1.0,1.0],[1.0,0.0],[0.0,0.0]]]]}'
    )
    centre = spark.range(1).select(geo.map_centre("POLYGON ((0 0, 2 0, 2 4, 0 4, 0 0))")).first()[0]
    assert (centre.lon, centre.lat) == (1.0, 2.0)
    assert rows(spark.range(1)) == [(0,)]
