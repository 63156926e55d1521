"""The registered queries: each runs an operator of the library over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake import schemas
from flowlake.functions.geo import distance_km, map_centre, parse_wkt
from flowlake.functions.temporal import day_key
from flowlake.functions.text import clean_population as clean_text_population
from flowlake.operators import distribution, incremental, joins, merge, picks, sketches, spatial
from flowlake.plans import gravity, lake, od, reports, zone_function
from flowlake.plans import zones as Z
from flowlake.session import configure, scratch_path
from flowlake.sinks import buckets, days, tables
from flowlake.sinks import reports as report_sink
from flowlake.sinks.folders import files_under, rename
from flowlake.sources import catalog, feed, files, outcomes
from flowlake.streaming import ingest
from workload.sql import TABLES
from workload.views import HOLED, LARGE_PARAMS, PARAMS, TRIANGLE, YEAR, Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Views(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round for comparison: the last digits of a sum of doubles depend on its order."""
    return df.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns]
    )


def hourly(v: Views) -> DataFrame:
    return od.od_hourly(v.od_raw(), v.holiday())


def hourly_large(v: Views) -> DataFrame:
    return od.od_hourly(v.od_raw_large(), v.holiday())


def mismatch(v: Views, od: DataFrame | None = None) -> DataFrame:
    flows = hourly(v) if od is None else od
    return gravity.gravity_model(flows, **v.gravity_inputs(flows))


def rule_function(v: Views) -> DataFrame:
    """A functional type by a fixed rule, so that reports on it can be compared."""
    mean = zone_function.zone_rhythm(hourly(v)).groupBy("zone_id")
    leaves = F.avg("avg_out_trips") > F.avg("avg_in_trips")
    typed = mean.agg(
        F.when(leaves, "Residential").otherwise("Non-residential").alias("functional_type")
    )
    return v.stored(typed, "rule-function")


# -- flows ----------------------------------------------------------------------------------


@query
def od_hourly(v: Views) -> DataFrame:
    return rounded(hourly(v), viajes=4, viajes_km=4)


@query
def od_hourly_large(v: Views) -> DataFrame:
    return rounded(hourly_large(v), viajes=4, viajes_km=4)


@query
def od_hourly_weekend_holiday(v: Views) -> DataFrame:
    return od.day_counts(hourly(v))


@query
def od_month_totals(v: Views) -> DataFrame:
    return rounded(od.month_totals(hourly_large(v)), viajes=4, viajes_km=4)


@query
def rejected_values(v: Views) -> DataFrame:
    """Strict-cast audit, on rows whose trip and hour columns hold free text."""
    raw = v.table("events").select(
        F.col("event_type").alias("periodo"),
        F.when(F.col("user_id") % 29 >= 25, "externo").otherwise("z").alias("origen"),
        F.lit("z").alias("destino"),
        F.col("props").alias("viajes"),
        F.col("value").cast("string").alias("viajes_km"),
    )
    return od.rejected(raw)


@query
def typical_day(v: Views) -> DataFrame:
    return rounded(od.typical_day(hourly(v)), avg_trips=4, avg_km=4)


@query
def typical_day_large(v: Views) -> DataFrame:
    return rounded(od.typical_day(hourly_large(v)), avg_trips=4, avg_km=4)


@query
def od_quality(v: Views) -> DataFrame:
    return rounded(
        od.od_quality(v.stored(hourly(v), "od"), v.stored(v.profile(), "profile")),
        viajes_per_capita=15,
        km_per_capita=15,
        z_viajes_per_capita=4,
    )


@query
def people_day(v: Views) -> DataFrame:
    return od.people_day(v.people_day_raw())


@query
def overnight_stay(v: Views) -> DataFrame:
    return od.overnight_stay(v.overnight_raw())


# -- zones ----------------------------------------------------------------------------------


@query
def name_map(v: Views) -> DataFrame:
    return v.name_map()


@query
def ambiguous_names(v: Views) -> DataFrame:
    return Z.ambiguous_names(v.name_map())


@query
def zones(v: Views) -> DataFrame:
    """Centroids stand for the geometry, which is an array."""
    return Z.zones(v.municipality_zone_raw(), v.name_map()).select(
        "id",
        "nombre",
        F.size("geometry").alias("n_parts"),
        F.round("centroid.lon", 6).alias("lon"),
        F.round("centroid.lat", 6).alias("lat"),
    )


@query
def zone_distances(v: Views) -> DataFrame:
    return rounded(Z.flow_distances(hourly(v), v.zone()), distance_km=4)


@query
def invalid_zones(v: Views) -> DataFrame:
    return Z.invalid_zones(v.broken_zone_raw())


@query
def clean_population(v: Views) -> DataFrame:
    """Dotted thousands, a trailing ``.0``, text, and plain numbers."""
    k = F.col("o_orderkey")
    dotted = F.concat(F.floor(k / 1000), F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0"))
    text = F.when(k % 4 == 0, F.concat(k, F.lit(".0"))).when((k % 4 == 1) & (k >= 1000), dotted).when(k % 4 == 2, "n/a")
    return v.table("orders").select(k.alias("id"), clean_text_population(text.otherwise(k.cast("string"))).alias("people"))


@query
def companies(v: Views) -> DataFrame:
    return Z.companies(v.companies_raw(), v.name_map(), YEAR)


@query
def population(v: Views) -> DataFrame:
    return Z.population(v.population_raw(), v.name_map(), YEAR)


@query
def income(v: Views) -> DataFrame:
    return Z.income(v.income_raw(), v.name_map(), YEAR)


@query
def zone_profile(v: Views) -> DataFrame:
    return v.profile()


@query
def profile_chain(v: Views) -> DataFrame:
    """From series rows to the profile of the mapped zones."""
    mapping = v.stored(v.name_map(), "name-map")
    zone = Z.zones(v.municipality_zone_raw(), mapping)
    parts = [
        build(raw, mapping, YEAR)
        for build, raw in ((Z.companies, v.companies_raw()), (Z.income, v.income_raw()), (Z.population, v.population_raw()))
    ]
    return rounded(Z.zone_profile(zone, *parts, YEAR), renta_media=2)


@query
def zone_attributes(v: Views) -> DataFrame:
    names = v.table("customer").select(
        F.col("c_custkey").cast("string").alias("ID"), F.col("c_name").alias("Nombre")
    )
    counts = v.table("orders").groupBy(F.col("o_custkey").cast("string").alias("ID"))
    return files.zone_attributes(names, counts.agg(F.count("*").cast("string").alias("Poblacion")))


# -- gravity model --------------------------------------------------------------------------


@query
def gravity_base(v: Views) -> DataFrame:
    base = gravity.gravity_base_of(**v.gravity_inputs(hourly(v)))
    return rounded(base, actual_trips=4, gravity_no_k=4)


@query
def gravity_k(v: Views) -> DataFrame:
    base = gravity.gravity_base_of(**v.gravity_inputs(hourly(v)))
    return rounded(gravity.fit_gravity_k(base).drop("pairs"), k=8, rmse=4)


@query
def gravity_mismatch(v: Views) -> DataFrame:
    return rounded(mismatch(v), actual_trips=4, estimated_trips=4, mismatch_ratio=4)


@query
def gravity_mismatch_large(v: Views) -> DataFrame:
    return rounded(mismatch(v, hourly_large(v)), actual_trips=4, estimated_trips=4, mismatch_ratio=4)


@query
def mismatch_histogram(v: Views) -> DataFrame:
    return rounded(reports.mismatch_histogram(mismatch(v), v.zone(), PARAMS), lower=4, upper=4)


@query
def mismatch_histogram_truncated(v: Views) -> DataFrame:
    bins = reports.mismatch_histogram(mismatch(v), v.zone(), PARAMS, upper=10)
    return rounded(bins, lower=4, upper=4)


@query
def mismatch_density(v: Views) -> DataFrame:
    return rounded(reports.mismatch_density(mismatch(v), v.zone(), PARAMS), x=6, density=6)


@query
def mismatch_density_truncated(v: Views) -> DataFrame:
    curve = reports.mismatch_density(mismatch(v), v.zone(), PARAMS, upper=10)
    return rounded(curve, x=6, density=6)


@query
def mismatch_table(v: Views) -> DataFrame:
    return reports.mismatch_table(mismatch(v), v.zone(), PARAMS)


@query
def mismatch_bounds(v: Views) -> DataFrame:
    return reports.ratio_bounds(reports.mismatch_table(mismatch(v), v.zone(), PARAMS))


@query
def mismatch_arcs(v: Views) -> DataFrame:
    arcs = reports.mismatch_arcs(mismatch(v), v.zone(), PARAMS)
    return rounded(arcs, actual_trips=4, estimated_trips=4, mm_ratio=4)


# -- typical-day reports ----------------------------------------------------------------------


@query
def top_origins(v: Views) -> DataFrame:
    report = reports.top_origins(od.typical_day(hourly(v)), v.zone(), PARAMS)
    return rounded(report, total_trips=4)


def top_origins_inside(v: Views, polygon: str) -> DataFrame:
    params = reports.ReportParams(PARAMS.start, PARAMS.end, polygon)
    report = reports.top_origins(od.typical_day(hourly(v)), v.zone(), params)
    return rounded(report, total_trips=4)


@query
def top_origins_triangle(v: Views) -> DataFrame:
    return top_origins_inside(v, TRIANGLE)


@query
def top_origins_holed(v: Views) -> DataFrame:
    return top_origins_inside(v, HOLED)


@query
def hourly_distribution(v: Views) -> DataFrame:
    report = reports.hourly_distribution(od.typical_day(hourly(v)), v.zone(), PARAMS)
    return rounded(report, total_trips=4)


@query
def hourly_distribution_large(v: Views) -> DataFrame:
    report = reports.hourly_distribution(od.typical_day(hourly_large(v)), v.zone(), LARGE_PARAMS)
    return rounded(report, total_trips=4)


def arcs(v: Views) -> DataFrame:
    return reports.od_arcs(od.typical_day(hourly(v)), v.zone(), PARAMS)


@query
def od_arcs(v: Views) -> DataFrame:
    return rounded(arcs(v), avg_trips=4)


@query
def flow_quantile_class(v: Views) -> DataFrame:
    classed = distribution.quantile_class(v.stored(arcs(v), "arcs"), "avg_trips")
    return rounded(classed.select("origin", "destination", "avg_trips", "class"), avg_trips=4)


RANGES = [("2024-01-05", "2024-01-12"), ("2024-01-10", "2024-01-25")]


def summarised(v: Views):
    """The fact and its summaries after two deliveries, as tables of versions."""
    fact, summaries = day_versions(v, "od-summarised"), day_versions(v, "summaries")
    refreshed(v, fact, lambda: lake.refresh_summaries(fact, summaries))
    return fact.read(), summaries.read(), summaries.beside("_pairs").read()


@query
def range_quantiles(v: Views) -> DataFrame:
    """Exact quantiles of the trips over two ranges of days that overlap, bracketed by the days' sketches."""
    fact, by_day, _ = summarised(v)
    shares, found = [0.0, 0.05, 0.5, 0.9, 1.0], []
    for start, end in RANGES:
        values = sketches.range_quantiles(fact, "fecha", "viajes", by_day, start, end, shares)
        found += [(start, end, share, value) for share, value in zip(shares, values)]
    return rounded(v.spark.createDataFrame(found, "first string, last string, share double, viajes double"), viajes=6)


@query
def range_moments(v: Views) -> DataFrame:
    """Moments of the trips of each pair over the two ranges, from the days' moments."""
    _, _, by_pair = summarised(v)
    keys = ["origen_zone_id", "destino_zone_id"]
    parts = [
        sketches.range_moments(by_pair, start, end, keys).select(F.lit(start).alias("first"), "*") for start, end in RANGES
    ]
    return rounded(parts[0].union(parts[1]), mean=6, sd=5, low=4, high=4)


@query
def points_in_zones(v: Views) -> DataFrame:
    """Places on a tenth-degree grid, many of them on borders, in all zones: squares, holed ones, pairs of squares."""
    key = F.col("p_partkey")
    places = v.table("part").select(
        "p_partkey", ((key % 1200) / 10 - 9).alias("lon"), (36 + (key % 150) / 10).alias("lat")
    )
    polygons = v.municipality_zone_raw().distinct().select(F.col("ID").alias("zone_id"), parse_wkt(F.col("geometry")).alias("geometry"))
    return spatial.points_in_polygons(places, polygons, "zone_id").select("p_partkey", "zone_id")


@query
def report_json(v: Views) -> DataFrame:
    return reports.as_json_rows(arcs(v).select("origin", "destination"))


# -- functional type --------------------------------------------------------------------------


@query
def zone_rhythm(v: Views) -> DataFrame:
    rhythm = zone_function.zone_rhythm(hourly(v))
    return rounded(rhythm, avg_out_trips=6, avg_in_trips=6)


@query
def zone_rhythm_large(v: Views) -> DataFrame:
    rhythm = zone_function.zone_rhythm(hourly_large(v))
    return rounded(rhythm, avg_out_trips=6, avg_in_trips=6)


@query
def rhythm_features(v: Views) -> DataFrame:
    features = zone_function.rhythm_features(zone_function.zone_rhythm(hourly(v)))
    picked = features.select("zone_id", "hour", "weekday", "is_weekend", "diff_out_in")
    return rounded(picked, diff_out_in=6)


@query
def rhythm_scaled(v: Views) -> DataFrame:
    """The features that the clusters are made of, in one row per zone, weekday and hour."""
    scaled = zone_function.scaled_features(zone_function.zone_rhythm(hourly(v)))
    values = {name: F.col("features")[i].alias(name) for i, name in enumerate(zone_function.FEATURES)}
    picked = scaled.select("zone_id", F.col("dow").alias("weekday"), F.col("hour").alias("clock"), *values.values())
    return rounded(picked, **{name: 6 for name in values})


@query
def zone_label(v: Views) -> DataFrame:
    """Labels from clusters by a fixed rule."""
    rhythm = v.stored(zone_function.zone_rhythm(hourly(v)), "rhythm")
    return zone_function.label_zones(rhythm.withColumn("cluster", (F.col("hour") + F.col("dow")) % 2))


@query
def zone_functional_type(v: Views) -> DataFrame:
    return zone_function.zone_function(hourly(v))


@query
def in_out_distribution(v: Views) -> DataFrame:
    report = reports.in_out_distribution(hourly(v), rule_function(v), v.zone(), PARAMS)
    return rounded(report, avg_out_trips=4, avg_in_trips=4)


@query
def zone_geojson(v: Views) -> DataFrame:
    return reports.zone_geojson(v.zone(), rule_function(v), PARAMS.polygon)


# -- incremental work -------------------------------------------------------------------------


def pending(v: Views) -> DataFrame:
    wanted = incremental.span_days(v.table("lineitem"), "l_shipdate")
    done = incremental.present_days(v.table("orders"), "o_orderdate")
    return incremental.pending_days(wanted, done)


@query
def date_spine(v: Views) -> DataFrame:
    return incremental.span_days(v.table("events"), "ts")


@query
def pending_dates(v: Views) -> DataFrame:
    return pending(v)


@query
def date_batches(v: Views) -> DataFrame:
    return incremental.day_batches(pending(v), 7)


@query
def processed_days(v: Views) -> DataFrame:
    days = v.table("lineitem").select(day_key(F.col("l_shipdate")).alias("fecha"))
    return incremental.mark_processed(v.order_days(), days).drop("processed_at")


@query
def feed_manifest(v: Views) -> DataFrame:
    return feed.od_files(v.feed_text(), "value", "municipios", v.order_days())


@query
def feed_links(v: Views) -> DataFrame:
    return feed.addresses(v.table("pages"), "html", 'href="([^"]+)"')


@query
def url_batches(v: Views) -> DataFrame:
    """Which file of a day lands where is arbitrary, so the batches are compared by count."""
    manifest = feed.od_files(v.feed_text(), "value", "municipios", v.order_days())
    return (
        feed.url_batches(manifest, 10)
        .groupBy("batch_index", "fecha")
        .agg(F.count("*").alias("n_files"))
    )


def ingested(v: Views) -> tuple[DataFrame, DataFrame]:
    """The files of the feed, and a table with the addresses of the days already ordered."""
    manifest = feed.od_files(v.feed_text(), "value", "municipios")
    table = manifest.join(v.order_days().distinct(), "fecha").select(F.col("url").alias("source_file"))
    return manifest, table


@query
def pending_files(v: Views) -> DataFrame:
    return incremental.pending_files(*ingested(v), "source_file")


@query
def ingested_files(v: Views) -> DataFrame:
    manifest, table = ingested(v)
    return joins.present_rows(manifest, table, {"url": "source_file"})


@query
def request_manifest(v: Views) -> DataFrame:
    template = "https://data.example.org/tables/%d?date=%d0101"
    return feed.requests(v.table("part"), "p_partkey", [2022, 2023], template)


@query
def coverage_gap(v: Views) -> DataFrame:
    profile = v.table("supplier").select(
        F.concat(F.lit("Z"), "s_suppkey").alias("id"), F.lit(YEAR).alias("year")
    )
    return incremental.coverage_gap(profile, v.name_map(), YEAR)


@query
def pending_files_filtered(v: Views) -> DataFrame:
    return incremental.pending_files(*ingested(v), "source_file", large=True)


def customer_years(v: Views) -> DataFrame:
    return v.table("orders").select(
        F.col("o_custkey").alias("cod"),
        F.year("o_orderdate").alias("year"),
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
    )


@query
def merge_insert_only(v: Views) -> DataFrame:
    """All orders against the customer-years that have a filled one."""
    orders = customer_years(v)
    target = orders.where("o_orderstatus = 'F'")
    return merge.insert_only(orders.drop("o_orderstatus"), target, ["cod", "year"])


@query
def merge_insert_only_filtered(v: Views) -> DataFrame:
    orders = customer_years(v)
    target = orders.where("o_orderstatus = 'F'")
    return merge.insert_only(orders.drop("o_orderstatus"), target, ["cod", "year"], large=True)


@query
def merge_upsert(v: Views) -> DataFrame:
    """Customers overwritten by what they ordered."""
    target = v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.col("c_acctbal").alias("amount")
    )
    source = v.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.lit("ordered").alias("nombre"), F.round(F.sum("o_totalprice"), 2).alias("amount")
    )
    return merge.upsert(source, target, ["id"])


@query
def upsert_buckets(v: Views) -> DataFrame:
    """The same in a table of key buckets, by two upserts: customers with few orders, then the others."""
    target = v.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.col("c_acctbal").alias("amount")
    )
    ordered = v.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.lit("ordered").alias("nombre"), F.round(F.sum("o_totalprice"), 2).alias("amount"), F.count("*").alias("n")
    )
    ordered = v.stored(ordered, "ordered")
    table = buckets.KeyBuckets.create(target, scratch_path(v.spark, "customers"), ["id"], 32)
    for some in ("n < 5", "n >= 5"):
        table.upsert(ordered.where(some).drop("n"))
    return table.read()


def event_halves(v: Views) -> tuple[DataFrame, DataFrame]:
    """Second half of the events and the first, with NULLs."""
    rows = v.table("events").select(
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.hour("ts").alias("hour"),
        (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("first_half"),
    )
    target, source = rows.where("first_half"), rows.where("not first_half")
    return source.drop("first_half"), target.drop("first_half")


@query
def merge_null_safe(v: Views) -> DataFrame:
    """Second half of the events against the first, on columns with NULLs."""
    return merge.insert_new_rows(*event_halves(v))


@query
def merge_null_safe_filtered(v: Views) -> DataFrame:
    return merge.insert_new_rows(*event_halves(v), large=True)


# -- files and tables --------------------------------------------------------------------------


def written_csv(v: Views, by_day: bool = False) -> str:
    """The raw flows as compressed pipe-separated files in the shared folder."""
    path = scratch_path(v.spark, "od-csv")
    raw = v.od_raw()
    writer = raw.withColumn("d", F.col("fecha")).repartition("d") if by_day else raw
    writer = writer.write.option("header", True).option("sep", "|").option("compression", "gzip")
    (writer.partitionBy("d") if by_day else writer).csv(path)
    return path


@query
def csv_ingest(v: Views) -> DataFrame:
    """Compressed files through the reader to the hourly fact."""
    raw = files.read_od_csv(v.spark, written_csv(v), fecha_as_timestamp=True)
    return rounded(od.od_hourly(raw, v.holiday()), viajes=4, viajes_km=4)


def written_documents(v: Views, rows: DataFrame, name: str, files: int) -> str:
    """Rows as JSON array documents, about ``files`` of them, in the shared folder."""
    path = scratch_path(v.spark, name)
    part = F.pmod(F.xxhash64(*[F.to_json(F.struct(*rows.columns))]), F.lit(files))
    documents = rows.groupBy(part.alias("file")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    documents.repartition(files, "file").write.partitionBy("file").text(path)
    return path


@query
def population_from_documents(v: Views) -> DataFrame:
    """The series as JSON documents, read back and reduced to the population table."""
    path = written_documents(v, v.population_raw().select(F.lit(None).cast("string").alias("COD"), "Nombre", "Data"), "series", 16)
    series = files.read_json_array(v.spark, path, schemas.SERIES_RAW, year=int(YEAR))
    return Z.population(series, v.name_map(), YEAR)


@query
def population_from_large_document(v: Views) -> DataFrame:
    """All series as one JSON document, read in ranges that cut through its elements."""
    path = written_documents(v, v.population_raw().select(F.lit(None).cast("string").alias("COD"), "Nombre", "Data"), "series", 1)
    series = files.read_json_array(v.spark, path, schemas.SERIES_RAW, year=int(YEAR), range_bytes=1 << 14)
    return Z.population(series, v.name_map(), YEAR)


@query
def holidays_from_documents(v: Views) -> DataFrame:
    """The calendar as a JSON document, in the flags of the daily counts."""
    path = written_documents(v, v.holiday_raw().select("startDate", "name", "nationwide"), "holidays", 1)
    return od.day_counts(od.od_hourly(v.od_raw(), files.read_holidays(v.spark, path)))


def written_pairs(v: Views, name: str, *columns) -> str:
    """Pipe-separated lines without a header, from the parts."""
    path = scratch_path(v.spark, name)
    v.table("part").select(*columns).write.option("sep", "|").csv(path)
    return path


@query
def id_value_files(v: Views) -> DataFrame:
    """Second and third of three columns, one row per cleaned id with its smallest value."""
    number = F.concat((F.col("p_partkey") % 500).cast("string"), F.when(F.col("p_partkey") % 2 == 0, ".0").otherwise(""))
    path = written_pairs(v, "pairs", F.lit("x"), number, F.col("p_size").cast("string"))
    return files.read_id_value(v.spark, path, False, "Poblacion")


@query
def zone_boundaries(v: Views) -> DataFrame:
    """Boundaries with the names and populations that two files give for some of them."""
    key = F.col("p_partkey")
    shapes = v.table("part").select(
        F.concat(key, F.when(key % 3 == 0, ".0").otherwise("")).alias("ID"), F.concat(F.lit("G"), key).alias("geometry"), F.col("p_size").alias("size")
    )
    names = files.read_id_value(v.spark, written_pairs(v, "names", key.cast("string"), F.when(key % 5 > 0, F.col("p_name"))), False, "Nombre")
    people = files.read_id_value(
        v.spark, written_pairs(v, "people", key.cast("string"), F.concat(F.col("p_size"), F.lit(".000"))), False, "Poblacion"
    )
    attributes = files.zone_attributes(names, people.where(F.col("ID").cast("long") % 7 > 0))
    return files.zone_boundaries(shapes, attributes)


@query
def ingest_summary(v: Views) -> DataFrame:
    """Rows per source file, with one file name per day as the manifest would give."""
    raw = v.od_raw().withColumn("source_file", F.col("fecha"))
    return files.ingest_summary(raw).withColumnRenamed("source_file", "fecha")


def delivered_files(v: Views) -> tuple[DataFrame, DataFrame]:
    """Rows and outcomes of a file per day, with lines that are too short, and of an empty, a broken and an absent file."""
    folder = scratch_path(v.spark, "delivered")
    raw = v.stored(v.od_raw(), "od-raw")
    short = raw.where("viajes = '7'").select("fecha", F.concat_ws("|", "fecha", "periodo", "origen").alias("value"))
    names = schemas.OD_RAW.names
    lines = raw.select("fecha", F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in names]).alias("value")).union(short)
    text = lines.groupBy("fecha").agg(F.concat_ws("\n", F.lit("|".join(names)), F.sort_array(F.collect_list("value"))).alias("value"))
    text.repartition("fecha").write.partitionBy("fecha").option("compression", "gzip").text(folder)
    v.spark.createDataFrame([("|".join(names),)], "value string").coalesce(1).write.text(f"{folder}/fecha=empty")
    v.spark.createDataFrame([("this is no gzip file",)], "value string").coalesce(1).write.text(f"{folder}/plain")
    (broken,) = [path for path, _ in files_under(v.spark, f"{folder}/plain")]
    rename(v.spark, broken, f"{folder}/fecha=broken.csv.gz")
    paths = [(path,) for path, _ in files_under(v.spark, folder)] + [(f"{folder}/fecha=missing.csv.gz",)]
    manifest = v.spark.createDataFrame(paths, "path string")
    rows, told = outcomes.load_files(v.spark, manifest, schemas.OD_RAW)
    return rows, told.withColumn("fecha", F.regexp_extract("source_file", r"fecha=(\w+)", 1))


@query
def file_outcomes(v: Views) -> DataFrame:
    """What became of each file."""
    return delivered_files(v)[1].select("fecha", "status", "n_rows", "n_rejected")


@query
def loaded_rows(v: Views) -> DataFrame:
    """The hourly fact of the files that were whole."""
    return rounded(od.od_hourly(delivered_files(v)[0], v.holiday()), viajes=4, viajes_km=4)


@query
def stream_ingest(v: Views) -> DataFrame:
    """Files picked up by the stream, then the hourly fact from the table it wrote."""
    target = scratch_path(v.spark, "od-stream")
    source = written_csv(v)
    for _ in range(2):  # the second run finds nothing new
        stream = ingest.new_files(v.spark, source, schemas.OD_RAW, header="true", sep="|")
        ingest.ingest_available(stream, target, target + "-checkpoint")
    ingested_rows = v.spark.read.parquet(target)
    return rounded(od.od_hourly(ingested_rows, v.holiday()), viajes=4, viajes_km=4)


@query
def stream_and_batch(v: Views) -> DataFrame:
    """Half of the days by the stream, half by a batch that is written twice, read together."""
    target, source = scratch_path(v.spark, "od-both"), scratch_path(v.spark, "od-half")
    early = F.col("fecha") < "20240115"
    v.od_raw().where(early).write.option("header", True).option("sep", "|").csv(source)
    stream = ingest.new_files(v.spark, source, schemas.OD_RAW, header="true", sep="|")
    ingest.ingest_available(stream, target, target + "-checkpoint")
    for _ in range(2):
        ingest.write_batch(v.od_raw().where(~early), -1, target)
    both = v.spark.read.parquet(target)
    return rounded(od.od_hourly(both, v.holiday()), viajes=4, viajes_km=4)


TARDY = "fecha <= '20240110' and cast(viajes as int) % 4 = 0"


def streamed_hours(v: Views) -> tuple[DataFrame, DataFrame]:
    """Raw files, and the hours a stream made of them: the second week comes first, some rows of the first days
    when their hours are closed, at last a row that closes the rest. Every part is a run of its own."""
    source, target = scratch_path(v.spark, "od-parts"), scratch_path(v.spark, "od-hours")
    raw = v.stored(v.od_raw(), "od-raw")
    week, tardy = F.col("fecha").between("20240108", "20240114"), F.expr(TARDY)
    early, rest = F.col("fecha") < "20240108", F.col("fecha") > "20240114"
    parts = [raw.where(week & ~tardy), raw.where(early & ~tardy), raw.where(rest), raw.where(tardy), ingest.closing_row(v.spark, "20990101"), None]
    for part in parts:  # nothing new for the last run
        if part is not None:
            part.write.mode("append").option("header", True).option("sep", "|").csv(source)
        stream = ingest.new_files(v.spark, source, schemas.OD_RAW, header="true", sep="|").drop("loaded_at", "source_file")
        ingest.hourly_available(stream, v.holiday(), target, target + "-checkpoint", "15 days")
    return v.spark.read.schema(schemas.OD_RAW).options(header=True, sep="|").csv(source), v.spark.read.parquet(target)


@query
def stream_hourly(v: Views) -> DataFrame:
    _, hours = streamed_hours(v)
    return rounded(hours.drop("batch", *incremental.PARTS), viajes=4, viajes_km=4)


@query
def stream_late_rows(v: Views) -> DataFrame:
    return od.late_rows(*streamed_hours(v))


def deliveries(v: Views) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of the flows. The second adds rows to present days and new days, corrects the values of a
    day, has nothing but external flows for another and no row of a third."""
    raw = v.stored(v.od_raw(), "od-raw")
    week = raw.where("fecha <= '20240107'")
    emptied, withdrawn = (week.withColumn("fecha", F.lit(day)) for day in ("20231231", "20231230"))
    wrong = raw.where("fecha = '20240110'").withColumn("viajes", F.lit("9"))
    early = raw.where("fecha < '20240120' and fecha != '20240110' and destino < '2'")
    first = early.union(wrong).union(emptied).union(withdrawn)
    return first, raw.union(emptied.withColumn("origen", F.lit("externo")))


def refreshed(v: Views, fact: str | days.DayVersions, above: Callable[[], object] = lambda: None) -> DataFrame:
    """The fact and what stands above it after the first delivery, then after the second; the fact's first version."""
    first, second = deliveries(v)
    lake.refresh_od(first, v.holiday(), fact, complete=True)
    above()
    before = fact.at().read() if isinstance(fact, days.DayVersions) else None
    lake.refresh_od(second, v.holiday(), fact, complete=True)
    above()
    if again := lake.refresh_od(second, v.holiday(), fact, complete=True):
        raise ValueError(f"nothing changed, yet {again} were built")
    return before


def day_versions(v: Views, name: str) -> days.DayVersions:
    return days.DayVersions(v.spark, scratch_path(v.spark, name))


@query
def refresh_days(v: Views) -> DataFrame:
    """The fact in a plain folder after late rows, a corrected, an emptied and a withdrawn day."""
    path = scratch_path(v.spark, "od-refreshed")
    refreshed(v, path)
    table = v.spark.read.parquet(path).drop(*incremental.PARTS)
    return rounded(table, viajes=4, viajes_km=4)


@query
def refresh_versions(v: Views) -> DataFrame:
    """The same in a table of versions; the newest is read."""
    fact = day_versions(v, "od-versions")
    refreshed(v, fact)
    return rounded(fact.read().drop(*incremental.PARTS), viajes=4, viajes_km=4)


@query
def version_before_refresh(v: Views) -> DataFrame:
    """The version that the first delivery made, read after the second."""
    return rounded(refreshed(v, day_versions(v, "od-before")).drop(*incremental.PARTS), viajes=4, viajes_km=4)


@query
def refresh_typical_day(v: Views) -> DataFrame:
    """Typical days above the versions of the fact: they follow its log, also where it forgets."""
    fact, typical = day_versions(v, "od-typical"), day_versions(v, "typical-versions")
    refreshed(v, fact, lambda: lake.refresh_typical_day(fact, typical))
    return rounded(typical.read().drop(*incremental.PARTS), avg_trips=4, avg_km=4)


@query
def refresh_quality(v: Views) -> DataFrame:
    """Quality scores above the versions of the fact, with their moments."""
    fact, scores = day_versions(v, "od-quality"), day_versions(v, "quality-versions")
    profile = v.stored(v.profile(), "profile")
    refreshed(v, fact, lambda: lake.refresh_quality(fact, profile, scores))
    return rounded(
        scores.read().drop(*incremental.PARTS), viajes_per_capita=15, km_per_capita=15, z_viajes_per_capita=4
    )


@query
def day_table(v: Views) -> DataFrame:
    """Daily table written twice, read back for a range of days."""
    path = scratch_path(v.spark, "od-days")
    for _ in range(2):
        tables.write_days(hourly(v), path, "fecha")
    rows = incremental.between_days(v.spark.read.parquet(path), "fecha", PARAMS.start, PARAMS.end)
    return rounded(rows.drop("year", "month", "day"), viajes=4, viajes_km=4)


@query
def random_sample(v: Views) -> DataFrame:
    keys = ["origin_id", "destination_id", "date", "hour"]
    return rounded(picks.random_rows(od.typical_day(hourly(v)), 10, keys, seed=7), avg_trips=4, avg_km=4)


@query
def row_counts(v: Views) -> DataFrame:
    return catalog.row_counts({t: v.table(t) for t in TABLES})


# -- the rest of the readers, writers and report helpers ------------------------------------------------


@query
def zone_relation_file(v: Views) -> DataFrame:
    """The code relation as a file with more columns than wanted; codes stay text."""
    names = schemas.ZONE_RELATION.names
    path = scratch_path(v.spark, "relation")
    given = v.zone_relation()
    filled = [F.col(c) if c in given.columns else F.lit("007").alias(c) for c in names]
    given.select(F.lit("x").alias("extra"), *filled).write.option("header", True).option("sep", "|").csv(path)
    return files.read_zone_relation(v.spark, path).select(*given.columns)


@query
def boundary_links(v: Views) -> DataFrame:
    """Boundary files of a feed line per part; of the attribute files the first address of each kind."""
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("zona_"), k % 50, F.lit(".shp"))).when(k % 4 == 1, F.concat(F.lit("zona_"), k % 50, F.lit(".DBF")))
    name = name.when(k % 4 == 2, "nombres_municipios.csv").otherwise("poblacion_municipios.csv")
    text = F.concat(F.lit('<a href="https://'), F.chr(97 + k % 5), F.lit(".example.org/zonificacion/zonificacion_municipios/"), name, F.lit('">'))
    return feed.boundary_files(v.table("part").select(text.alias("value")), "value", "municipios")


@query
def catalog_day_table(v: Views) -> DataFrame:
    """A catalog table made empty from a schema, then filled by column name in two loads."""
    name = f"flowlake_days_{uuid.uuid4().hex}"
    rows = hourly(v)
    for _ in range(2):  # the second call finds it
        tables.create_day_table(v.spark, name, rows.schema, "fecha")
    swapped = rows.select(*reversed(rows.columns))
    try:
        tables.insert_into(rows.where("hour(fecha) < 12"), name, "fecha")
        tables.insert_into(swapped.where("hour(fecha) >= 12"), name, "fecha")
        kept = v.stored(v.spark.table(name).drop(*incremental.PARTS), "catalog-days")
    finally:
        tables.drop_tables(v.spark, [name], dry_run=False)
    return rounded(kept, viajes=4, viajes_km=4)


@query
def row_level_load(v: Views) -> DataFrame:
    """The second half of the events on top of the first, loaded twice: rows that are there already stay out."""
    path = scratch_path(v.spark, "row-level")
    source, target = event_halves(v)
    tables.append(target, path)
    for _ in range(2):
        tables.append_new_rows(source, path)
    tables.append_new_rows(source.limit(0), path)
    return v.spark.read.schema(target.schema).parquet(path)


@query
def holiday_names(v: Views) -> DataFrame:
    """Flows on nationwide holidays, with the holiday's name."""
    counts = od.day_counts(hourly(v)).withColumn("date", F.to_date("fecha", "yyyyMMdd"))
    return joins.lookup_join(counts, v.holiday(), {"date": "date"}).select("fecha", "name", "n_rows")


@query
def od_hourly_with_residence(v: Views) -> DataFrame:
    """The hourly fact without rows whose residence is not known."""
    raw = v.od_raw().withColumn("residencia", F.nullif("residencia", F.lit("error")))
    return rounded(od.od_hourly(raw, v.holiday(), require_residence=True), viajes=4, viajes_km=4)


@query
def zones_from_map_centre(v: Views) -> DataFrame:
    """Distance of every zone from the centre of a report's map."""
    centre = map_centre(PARAMS.polygon)
    zones = v.zone().select("id", F.col("centroid.lon").alias("lon"), F.col("centroid.lat").alias("lat"))
    km = distance_km(F.col("lon"), F.col("lat"), centre["lon"], centre["lat"])
    return rounded(zones.select("id", km.alias("km")), km=6)


@query
def table_preview(v: Views) -> DataFrame:
    """First rows of the name mapping."""
    return catalog.preview(v.name_map(), ["nombre", "codigo_ine", "municipio_mitma"], 10)


@query
def hooked_report(v: Views) -> DataFrame:
    """A report after two hooks: a share of the total, and the larger ones only."""

    def with_share(report: DataFrame) -> DataFrame:
        total = report.agg(F.sum("total_trips")).first()[0]
        return report.withColumn("share", F.col("total_trips") / F.lit(total))

    report = reports.top_origins(od.typical_day(hourly(v)), v.zone(), PARAMS)
    report = report_sink.hooked(report, [with_share, lambda r: r.where("share >= 0.1")], keep=["origin"])
    return rounded(report, total_trips=4, share=6)
