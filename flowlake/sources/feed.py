"""Discovery of files in feed text, and request manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ZONE_TYPES = ("distritos", "municipios", "gau")

# Shapes of the published file addresses, by zone type.
OD_FILE = (
    r'(?i)(https?://[^\s"<>]*/estudios_basicos/por-{zone_type}/viajes/ficheros-diarios'
    r"/\d{{4}}-\d{{2}}/\d{{8}}_Viajes_{suffix}\.csv\.gz)"
)
SHAPE_FILE = (
    r'(?i)(https?://[^\s"<>]*/zonificacion/zonificacion_{suffix}/[^"<>]+\.(?:shp|shx|dbf|prj))'
)
ATTRIBUTE_FILE = (
    r'(?i)(https?://[^\s"<>]*/zonificacion/zonificacion_{suffix}'
    r"/(?:nombres|poblacion)_{plural}\.csv)"
)

# Table numbers of the published income series.
INCOME_TABLE_IDS = [
    30656, 30833, 30842, 30851, 30860, 30869, 30878, 30887, 30896, 30917, 30926, 30935, 30944,
    30953, 30962, 30971, 30980, 30989, 30998, 31007, 31016, 31025, 31034, 31043, 31052, 31061,
    31070, 31079, 31088, 31097, 31106, 31115, 31124, 31133, 31142, 31151, 31160, 31169, 31178,
    31187, 31196, 31205, 31214, 31223, 31232, 31241, 31250, 31259, 31268, 31277, 31286, 31295,
]


def _pattern(template: str, zone_type: str) -> str:
    if zone_type not in ZONE_TYPES:
        raise ValueError(f"zone type must be one of {ZONE_TYPES}, not {zone_type}")
    gau = zone_type == "gau"
    return template.format(
        zone_type=zone_type,
        suffix="GAU" if gau else zone_type,
        plural="gaus" if gau else zone_type,
    )


def addresses(text: DataFrame, column: str, pattern: str) -> DataFrame:
    """Distinct first-group matches of a pattern."""
    found = F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(1))
    return text.select(F.explode(found).alias("url")).distinct()


def od_files(
    text: DataFrame, column: str, zone_type: str, days: DataFrame | None = None
) -> DataFrame:
    """Distinct daily OD files (``url``, ``fecha``) named in the text, for the wanted days.

    Lines that name no such file are dropped by a plain search, addresses are cut out by a simple
    pattern and made distinct, and only distinct ones meet the full pattern.
    """
    named = text.where(F.lower(column).contains(".csv.gz"))
    candidates = addresses(named, column, r'(?i)(https?://[^\s"<>]+\.csv\.gz)')
    found = addresses(candidates, "url", _pattern(OD_FILE, zone_type)).select(
        "url", F.regexp_extract("url", r"/(\d{8})_[^/]*$", 1).alias("fecha")
    )
    if days is None:
        return found
    wanted = days.select(F.replace(F.col("fecha"), F.lit("-"), F.lit("")).alias("fecha"))
    return found.join(wanted.distinct(), "fecha", "left_semi").select("url", "fecha")


def boundary_files(text: DataFrame, column: str, zone_type: str) -> DataFrame:
    """Distinct boundary files (``url``, ``kind``) named in the text.

    ``kind`` is ``shape`` for every component; of the attribute files only the first address, in
    text order, that mentions names or population is kept.
    """
    shapes = addresses(text, column, _pattern(SHAPE_FILE, zone_type)).select(
        "url", F.lit("shape").alias("kind")
    )
    tables = addresses(text, column, _pattern(ATTRIBUTE_FILE, zone_type))
    first = tables.agg(
        *[
            F.min(F.when(F.lower("url").contains(word), F.col("url"))).alias(word)
            for word in ("nombres", "poblacion")
        ]
    )
    picked = first.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.col(word).alias("url"), F.lit(word).alias("kind"))
                    for word in ("nombres", "poblacion")
                ]
            )
        ).alias("f")
    ).select("f.url", "f.kind")
    return shapes.unionByName(picked.where(F.col("url").isNotNull()))


def requests(tables: DataFrame, id_column: str, years: list[int], template: str) -> DataFrame:
    """One request per table id and year; the template takes the id, then the year."""
    expanded = tables.select(
        F.col(id_column).cast("long").alias("table_id"),
        F.explode(F.lit(years)).alias("year"),
    )
    url: Column = F.format_string(template, "table_id", "year")
    return expanded.withColumn("url", url)


def url_batches(files: DataFrame, size: int, slot_rows: int = 10_000) -> DataFrame:
    """Number a manifest (``url``, ``fecha``) in day order and cut it into batches of ``size``.

    A position is the files of earlier days, plus those of earlier hash slots of the day, plus
    the row number in the slot. Slots hold about ``slot_rows`` files, so a day with most of the
    files is numbered by many tasks. Running sums go over one row per slot, and one per calendar
    day. The joins are left to Spark, which reads the manifest once and reuses its exchange.
    """
    per_day = files.groupBy("fecha").agg(F.count("*").alias("in_day"))
    day_order = W.orderBy("fecha").rowsBetween(W.unboundedPreceding, -1)
    day_start = per_day.select(
        "fecha",
        F.ceil(F.col("in_day") / slot_rows).cast("long").alias("slots"),
        F.coalesce(F.sum("in_day").over(day_order), F.lit(0)).alias("day_start"),
    )
    slot = F.pmod(F.xxhash64("url"), F.col("slots"))
    placed = files.join(day_start, "fecha").withColumn("slot", slot)
    slot_order = W.partitionBy("fecha").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slot_start = (
        placed.groupBy("fecha", "slot")
        .agg(F.count("*").alias("n"))
        .select(
            "fecha", "slot", F.coalesce(F.sum("n").over(slot_order), F.lit(0)).alias("slot_start")
        )
    )
    in_slot = F.row_number().over(W.partitionBy("fecha", "slot").orderBy("url"))
    numbered = placed.withColumn("in_slot", in_slot).join(slot_start, ["fecha", "slot"])
    position = F.col("day_start") + F.col("slot_start") + F.col("in_slot") - 1
    return numbered.select("url", "fecha", F.floor(position / size).alias("batch_index"))
