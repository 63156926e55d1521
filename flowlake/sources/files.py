"""Delimited-text and JSON inputs. Nothing is inferred from data; every text column is a string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake import schemas
from flowlake.functions.temporal import parse_day
from flowlake.functions.text import clean_id, clean_population
from flowlake.operators.joins import lookup_join
from flowlake.operators.picks import first_per_key
from flowlake.sources.json_arrays import read_large_json_array


def plain_path(uri: Column) -> Column:
    """A file URI without the local scheme, as a user writes the path."""
    return F.regexp_replace(uri, "^file:/+", "/")


def header_schema(spark: SparkSession, path: str, sep: str = "|") -> T.StructType:
    """Column names of one file's header, all as strings."""
    return spark.read.csv(path, header=True, sep=sep, inferSchema=False).schema


def with_provenance(
    rows: DataFrame, manifest: DataFrame | None = None, name: str = "source_file"
) -> DataFrame:
    """Add ``loaded_at`` and the origin of each row.

    ``manifest`` maps a staged ``path`` to its ``original_url``; a file that is not in it keeps
    its path.
    """
    path = plain_path(F.col("_metadata.file_path"))
    rows = rows.select("*", F.current_timestamp().alias("loaded_at"), path.alias(name))
    if manifest is None:
        return rows
    urls = manifest.select(plain_path(F.col("path")).alias("path"), "original_url")
    joined = lookup_join(rows, urls.dropDuplicates(["path"]), {name: "path"}, "left")
    return joined.withColumn(name, F.coalesce("original_url", name)).drop("original_url")


def read_od_csv(
    spark: SparkSession,
    paths: str | list[str],
    manifest: DataFrame | None = None,
    sep: str = "|",
    fecha_as_timestamp: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Daily OD matrices: any number of (compressed) files in one scan.

    Columns beyond the contract are kept. Names come from the header of the first file, and each
    further file is checked against them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = schema or header_schema(spark, paths[0], sep)
    rows = (
        spark.read.schema(schema).option("enforceSchema", False).csv(paths, header=True, sep=sep)
    )
    rows = with_provenance(rows, manifest)
    return rows.withColumn("fecha", parse_day(F.col("fecha"))) if fecha_as_timestamp else rows


def ingest_summary(table: DataFrame) -> DataFrame:
    """Rows per ingested file; reads the provenance column only."""
    return table.groupBy("source_file").agg(F.count("*").alias("n_rows"))


def read_zone_relation(spark: SparkSession, path: str) -> DataFrame:
    """Census-to-zone code relation. Codes stay text, so leading zeros survive."""
    names = schemas.ZONE_RELATION.names
    rows = spark.read.csv(path, header=True, sep="|", inferSchema=False)
    return with_provenance(rows).select(*names, "loaded_at", "source_file")


def read_id_value(spark: SparkSession, path: str, header: bool, value: str) -> DataFrame:
    """Two columns by position: the 2nd and 3rd of a wider file, else the 1st and 2nd.

    One row per cleaned id; of several the one with the smallest value stays.
    """
    rows = spark.read.csv(path, header=header, sep="|", inferSchema=False)
    offset = 1 if len(rows.columns) >= 3 else 0
    pair = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).select(
        clean_id(F.col(f"c{offset}")).alias("ID"), F.col(f"c{offset + 1}").alias(value)
    )
    return first_per_key(pair, ["ID"], [F.col(value)])


def zone_attributes(names: DataFrame, populations: DataFrame) -> DataFrame:
    """Full outer merge of (ID, Nombre) and (ID, Poblacion)."""
    cleaned = populations.select("ID", clean_population(F.col("Poblacion")).alias("Poblacion"))
    return names.join(cleaned, "ID", "full_outer")


def zone_boundaries(geometries: DataFrame, attributes: DataFrame) -> DataFrame:
    """Zone source table from (ID, geometry WKT) and the attributes.

    A missing name falls back to the id, a missing population to 0; every column is text.
    """
    cleaned = geometries.withColumn("ID", clean_id(F.col("ID")))
    joined = lookup_join(cleaned, attributes, {"ID": "ID"}, "left")
    rest = [c for c in geometries.columns if c not in ("ID", "geometry")]
    return joined.select(
        "ID",
        F.coalesce("Nombre", "ID").alias("Nombre"),
        F.coalesce("Poblacion", F.lit(0)).cast("string").alias("Poblacion"),
        "geometry",
        *[F.col(c).cast("string").alias(c) for c in rest],
    )


def read_json_array(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    source_url: str | None = None,
    year: int | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """JSON array documents, one row per element, with ``loaded_at``, ``source_url`` (and year).

    By default one file is one task, which suits many files. With ``range_bytes`` a document of any size is
    read by as many tasks as it has ranges: see :mod:`flowlake.sources.json_arrays`.
    """
    if range_bytes is None:
        rows = with_provenance(spark.read.schema(schema).json(path, multiLine=True), name="source_url")
    else:
        elements = read_large_json_array(spark, path, schema, range_bytes)
        rows = elements.select(*schema.names, F.current_timestamp().alias("loaded_at"), plain_path(F.col("path")).alias("source_url"))
    if source_url is not None:
        rows = rows.withColumn("source_url", F.lit(source_url))
    return rows if year is None else rows.withColumn("year", F.lit(year))


def holidays(raw: DataFrame) -> DataFrame:
    """Nationwide holidays as (date, name), one row per date so that joins never fan out."""
    rows = raw.where("nationwide").select(
        F.to_date("startDate").alias("date"), F.get("name", F.lit(0))["text"].alias("name")
    )
    return rows.groupBy("date").agg(F.min("name").alias("name"))


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return holidays(spark.read.schema(schemas.HOLIDAY_RAW).json(path, multiLine=True))
