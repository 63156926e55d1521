"""Catalog listings, storage inventory and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.sources.files import plain_path


def list_tables(
    spark: SparkSession, like: str, dataset: str = "all", zone_type: str = "all"
) -> DataFrame:
    """Catalog tables whose name is like a pattern, holds a dataset and ends in a zone type."""
    names = [(t.name,) for t in spark.catalog.listTables()]
    tables = spark.createDataFrame(names, "table_name string").where(F.col("table_name").like(like))
    if dataset != "all":
        tables = tables.where(F.col("table_name").contains(f"_{dataset}"))
    if zone_type != "all":
        tables = tables.where(F.col("table_name").endswith(f"_{zone_type}"))
    return tables.orderBy("table_name")


def storage_files(spark: SparkSession, base: str, depth: int = 0) -> DataFrame:
    """Files under a folder: path, bytes, time, and the table they belong to.

    The table is the path part ``depth`` levels below the base. Only metadata is read, as the
    content column is not selected.
    """
    root = base.rstrip("/")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(plain_path(F.col("path")).alias("path"), "length", "modificationTime")
    )
    relative = F.replace(F.col("path"), F.lit(root + "/"), F.lit(""))
    table = F.split_part(relative, F.lit("/"), F.lit(depth + 1))
    return listed.select(
        F.regexp_replace(table, r"\.[A-Za-z0-9.]+$", "").alias("table_name"),
        "path",
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"),
        F.col("modificationTime").alias("last_modified"),
    )


def storage_summary(files: DataFrame) -> DataFrame:
    """File count and megabytes per table."""
    return files.groupBy("table_name").agg(
        F.count("*").alias("n_files"),
        F.round(F.sum("size_bytes") / (1024 * 1024), 2).alias("size_mb"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def preview(table: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by ``order``, the same ones at every call; ``n = 0`` shows the columns only."""
    return table.orderBy(*order).limit(n)


def is_loaded(spark: SparkSession, name: str) -> bool:
    """Whether a table exists and has a row, in which case a one-off load is skipped."""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()
