"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.temporal import date_parts, day_text_parts
from flowlake.operators.incremental import PARTS, as_day
from flowlake.operators.merge import insert_new_rows
from flowlake.session import scratch_path


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_new_rows(source: DataFrame, path: str) -> bool:
    """Row-level de-duplicating load: append what the table at ``path`` does not hold yet.

    The source is staged as files in the shared folder, as it may be as large as the table. An empty
    one ends the load early; the result says whether there was anything to merge.
    """
    staged = stored(source, "staged")
    if staged.isEmpty():
        return False
    append(insert_new_rows(staged, source.sparkSession.read.parquet(path)), path)
    return True


def replace(df: DataFrame, path: str) -> None:
    """Create or replace. The path must not be one the frame reads from."""
    df.write.mode("overwrite").parquet(path)


def write_days(df: DataFrame, path: str, column: str) -> None:
    """Write partitioned by year, month and day, replacing exactly the days in the frame.

    Running it again for the same days leaves the same rows. The rebalance hint lets AQE put
    a small day in one file and split a hot day over several tasks.
    """
    parted = df.select("*", *date_parts(as_day(df, column)))
    (
        parted.hint("rebalance", *PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTS)
        .parquet(path)
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that is read more than once to the shared folder, and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def append_days(df: DataFrame, path: str, column: str) -> None:
    """Plain partitioned append, for text days or timestamps."""
    text = dict(df.dtypes)[column] == "string"
    parts = day_text_parts(F.col(column)) if text else date_parts(F.col(column))
    (
        df.select("*", *parts)
        .hint("rebalance", *PARTS)
        .write.mode("append")
        .partitionBy(*PARTS)
        .parquet(path)
    )


def create_day_table(spark: SparkSession, name: str, schema, column: str) -> None:
    """Create an empty catalog table partitioned by the parts of a day column, if absent."""
    if spark.catalog.tableExists(name):
        return
    empty = spark.createDataFrame([], schema)
    empty.select("*", *date_parts(as_day(empty, column))).write.partitionBy(*PARTS).saveAsTable(name)


def insert_into(df: DataFrame, name: str, column: str) -> None:
    """Append to a catalog table made by :func:`create_day_table`, by column name."""
    columns = df.sparkSession.table(name).columns
    parted = df.select("*", *date_parts(as_day(df, column)))
    parted.select(*columns).write.mode("append").insertInto(name)


def drop_tables(spark: SparkSession, names: list[str], dry_run: bool = True) -> DataFrame:
    """Drop catalog tables; by default only say which ones exist and would go."""
    outcome = []
    for name in names:
        exists = spark.catalog.tableExists(name)
        if exists and not dry_run:
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
        outcome.append((name, exists, exists and not dry_run))
    return spark.createDataFrame(outcome, "table_name string, existed boolean, dropped boolean")
