"""Connected components by contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest reachable id.

    Each round sends every id to its first neighbour in an order (ids at first, then seeded hashes,
    which shrinks chains too) and keeps the links between different targets, each once. Links with a
    null end or between an id and itself connect nothing; without links the result is empty.
    """
    links = stored(links.where("a is not null and b is not null and a != b").select("a", "b").distinct(), "links")
    labels = stored(links.select("a").union(links.select("b")).distinct().select(F.col("a").alias("id"), F.col("a").alias("at")), "labels")
    turn = 0
    while not links.isEmpty():
        rank = (lambda c: F.col(c)) if turn == 0 else (lambda c, t=turn: F.xxhash64(F.lit(t), c))
        both = links.union(links.select("b", "a"))
        target = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b"))).alias("m"))
        target = stored(
            target.select(F.col("a").alias("at"), F.when(F.col("m.r") < rank("a"), F.col("m.b")).otherwise(F.col("a")).alias("to")),
            "targets",
        )
        labels = stored(
            labels.join(target, "at", "left").select("id", F.coalesce("to", "at").alias("at")), "labels"
        )
        ends = links.join(target.select(F.col("at").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(target.select(F.col("at").alias("b"), F.col("to").alias("y")), "b")
        links = stored(
            ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links"
        )
        turn += 1
    smallest = labels.groupBy("at").agg(F.min("id").alias("component"))
    return labels.join(smallest, "at").select("id", "component")
