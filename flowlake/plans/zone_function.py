"""Functional type of zones from their rhythm of departures and arrivals."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.temporal import day_of_week, weekday_name
from flowlake.operators.clusters import kmeans
from flowlake.operators.joins import lookup_join
from flowlake.operators.picks import majority
from flowlake.sinks.tables import stored

#: Steps of a standard deviation in which clusters measure, so that their sums are exact.
STEPS = 1 << 16

FEATURES = ["avg_out_trips", "avg_in_trips", "dow", "hour", "is_weekend", "diff_out_in"]
INPUTS = [f"{name}_x" for name in FEATURES]


def zone_rhythm(od: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Average departures and arrivals by (zone, weekday, hour), 0 where there are none.

    ``wanted`` (column ``id``) restricts the zones before anything is added up.

    Each flow counts at its origin and at its destination, so one pass with one shuffle gives
    what a full outer join of two aggregates would: an average skips the other side's NULL.
    """
    ends = F.explode(
        F.array(
            F.struct(
                F.col("origen_zone_id").alias("zone_id"),
                F.col("viajes").alias("out"),
                F.lit(None).cast("double").alias("in"),
            ),
            F.struct(
                F.col("destino_zone_id").alias("zone_id"),
                F.lit(None).cast("double").alias("out"),
                F.col("viajes").alias("in"),
            ),
        )
    )
    counted = od.select("fecha", ends.alias("end")).select("fecha", "end", F.col("end.zone_id").alias("zone_id"))
    if wanted is not None:
        counted = lookup_join(counted, wanted, {"zone_id": "id"}, "left_semi")
    return (
        counted
        .groupBy(
            "zone_id",
            day_of_week(F.col("fecha")).alias("dow"),
            F.hour("fecha").alias("hour"),
        )
        .agg(
            F.coalesce(F.avg("end.out"), F.lit(0.0)).alias("avg_out_trips"),
            F.coalesce(F.avg("end.in"), F.lit(0.0)).alias("avg_in_trips"),
        )
    )


def rhythm_features(rhythm: DataFrame) -> DataFrame:
    """Add weekday name, weekend flag and departures minus arrivals."""
    return (
        rhythm.withColumn("weekday", weekday_name(F.col("dow")))
        .withColumn("is_weekend", F.col("weekday").isin("saturday", "sunday").cast("int"))
        .withColumn("diff_out_in", F.col("avg_out_trips") - F.col("avg_in_trips"))
    )


def _measured(rhythm: DataFrame) -> DataFrame:
    rows = rhythm_features(rhythm)
    for name in FEATURES:
        rows = rows.withColumn(f"{name}_x", F.col(name).cast("double"))
    return rows


def _scaling() -> list:
    """Mean imputation and standard scaling into the column ``scaled``."""
    return [
        Imputer(strategy="mean", inputCols=INPUTS, outputCols=INPUTS),
        VectorAssembler(inputCols=INPUTS, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
    ]


def scaled_features(rhythm: DataFrame) -> DataFrame:
    """The rhythm with its imputed and standardised FEATURES as the array ``features``."""
    rows = _measured(stored(rhythm, "rhythm"))
    scaled = Pipeline(stages=_scaling()).fit(rows).transform(rows)
    return scaled.withColumn("features", vector_to_array("scaled")).drop("raw", "scaled", *INPUTS)


def rhythm_clusters(rhythm: DataFrame, k: int = 2, rounds: int = 20) -> DataFrame:
    """Assign a cluster to each row: mean imputation, standard scaling, k-means.

    The scaled features are counted in steps of 1/65536, and the first centres are the row farthest from the
    mean and those farthest from the ones before, so the clusters depend on the rhythm alone. It has at
    most 168 rows per zone and is written once, as each round reads it.
    """
    scaled = scaled_features(rhythm)
    steps = {name: F.round(F.col("features")[n] * STEPS).cast("long") for n, name in enumerate(INPUTS)}
    points = stored(scaled.withColumns(steps).drop("features"), "rhythm-points")
    return kmeans(points, INPUTS, ["zone_id", "dow", "hour"], k, rounds).drop(*INPUTS)


def label_zones(clustered: DataFrame) -> DataFrame:
    """Zone label from the majority cluster of its rows.

    'Residential' is the first cluster whose mean departures exceed its mean arrivals, or
    cluster 0 when none does.
    """
    means = clustered.groupBy("cluster").agg(
        F.avg("avg_out_trips").alias("out"), F.avg("avg_in_trips").alias("in")
    )
    leaving = means.where(F.col("out") > F.col("in")).agg(F.min("cluster").alias("c")).first().c
    residential = F.lit(leaving or 0)
    votes = majority(clustered, "zone_id", "cluster", "final_cluster")
    return votes.select(
        "zone_id",
        F.when(F.col("final_cluster") == residential, "Residential")
        .otherwise("Non-residential")
        .alias("functional_type"),
    )


def zone_function(od: DataFrame) -> DataFrame:
    """Residential / Non-residential by zone."""
    return label_zones(stored(rhythm_clusters(zone_rhythm(od)), "rhythm-clusters"))
