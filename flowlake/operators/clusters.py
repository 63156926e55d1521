"""Clusters of integer points whose result depends on the points alone, not on how they are dealt out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _squared(columns: list[str], centre: list[int]) -> Column:
    terms = [(F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(columns, centre)]
    return reduce(lambda a, b: a + b, terms)


def _centres(centres: list[list[int]], columns: list[str]) -> Column:
    """(distance, number) of the nearest centre; of equally near ones the smaller number."""
    told = [F.struct(_squared(columns, c).alias("distance"), F.lit(n).alias("cluster")) for n, c in enumerate(centres)]
    return F.array_min(F.array(*told))


def farthest_points(points: DataFrame, columns: list[str], order: list[str], k: int) -> list[list[int]]:
    """``k`` points far apart: the farthest from the origin, then always the farthest from those chosen.

    Of equally far ones the first by ``order`` is taken. Fewer distinct points give fewer.
    """
    centres: list[list[int]] = []
    while len(centres) < k:
        distance = _centres(centres, columns)["distance"] if centres else _squared(columns, [0] * len(columns))
        far = points.select(*columns, *order, distance.alias("__far")).orderBy(F.desc("__far"), *order).limit(1).first()
        if far is None or (centres and far["__far"] == 0):
            break
        centres.append([far[c] for c in columns])
    return centres


def kmeans(points: DataFrame, columns: list[str], order: list[str], k: int, rounds: int = 20) -> DataFrame:
    """Add ``cluster``: k-means over bigint columns from :func:`farthest_points`, in exact integers.

    A round is one aggregate of ``k`` rows: every point goes to the nearest centre (of equals the smaller
    number), every centre that has points to the floor of their mean; one without stays. Rounds end when no centre
    moves, at the latest after ``rounds``. Sums are exact, so neither partitions nor order change a result.
    The points are read once a round, so store them before; values below 2**27 keep all products in 64 bits.
    """
    centres = farthest_points(points, columns, order, k)
    if not centres:
        return points.withColumn("cluster", F.lit(0))
    for _ in range(rounds):
        at = points.select(*columns, _centres(centres, columns)["cluster"].alias("cluster"))
        sums = at.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in columns])
        moved = list(centres)
        for r in sums.collect():  # one row a centre
            moved[r.cluster] = [int(r[c]) // r.n for c in columns]
        if moved == centres:
            break
        centres = moved
    return points.withColumn("cluster", _centres(centres, columns)["cluster"])
