"""Centroid clustering with a table of distances to fixed pivots (LAESA).

Each vector's distances to a few fixed pivots are computed once and stored beside it. In every round the
centroids' distances to the same pivots are known, and by the triangle inequality the largest difference
to a vector's own is a lower bound of their distance. The centroid with the least bound is measured first;
those whose bound reaches beyond that distance are out, the survivors get exact integer distances.

Vectors stay where they were written: a round reads the table, adds up per task and sends one row per
task, centroid and component. Only the centroids, ``count`` times ``size`` integers, reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.components import stored

PIVOTS = 12
#: Vectors among which pivots are chosen; pivots decide how much is pruned, never a result.
PIVOT_SAMPLE = 256
#: Components beyond this would not let squared distances fit 64 bits; such vectors are left out.
LARGEST = 1 << 24
#: Numbers compared at once by a task.
CHUNK = 1 << 21
SLACK = 2.0**-40


def _numbers(column, size: int) -> np.ndarray:
    """Rows of integers from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def squared(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    apart = vectors - others
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Points far from the ones chosen before, by the sum of distances."""
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(count, len(sample)):
        total += np.sqrt(squared(sample, sample[chosen[-1]]).astype(float))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return sample[chosen]


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """(number of the nearest centroid, squared distance, distances measured) of every vector.

    Ties go to the smaller number. ``table`` holds the vectors' distances to the pivots.
    """
    count, own = len(vectors), np.stack([np.sqrt(squared(centroids, p).astype(float)) for p in pivots], 1)
    bound = np.zeros((count, len(centroids)))
    for p in range(len(pivots)):
        near, far = table[:, p : p + 1], own[None, :, p]
        np.maximum(bound, np.abs(near - far) - SLACK * (near + far), out=bound)
    first = bound.argmin(1)
    best, number = squared(vectors, centroids[first]), first.copy()
    measured = count
    bound = bound * bound * (1 - SLACK)
    for c in range(len(centroids)):
        alive = np.flatnonzero((bound[:, c] <= best) & (first != c))
        measured += len(alive)
        exact = squared(vectors[alive], centroids[c])
        better = (exact < best[alive]) | ((exact == best[alive]) & (c < number[alive]))
        best[alive[better]], number[alive[better]] = exact[better], c
    return number, best, measured


def _chunks(batches, size: int, pivots: int):
    step = max(1, CHUNK // size)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            table = np.frombuffer(b"".join(part.column(part.schema.get_field_index("pivots")).to_pylist()), "<f8")
            yield part, _numbers(part.column(part.schema.get_field_index("vector")), size), table.reshape(-1, pivots)


def pivot_clusters(
    vectors: DataFrame, start: Column, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64,
    scale: float = 1024.0, count: int = 8, rounds: int = 10, pivots: int = PIVOTS,
) -> DataFrame:
    """Clusters of the vectors of ``size`` components, as integers floor(scale * component).

    Centroids start as the ``count`` vectors with the smallest ``start``, a text expression over the
    columns of ``vectors``; rows where it is null never start one. A round assigns every vector to the
    nearest centroid and moves each non-empty centroid to the floor of its vectors' mean, in exact
    integers; an empty one stays. Returns id_col, cluster, distance (squared, to the final centroid),
    cluster_inertia, inertia (null where a sum leaves 64 bits) and centroid_sha256, one row per vector.

    Left out are vectors that are null, have another length, hold a null or non-finite component, or one
    that exceeds 2**24 after scaling. A table without other vectors gives no rows, one with fewer than
    ``count`` has a centroid for each. Rows repeated count as often as they stand; of equal starts the
    smaller vector leads. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    e = F.col(vector_col)
    scaled = F.transform(e, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fits = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < F.lit(float(LARGEST))))
    kept = (
        vectors.select(F.col(id_col).alias("id"), start.cast("string").alias("rank"), F.when((F.size(e) == size) & fits, scaled).alias("q"))
        .where("q is not null")
        .select("id", "rank", F.col("q").cast("array<int>").alias("q"))
    )
    kept = stored(kept, "pivot-vectors")
    first = kept.where("rank is not null").orderBy("rank", "q", "id").limit(max(count, PIVOT_SAMPLE)).select("q").collect()
    sample = np.array([r.q for r in first], np.int64).reshape(len(first), size)
    centroids = sample[:count]
    if not len(sample):
        return spark.createDataFrame([], f"{id_col} {dict(vectors.dtypes)[id_col]}, {RESULT}")
    fixed = choose_pivots(sample, pivots)

    def measure(batches):
        for batch in batches:
            step = max(1, CHUNK // size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                column = part.column(1)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, size)
                table = np.stack([np.sqrt(squared(flat.astype(np.int64), p).astype(float)) for p in fixed], 1).astype("<f8")
                rows = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), rows(flat), rows(table)], ["id", "vector", "pivots"])

    kind = dict(kept.dtypes)["id"]
    table = stored(kept.select("id", "q").mapInArrow(measure, f"id {kind}, vector binary, pivots binary"), "pivot-table")
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed, size)

    def assign(batches):
        for part, own, known in _chunks(batches, size, len(fixed)):
            number, best, _ = nearest(own, known, centroids, fixed)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(number.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"]
            )

    done = stored(table.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "pivot-clusters")
    sums = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()  # one row a centroid
    total = sum(int(r.s) for r in sums)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame(
        [(r.cluster, _long(int(r.s)), _long(total), names[r.cluster]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    joined = done.join(F.broadcast(known), "cluster")  # at most ``count`` rows
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """The centroids after one round: floors of exact means, added up by Spark."""

    def sums(batches):
        totals, members = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for _, own, known in _chunks(batches, size, len(pivots)):
            number, _, _ = nearest(own, known, centroids, pivots)
            order = np.argsort(number, kind="stable")
            found, starts = np.unique(number[order], return_index=True)
            totals[found] += np.add.reduceat(own[order], starts, axis=0)
            members += np.bincount(number, minlength=len(centroids))
        some = np.flatnonzero(members)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(some, size), pa.int32()),
            "place": pa.array(np.tile(np.arange(size), len(some)), pa.int32()),
            "total": pa.array(totals[some].ravel()),
            "members": pa.array(np.repeat(members[some], size)),
        })

    parts = table.mapInArrow(sums, "cluster int, place int, total long, members long")
    added = parts.groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(19,0)")).alias("total"), F.sum("members").alias("members")
    )
    moved = centroids.copy()
    for r in added.collect():  # ``count`` times ``size`` rows
        moved[r.cluster, r.place] = int(r.total) // r.members
    return moved
