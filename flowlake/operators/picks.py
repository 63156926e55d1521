"""One row per group, as aggregates that combine before the shuffle instead of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in the stated ascending order.

    ``order`` has to be total up to equal rows; a NULL sorts first.
    """
    payload = [c for c in df.columns if c not in keys]
    ranked = F.min(
        F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), *payload)
    )
    return (
        df.groupBy(*keys)
        .agg(ranked.alias("__row"))
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def majority(df: DataFrame, key: str, vote: str, out: str) -> DataFrame:
    """The most frequent vote per key; the smaller one wins a tie."""
    counts = df.groupBy(key, vote).agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col(vote)).alias("v")))
    return counts.groupBy(key).agg((-best["v"]).alias(out))


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def random_rows(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """Exactly n rows (or all, if fewer): those of the smallest hash of the seed and the key columns.

    The same rows come out however the frame is partitioned; each task keeps its own n.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.orderBy(F.md5(key.cast("binary")), *keys).limit(n)
