"""Texts dealt once into blocks of bounded bytes, so that later passes need not move them again.

A block's distinct hashes travel packed: one row per block and hash bucket. A bucket answers with one
bit or number per hash, so what a block learns about the whole corpus is small, and a value that all
texts share reaches its bucket once per block, not once per text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.session import scratch_path

BLOCK_BYTES = 4 << 20
#: Hashes a bucket holds on average; a task sorts one bucket at a time.
BUCKET_HASHES = 1 << 19
MAX_TABLE_BUCKETS = 20_000


def text_blocks(docs: DataFrame, text: str, key: list[str], block_bytes: int = BLOCK_BYTES):
    """Write ``docs`` as a table bucketed by a new ``block`` column; (table, blocks, bytes of text).

    The table lies in the shared folder, like all intermediates, and leaves the catalog at once: the frame
    keeps its files and buckets. Joins and groupings by ``block`` read it without a shuffle. A text longer
    than a block makes its block longer.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(24, -(-size // block_bytes))
    buckets = min(blocks, MAX_TABLE_BUCKETS)
    name = f"flowlake_blocks_{uuid.uuid4().hex}"
    (
        docs.withColumn("block", F.pmod(F.xxhash64(*key, text), F.lit(blocks)).cast("int"))
        .repartition(buckets, "block")
        .write.bucketBy(buckets, "block")
        .option("compression", "zstd")
        .saveAsTable(name, format="parquet", path=scratch_path(spark, "llm-blocks"))
    )
    table = spark.table(name)
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    return table, blocks, size


def bucket_count(hashes: int) -> int:
    return int(max(96, -(-hashes // BUCKET_HASHES)))
