"""Keyed tables in hash buckets: an upsert rewrites the buckets its keys fall into, and no other file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.operators.joins import present_rows
from flowlake.operators.merge import upsert
from flowlake.sinks.versions import PartVersions

BUCKET = "key_bucket"


class KeyBuckets(PartVersions):
    """A table of versions whose parts are buckets of keys, by hash: see :class:`PartVersions`.

    The first commit fixes the key columns and the number of buckets, which its log keeps. Choose as many as
    make a bucket a few hundred megabytes: an upsert reads and rewrites whole buckets, the changed ones
    only. The list of buckets it touches, at most their number, comes to the driver.
    """

    def part_folder(self, part: str) -> str:
        return f"{BUCKET}={part}"

    def part_name(self) -> Column:
        return F.col(BUCKET).cast("string")

    def write_parts(self, frame: DataFrame, folder: str) -> T.StructType:
        # AQE puts a small bucket in one file and splits one with a hot key over several tasks.
        frame.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        return frame.schema

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int) -> KeyBuckets:
        """Write a new table; every bucket is listed, those without rows as empty."""
        if BUCKET in rows.columns:
            raise ValueError(f"{BUCKET} is the name of the bucket column")
        table = cls(rows.sparkSession, path)
        if table.version():
            raise ValueError(f"there is a table at {path}")
        layout = ",".join([str(buckets), *keys])
        table.commit_parts(_bucketed(rows, keys, buckets), [(str(b), layout) for b in range(buckets)])
        return table

    def layout(self) -> tuple[int, list[str]]:
        """Number of buckets and key columns."""
        first = self.commits().where("part = '0'").orderBy("version").first()
        if first is None:
            raise ValueError(f"no table at {self.path}")
        buckets, *keys = first.state.split(",")
        return int(buckets), keys

    def read(self) -> DataFrame:
        return self.read_parts().drop(BUCKET)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows whose key is in ``wanted``; buckets without one are not read."""
        buckets, keys = self.layout()
        touched = _touched(_bucketed(wanted.select(*keys).distinct(), keys, buckets))
        return present_rows(self.read_parts(F.col("part").isin(touched)).drop(BUCKET), wanted, {k: k for k in keys})

    def upsert(self, source: DataFrame) -> list[str]:
        """Replace the rows of the source's keys and add new ones; returns the buckets written.

        As :func:`flowlake.operators.merge.upsert`, bucket by bucket: all source rows of a key get in, and a
        NULL key matches nothing. ``source`` is read twice, for its buckets and for its rows.
        """
        buckets, keys = self.layout()
        incoming = _bucketed(source, keys, buckets)
        touched = _touched(incoming)
        if touched:
            present = self.read_parts(F.col("part").isin(touched))
            merged = upsert(incoming.select(*present.columns), present, keys)
            state = ",".join([str(buckets), *keys])
            self.commit_parts(merged, [(part, state) for part in touched])
        return touched


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _touched(rows: DataFrame) -> list[str]:
    found = rows.select(BUCKET).distinct().collect()
    return [str(b) for b in sorted(r[0] for r in found)]
