"""Tables of immutable files whose parts, days or buckets of keys, are switched by one small commit file."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.sinks.folders import names, remove
from flowlake.sinks.tables import append

COMMITS = "version long, part string, state string, folder string, schema string, committed_at timestamp"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class PartVersions:
    """A table whose commits never touch a file that a reader may read.

    A commit writes its parts into a folder of its own, then one small file into ``_commits`` that names, for
    every part it touched, the folder, or none for a part without rows. That file, which appears at once, is both data
    switch and log: a reader sees the commit whole or not at all, and a run that breaks off before it leaves
    an unnamed folder, no change. Older versions stay readable until :meth:`vacuum`. One writer at a
    time; of two that race, each part is the later file's.

    Subclasses say what a part is: its folder, how rows name it, and how a frame is written.
    """

    def __init__(self, spark: SparkSession, path: str, pinned: int | None = None):
        self.spark, self.path, self.pinned = spark, path.rstrip("/"), pinned

    def part_folder(self, part: str) -> str:
        """Folder of a part inside a commit's."""
        raise NotImplementedError

    def part_name(self) -> Column:
        """The part of a row, from the partition columns."""
        raise NotImplementedError

    def write_parts(self, frame: DataFrame, folder: str) -> T.StructType:
        """Write a frame by parts into a new folder; its schema with the partition columns."""
        raise NotImplementedError

    def commits(self) -> DataFrame:
        """Rows of all commits up to the pinned one; empty before the first."""
        found = read_table(self.spark, f"{self.path}/_commits")
        if found is None:
            return self.spark.createDataFrame([], COMMITS)
        return found if self.pinned is None else found.where(F.col("version") <= self.pinned)

    def version(self) -> int:
        """Number of the newest commit, 0 before the first."""
        return self.commits().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def at(self, version: int | None = None):
        """The table as one commit left it, by default the newest: later ones do not show."""
        return type(self)(self.spark, self.path, self.version() if version is None else version)

    def parts(self) -> DataFrame:
        """(part, state, folder) of every part committed so far."""
        newest = F.max_by(F.struct("state", "folder"), F.struct("version", "committed_at")).alias("d")
        return self.commits().groupBy("part").agg(newest).select("part", "d.state", "d.folder")

    def read_parts(self, wanted: Column | None = None) -> DataFrame | None:
        """Rows of all parts or of some, by a condition on ``part``; only their files are listed.

        None before the first commit; without files the table has its columns and no rows.
        """
        schema = self.commits().where("schema is not null").agg(F.max_by("schema", "version").alias("s")).first().s
        if schema is None:
            return None
        live = self.parts().where("folder is not null")
        live = (live if wanted is None else live.where(wanted)).select("part", "folder").collect()
        kind, root = T.StructType.fromJson(json.loads(schema)), f"{self.path}/data"
        paths = sorted(f"{root}/commit={p.folder}/{self.part_folder(p.part)}" for p in live)
        if not paths:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).option("basePath", root).parquet(*paths).drop("commit")

    def publish(self, folder: str | None, schema: T.StructType | None, rows: list[tuple[str, str | None]]) -> None:
        """Write the commit file; from then on readers see the listed parts as ``folder`` has them."""
        filled = set()
        if folder is not None:
            staged = self.spark.read.schema(schema).parquet(f"{self.path}/data/commit={folder}")
            filled = {r.part for r in staged.select(self.part_name().alias("part")).distinct().collect()}
        if strange := filled - {part for part, _ in rows}:
            raise ValueError(f"rows of parts that the commit does not list: {sorted(strange)}")
        text, number = schema and schema.json(), self.version() + 1
        named = [(number, part, state, folder if part in filled else None, text, None) for part, state in rows]
        commit = self.spark.createDataFrame(named, COMMITS).withColumn("committed_at", F.current_timestamp())
        append(commit.coalesce(1), f"{self.path}/_commits")

    def commit_parts(self, frame: DataFrame | None, rows: list[tuple[str, str | None]]) -> None:
        """Make the listed parts, (part, state), hold exactly what ``frame`` has for them, in one step for readers."""
        if frame is None:
            self.publish(None, None, rows)
            return
        folder = uuid.uuid4().hex
        schema = self.write_parts(frame, f"{self.path}/data/commit={folder}")
        self.publish(folder, schema, rows)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the folders of parts that none of the ``keep`` newest versions reads; returns them.

        Also removes what commits left that broke off, so none may run meanwhile. Versions before the kept
        ones can not be read afterwards.
        """
        newest = self.version()
        needed = set()
        for number in range(max(1, newest - keep + 1), newest + 1):
            rows = self.at(number).parts().where("folder is not null").select("part", "folder").collect()
            needed |= {f"commit={r.folder}/{self.part_folder(r.part)}" for r in rows}
        used = {n.split("/")[0] for n in needed}
        held = self.commits().where("folder is not null").select("part", "folder").distinct().collect()
        there = names(self.spark, f"{self.path}/data")
        gone = {commit for commit in there if commit not in used}
        gone |= {
            d for r in held if (c := f"commit={r.folder}") in there & used and (d := f"{c}/{self.part_folder(r.part)}") not in needed
        }
        for folder in gone:
            remove(self.spark, f"{self.path}/data/{folder}")
        return sorted(gone)
