"""Large JSON array documents, read by many tasks.

Whether a byte lies in a string, and how deep, depends on all bytes before it. So documents are read
twice in ranges: first each range says what it changes, for both cases of its start; running sums over a
document's ranges, one row each, then tell every range how it starts. The second time each range cuts
out the elements that begin in it, reading on to the end of its last one, and Spark parses them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.sinks.folders import files_under

RANGE_BYTES = 8 << 20
READ_ON = 1 << 20
RANGES = "path string, at long, size long, file_size long"
CHANGES = f"{RANGES}, quotes long, outside long, inside long"
SPACE, QUOTE, BACKSLASH, COMMA = b" \t\r\n\xef\xbb\xbf", 0x22, 0x5C, 0x2C
#: What brackets do to the depth.
STEP = np.zeros(256, np.int8)
STEP[[0x5B, 0x7B]], STEP[[0x5D, 0x7D]] = 1, -1


def _open(path: str):
    system, plain = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return system.open_input_file(plain)


def _read(file, at: int, size: int) -> np.ndarray:
    return np.frombuffer(file.read_at(size, at), np.uint8)


def _escapes_before(file, at: int) -> int:
    """Backslashes that stand directly before a place."""
    reach = 64
    while at:
        seen = bytes(_read(file, max(0, at - reach), min(reach, at)))
        run = len(seen) - len(seen.rstrip(b"\\"))
        if run < len(seen) or len(seen) == at:
            return run
        reach *= 4
    return 0


def _quotes(data: np.ndarray, before: int) -> np.ndarray:
    """Places of the quotes that begin or end a string; ``before`` backslashes precede the data."""
    places = np.flatnonzero(data == QUOTE)
    if before == 0 and not (data == BACKSLASH).any():
        return places
    last = np.maximum.accumulate(np.where(data != BACKSLASH, np.arange(len(data)), -1 - before))
    run = np.where(places > 0, places - 1 - last[np.maximum(places - 1, 0)], before)
    return places[run % 2 == 0]


def _strings(data: np.ndarray, before: int, inside: bool) -> np.ndarray:
    """Whether each byte lies in a string, closing quotes left out."""
    flips = np.zeros(len(data), np.int8)
    flips[_quotes(data, before)] = 1
    return (np.cumsum(flips, dtype=np.int32) + inside) % 2 == 1


def _changes(batches):
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            with _open(row["path"]) as file:
                data, before = _read(file, row["at"], row["size"]), _escapes_before(file, row["at"])
            held, steps = _strings(data, before, False), STEP[data].astype(np.int64)
            row["quotes"] = len(_quotes(data, before))
            row["outside"], row["inside"] = int(steps[~held].sum()), int(steps[held].sum())
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("at", "size", "file_size", "quotes", "outside", "inside"))]))


def _elements(batches):
    for batch in batches:
        for row in batch.to_pylist():
            with _open(row["path"]) as file:
                found = list(_cut(file, row))
            yield pa.RecordBatch.from_pydict({"path": pa.array([row["path"]] * len(found), pa.string()), "value": pa.array(found, pa.string())})


def _cut(file, row: dict):
    """Texts of the elements whose opening bracket or comma lies in a range."""
    start = bytes(_read(file, 0, min(row["file_size"], 4096))).lstrip(SPACE)
    if start and start[:1] != b"[":  # one value, not an array
        if row["at"] == 0:
            yield bytes(_read(file, 0, row["file_size"])).decode()
        return
    data, inside, depth = _read(file, row["at"], row["size"]), row["in_string"], row["depth"]
    held = _strings(data, _escapes_before(file, row["at"]), inside)
    steps = np.where(held, 0, STEP[data])
    level = np.cumsum(steps, dtype=np.int32) + depth
    opens = np.flatnonzero((steps == 1) & (level == 1) | (data == COMMA) & ~held & (level == 1))
    closes = np.flatnonzero((steps == -1) & (level == 0))
    borders = np.union1d(opens, closes)
    for at in opens:
        after = np.searchsorted(borders, at, "right")
        if after < len(borders):
            text = bytes(data[at + 1 : borders[after]])
        else:
            rest = _rest(file, row["at"] + row["size"], bool(held[-1]) if len(held) else inside, int(level[-1]))
            text = bytes(data[at + 1 :]) + rest
        if text.strip(SPACE):
            yield text.decode()


def _rest(file, at: int, inside: bool, depth: int) -> bytes:
    """What lies from a place to the end of the element it is in."""
    parts = []
    while len(data := _read(file, at, READ_ON)):
        held = _strings(data, _escapes_before(file, at), inside)
        steps = np.where(held, 0, STEP[data])
        level = np.cumsum(steps, dtype=np.int32) + depth
        ends = np.flatnonzero((data == COMMA) & ~held & (level == 1) | (steps == -1) & (level == 0))
        if len(ends):
            return b"".join([*parts, bytes(data[: ends[0]])])
        parts.append(bytes(data))
        at, inside, depth = at + len(data), bool(held[-1]), int(level[-1])
    return b"".join(parts)


def array_elements(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, value): the text of every element of plain, UTF-8 JSON array documents.

    ``paths`` are files or folders that ``pyarrow.fs`` opens on every executor. The driver lists files
    and their ranges. A document that is no array is one element, an empty one none.
    """
    files = [f for path in paths for f in files_under(spark, path)]
    ranges = [(path, at, min(range_bytes, size - at), size) for path, size in files for at in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], "path string, value string")
    dealt = spark.createDataFrame(ranges, RANGES).repartition(len(ranges), "path", "at")
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    told = dealt.mapInArrow(_changes, CHANGES).withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    told = told.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)).cast("int"))
    told = told.select("path", "at", "size", "file_size", "in_string", "depth").repartition(len(ranges), "path", "at")
    return told.mapInArrow(_elements, "path string, value string")


def read_large_json_array(spark: SparkSession, paths: str | list[str], schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of JSON array documents with ``path``, whatever the size of one document.

    An element that is not an object of this schema is a row of nulls, as in Spark's own reader.
    """
    elements = array_elements(spark, [paths] if isinstance(paths, str) else list(paths), range_bytes)
    parsed = elements.select("path", F.from_json("value", schema).alias("row"))
    return parsed.select(*[F.col("row").getField(name).alias(name) for name in schema.names], "path")
