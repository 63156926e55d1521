"""What became of every requested file: loaded, empty, failed or missing, and how many of its rows were no rows."""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.operators.joins import lookup_join
from flowlake.sinks.tables import stored
from flowlake.sources.files import plain_path, with_provenance

BROKEN = "__broken"
PROBES = "path string, error string, n_lines long, n_bytes long"
CHUNK = 1 << 20


def _probe_file(path: str, header: str | None) -> tuple[str | None, int, int]:
    """(error, lines below the header that are not blank, bytes once unpacked) of one file, read to its end in chunks."""
    system, plain = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    if system.get_file_info(plain).type != pafs.FileType.File:
        return "missing", 0, 0
    lines, size, rest, first = 0, 0, b"", header is not None
    try:
        with system.open_input_file(plain) as raw:
            stream = gzip.GzipFile(fileobj=raw) if plain.endswith(".gz") else raw
            while chunk := stream.read(CHUNK):
                size += len(chunk)
                *whole, rest = (rest + chunk).split(b"\n")
                if first and whole:
                    first = False
                    if whole[0].strip().decode(errors="replace") != header:
                        return "header differs", 0, size
                    whole = whole[1:]
                lines += sum(1 for line in whole if line.strip())
    except (OSError, EOFError, zlib.error) as error:
        return f"{type(error).__name__}: {error}", lines, size
    if first and rest.strip() and rest.strip().decode(errors="replace") != header:
        return "header differs", 0, size
    return None, lines + bool(rest.strip() and not first), size


def probe_files(paths: DataFrame, header: str | None = None) -> DataFrame:
    """(path, error, n_lines, n_bytes) of every file of ``paths`` (column ``path``), one task per few files.

    A file is unpacked to its end, so one that breaks off is found, wherever that is. ``header`` is the first line
    that files have to have. The storage has to be one that ``pyarrow.fs`` opens.
    """

    def probe(batches):
        for batch in batches:
            found = [(path, *_probe_file(path, header)) for path in batch.column(0).to_pylist()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds], ["path", "error", "n_lines", "n_bytes"])

    distinct = paths.select(plain_path(F.col("path")).alias("path")).where("path is not null").distinct()
    return distinct.repartition("path").mapInArrow(probe, PROBES)


def load_files(
    spark: SparkSession, manifest: DataFrame, schema: T.StructType, sep: str = "|"
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files of a manifest (column ``path``), and one outcome per file, however bad some are.

    Files have a header with the names of ``schema``. Each is read to its end first, and only whole ones
    are loaded: a broken file fails alone. The rows, with ``loaded_at`` and ``source_file``, are written to the
    shared folder; lines that do not fit the schema are not among them. Outcomes are (source_file, status,
    n_rows, n_rejected, error): ``loaded``, ``empty`` (a header at most), ``failed`` or ``missing``. The list
    of whole files comes to the driver.
    """
    probes = stored(probe_files(manifest, sep.join(schema.names)), "probes")
    whole = [r.path for r in probes.where("error is null and n_lines > 0").select("path").collect()]
    given = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    if whole:
        reader = spark.read.schema(given).option("columnNameOfCorruptRecord", BROKEN).option("mode", "PERMISSIVE")
        rows = with_provenance(reader.csv(whole, header=True, sep=sep))
    else:
        rows = spark.createDataFrame([], given).select("*", F.current_timestamp().alias("loaded_at"), F.lit("").alias("source_file"))
    rows = stored(rows, "loaded")
    counts = rows.groupBy("source_file").agg(
        F.count_if(F.col(BROKEN).isNull()).alias("n_rows"), F.count_if(F.col(BROKEN).isNotNull()).alias("n_rejected")
    )
    told = lookup_join(probes, counts, {"path": "source_file"}, "left")
    status = (
        F.when(F.col("error") == "missing", "missing").when(F.col("error").isNotNull(), "failed")
        .when(F.col("n_lines") == 0, "empty").otherwise("loaded")
    )
    outcomes = told.select(
        F.col("path").alias("source_file"), status.alias("status"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"), "error",
    )
    return rows.where(F.col(BROKEN).isNull()).drop(BROKEN), outcomes


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """(requested, loaded, empty, failed, missing, n_rows, n_rejected) over all files."""
    kinds = ("loaded", "empty", "failed", "missing")
    return outcomes.agg(
        F.count("*").alias("requested"),
        *[F.count_if(F.col("status") == kind).alias(kind) for kind in kinds],
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_rejected"), F.lit(0)).alias("n_rejected"),
    )
