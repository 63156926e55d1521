"""Pick up files that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.temporal import date_parts, day_text_parts
from flowlake.functions.text import EXTERNAL_ZONE
from flowlake.operators.incremental import PARTS
from flowlake.plans.od import hourly_windows, with_day_flags
from flowlake.schemas import OD_RAW
from flowlake.sinks.folders import names
from flowlake.sources.files import with_provenance


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "csv",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Streaming frame over the files of a folder, with provenance columns."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_provenance(reader.load(path))


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is new to a plain table partitioned by the day text, then stop.

    The checkpoint is the log of processed files, so a re-run adds nothing. Every batch writes the
    partitions of its own number (``batch``, then the day) and replaces them when it is repeated, so a
    batch counts once. The table holds no sink log: batch writers may append to it (:func:`load_batch`), and
    readers see both.
    """
    query = (
        stream.writeStream.foreachBatch(lambda rows, number: write_batch(rows, number, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def hourly_available(
    stream: DataFrame, holidays: DataFrame, target: str, checkpoint: str, delay: str = "2 days"
) -> None:
    """Bring the hourly fact at ``target`` up to date with what is new, as far as hours are closed; then stop.

    Open hours wait in the checkpoint's state, so runs that each see a part of the files end where one run
    over all of them ends, and a run without new files adds nothing. Every batch writes the partitions of its
    number, so a repeated one counts once. A row of any kind whose hour lies past the last ones closes
    them: see :func:`closing_row`. How the state is spread is fixed by ``spark.sql.shuffle.partitions`` at the
    first run; where long delays make it large, name RocksDB as the session's state store provider.
    """
    hours = hourly_windows(stream, delay)

    def write(rows: DataFrame, number: int) -> None:
        write_batch(with_day_flags(rows, holidays), number, target)

    query = (
        hours.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def closing_row(spark: SparkSession, fecha: str) -> DataFrame:
    """A raw row that counts nowhere and closes, once the stream has seen it, the hours the delay before its day."""
    given = {"fecha": fecha, "periodo": "0", "origen": EXTERNAL_ZONE, "destino": EXTERNAL_ZONE}
    return spark.createDataFrame([tuple(given.get(c) for c in OD_RAW.names)], OD_RAW)


def write_batch(rows: DataFrame, number: int, target: str) -> None:
    """Write one batch as a whole: the same number again replaces all it had, on any day."""
    text = dict(rows.dtypes)["fecha"] == "string"
    parts = day_text_parts(F.col("fecha")) if text else date_parts(F.col("fecha"))
    (
        rows.select("*", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*PARTS)
        .parquet(f"{target}/batch={number}")
    )


def load_batch(rows: DataFrame, target: str, number: int | None = None) -> int:
    """Add a batch load beside what the stream and other loads wrote; returns its number.

    Streams count from 0 up, loads from -1 down. A load that is repeated after a failure, or corrected, gives its old
    number. One load numbers itself at a time.
    """
    if number is None:
        taken = [int(n.removeprefix("batch=")) for n in names(rows.sparkSession, target) if n.startswith("batch=")]
        number = min([0, *taken]) - 1
    if number >= 0:
        raise ValueError("numbers from 0 up are the stream's")
    write_batch(rows, number, target)
    return number
