"""Readers, writers, catalog and stream over temporary folders."""

import gzip
import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake import schemas
from flowlake.operators.incremental import between_days
from flowlake.session import scratch_path, shared_dir
from flowlake.sinks import reports as report_sink
from flowlake.sinks import tables
from flowlake.sources import catalog, files, json_arrays, outcomes
from flowlake.streaming import ingest
from tests.conftest import rows

HEADER = "fecha|periodo|origen|destino|edad|viajes|viajes_km|residencia"


def write_gz(path, *lines, header=HEADER):
    with gzip.open(path, "wt") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return str(path)


def test_od_csv_keeps_text_extra_columns_and_origin(spark, tmp_path):
    a = write_gz(tmp_path / "a.csv.gz", "20240105|00|01001|01002|25-45|1.5|3|01")
    b = write_gz(tmp_path / "b.csv.gz", "20240106|23|01001|externo|0-25|2|4|01")
    manifest = spark.createDataFrame([(a, "https://h.example/a")], "path string, original_url string")
    got = files.read_od_csv(spark, [a, b], manifest, fecha_as_timestamp=True)
    assert dict(got.dtypes)["fecha"] == "timestamp_ntz" and dict(got.dtypes)["periodo"] == "string"
    assert rows(got.select("origen", "edad", "source_file")) == [
        ("01001", "0-25", b),
        ("01001", "25-45", "https://h.example/a"),
    ]
    assert rows(files.ingest_summary(got)) == [(b, 1), ("https://h.example/a", 1)]


def test_od_csv_with_another_header_is_refused(spark, tmp_path):
    a = write_gz(tmp_path / "a.csv.gz", "20240105|0|1|2|x|1|3|1")
    b = write_gz(tmp_path / "b.csv.gz", "20240105|0|1|2|x|1|3|1", header=HEADER[::-1])
    with pytest.raises(Exception, match="header"):
        files.read_od_csv(spark, [a, b]).collect()


def test_relation_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("|".join(schemas.ZONE_RELATION.names) + "\n0100101001|0100101|01001|x|01001|y\n")
    got = files.read_zone_relation(spark, str(path))
    assert got.first().municipio_ine == "01001" and "loaded_at" in got.columns


def test_zone_source_merges_attributes(spark, tmp_path):
    (tmp_path / "names.csv").write_text("n|ID|name\n0|01|Uno\n1|02.0|Dos\n2|02|Zwei\n")
    (tmp_path / "people.csv").write_text("01|1.234\n03|77.0\n")
    names = files.read_id_value(spark, str(tmp_path / "names.csv"), True, "Nombre")
    people = files.read_id_value(spark, str(tmp_path / "people.csv"), False, "Poblacion")
    attributes = files.zone_attributes(names, people)
    assert rows(attributes) == [("01", "Uno", 1234), ("02", "Dos", None), ("03", None, 77)]
    shapes = spark.createDataFrame([(z, "POLYGON EMPTY") for z in ("01", "02", "03", "09")], "ID string, geometry string")
    got = files.zone_boundaries(shapes, attributes)
    assert got.columns == ["ID", "Nombre", "Poblacion", "geometry"]
    assert rows(got.drop("geometry")) == [
        ("01", "Uno", "1234"), ("02", "Dos", "0"), ("03", "03", "77"), ("09", "09", "0"),
    ]


def test_json_documents(spark, tmp_path):
    series = [
        {"COD": "A", "Nombre": "Uno. Total", "Data": [{"Valor": 1.5, "Anyo": 2023}, {"Valor": None}]},
        {"COD": "B", "Nombre": "Dos. Total", "Data": []},
    ]
    path = tmp_path / "s.json"
    path.write_text(json.dumps(series, indent=1))
    got = files.read_json_array(spark, str(path), schemas.SERIES_RAW, "https://h.example/s", 2023)
    assert rows(got.select("COD", F.size("Data"), "source_url", "year")) == [
        ("A", 2, "https://h.example/s", 2023),
        ("B", 0, "https://h.example/s", 2023),
    ]
    days = [
        {"startDate": "2024-01-01", "name": [{"text": "New year"}], "nationwide": True},
        {"startDate": "2024-01-01", "name": [{"text": "Again"}], "nationwide": True},
        {"startDate": "2024-01-22", "name": [{"text": "Local"}], "nationwide": False},
    ]
    path = tmp_path / "h.json"
    path.write_text(json.dumps(days))
    got = files.read_holidays(spark, str(path))
    assert rows(got.select(F.col("date").cast("string"), "name")) == [("2024-01-01", "Again")]


def flows(spark, *stamps):
    rows_ = [(s, "1", float(i)) for i, s in enumerate(stamps)]
    df = spark.createDataFrame(rows_, "fecha string, zone string, v double")
    return df.withColumn("fecha", F.col("fecha").cast("timestamp_ntz"))


def test_write_days_is_idempotent_and_prunes(spark, tmp_path):
    path = str(tmp_path / "days")
    table = flows(spark, "2024-01-05 01:00", "2024-01-05 02:00", "2024-01-06 00:00")
    tables.write_days(table, path, "fecha")
    tables.write_days(table.where("v < 2"), path, "fecha")
    stored = spark.read.parquet(path)
    assert stored.count() == 3
    one_day = between_days(stored, "fecha", "2024-01-05", "2024-01-05")
    assert one_day.count() == 2
    scan = one_day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*make_date", scan)
    tables.append_days(table.where("v = 2"), path, "fecha")
    assert spark.read.parquet(path).count() == 4


def test_catalog_tables(spark):
    for name in ("lake_od_municipios", "lake_od_gau", "lake_zone_municipios", "other"):
        tables.create_day_table(spark, name, schemas.OD_HOURLY, "fecha")
    tables.create_day_table(spark, "other", schemas.OD_HOURLY, "fecha")  # exists already
    assert not catalog.is_loaded(spark, "other") and not catalog.is_loaded(spark, "absent")
    hourly = spark.createDataFrame([(None, "1", "2", 1.0, 1.0, "r", False, False)], schemas.OD_HOURLY)
    stamp = F.lit("2024-01-05 10:00").cast("timestamp_ntz")
    tables.insert_into(hourly.withColumn("fecha", stamp), "other", "fecha")
    assert catalog.is_loaded(spark, "other")
    assert rows(catalog.list_tables(spark, "lake_%")) == [
        ("lake_od_gau",), ("lake_od_municipios",), ("lake_zone_municipios",),
    ]
    assert rows(catalog.list_tables(spark, "lake_%", "od", "municipios")) == [("lake_od_municipios",)]
    names = ["lake_od_municipios", "absent"]
    assert rows(tables.drop_tables(spark, names)) == [
        ("absent", False, False), ("lake_od_municipios", True, False),
    ]
    assert rows(tables.drop_tables(spark, names, dry_run=False))[1][2]
    assert not spark.catalog.tableExists("lake_od_municipios")
    tables.drop_tables(spark, ["lake_od_gau", "lake_zone_municipios", "other"], dry_run=False)


def test_storage_inventory(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t1"))
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t2"))
    inventory = catalog.storage_files(spark, str(tmp_path)).where("path like '%.parquet'")
    summary = {r.table_name: r.n_files for r in catalog.storage_summary(inventory).collect()}
    assert set(summary) == {"t1", "t2"} and summary["t2"] == 3
    counts = catalog.row_counts({"a": spark.range(3), "b": spark.range(5)})
    assert rows(counts) == [("a", 3), ("b", 5)]


def test_report_sink(spark, tmp_path):
    params = report_sink.ReportParams("2024-01-05", "2024-01-20", "POLYGON ((0 0,1 0,1 1,0 0))")
    run = report_sink.run_id("2024-03-09")
    assert re.fullmatch(r"09032024_[0-9a-f]{6}", run)
    path = report_sink.write_report(spark.range(3), str(tmp_path), 1, run, "top_origins")
    assert path == f"{tmp_path}/gold/question1/{run}/top_origins"
    assert spark.read.json(path).count() == 3
    info = spark.read.json(report_sink.write_run_info(spark, params, str(tmp_path), 1, run)).first()
    assert (info.run_id, info.start_date, info.end_date) == (run, "2024-01-05", "2024-01-20")


@pytest.mark.parametrize(
    ("start", "end", "polygon"),
    [
        ("2024-01-05", "2024-01-05", "POLYGON ((0 0,1 0,1 1,0 0))"),
        ("2024-1-x", "2024-01-05", "POLYGON ((0 0,1 0,1 1,0 0))"),
        ("2024-01-01", "2024-01-05", "POINT (0 0)"),
    ],
)
def test_report_parameters_are_checked(start, end, polygon):
    with pytest.raises(ValueError):
        report_sink.ReportParams(start, end, polygon)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, log = (str(tmp_path / p) for p in ("in", "out", "log"))
    (tmp_path / "in").mkdir()
    plain = "|".join(schemas.OD_RAW.names)

    def run():
        stream = ingest.new_files(spark, source, schemas.OD_RAW, header="true", sep="|")
        ingest.ingest_available(stream, target, log)
        return spark.read.parquet(target)

    write_gz(tmp_path / "in" / "a.csv.gz", "20240105|0|1|2|1|2|r", header=plain)
    assert run().count() == 1
    assert run().count() == 1
    write_gz(tmp_path / "in" / "b.csv.gz", "20240106|0|1|2|1|2|r", "20240106|1|1|2|1|2|r", header=plain)
    got = run()
    assert got.count() == 3 and got.where("day = 6").count() == 2
    assert got.select("source_file").distinct().count() == 2

    late = spark.createDataFrame([("20240107", "3", "1", "2", "1", "2", "r")], schemas.OD_RAW)
    for _ in range(2):  # a repeated batch replaces itself; stream and batch rows are read together
        ingest.write_batch(late, -1, target)
        assert spark.read.parquet(target).count() == 4
    write_gz(tmp_path / "in" / "c.csv.gz", "20240107|4|1|2|1|2|r", header=plain)
    assert run().count() == 5


def test_row_level_load_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([("a", None), ("b", "1")], "k string, v string")
    first = rows_.withColumn("loaded_at", F.current_timestamp())
    tables.append(first.limit(1), path)
    for _ in range(2):
        assert tables.append_new_rows(first, path)
        assert spark.read.parquet(path).count() == 2
    assert not tables.append_new_rows(first.limit(0), path)


def test_shared_folder_is_required_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark_master="yarn"))
    local = Session(spark_master="local[2]")
    assert shared_dir(local) == shared_dir(local)
    named = Session(spark_master="yarn", **{"spark_checkpoint_dir": "s3a://b/c/"})
    assert shared_dir(named) == "s3a://b/c"


def test_scratch_paths_live_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


TRICKY = [
    {"k": 1, "t": "plain", "d": [{"x": 1}, {"x": 2}]},
    {"k": 2, "t": 'quote " and \\ and \\" end \\\\', "d": []},
    {"k": 3, "t": "],[ },{ \\", "d": [{"x": 3}]},
    {"k": 4, "t": "äöü 日本 \U0001f642" * 9, "d": None},
    {"k": 5, "t": "", "d": [{"x": None}]},
    {"k": 6, "t": "\\" * 301 + '"' + "[" * 50, "d": [{"x": k} for k in range(60)]},
]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 1 << 20])
def test_array_documents_are_cut_at_elements(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(json_arrays, "READ_ON", 5)
    compact = json.dumps(TRICKY, ensure_ascii=False, separators=(",", ":"))
    documents = {"a": compact, "b": json.dumps(TRICKY, indent=2), "c": "[]", "d": " \n[ ]\n", "e": json.dumps(TRICKY[2]), "f": "", "g": "[ {} ]"}
    for name, text in documents.items():
        (tmp_path / f"{name}.json").write_text(text)
    if size < 64:  # the driver's own functions, range by range, as jobs of a thousand tasks take long
        for name in "abcdeg":
            raw = documents[name].encode()
            rows_, inside, depth, got = [], False, 0, []
            for at in range(0, len(raw), size):
                rows_.append({"path": str(tmp_path / f"{name}.json"), "at": at, "size": min(size, len(raw) - at), "file_size": len(raw)})
            for batch in json_arrays._changes([pa.RecordBatch.from_pylist(rows_)]):
                for row in batch.to_pylist():
                    with json_arrays._open(row["path"]) as file:
                        got += json_arrays._cut(file, row | {"in_string": inside, "depth": depth})
                    depth += row["inside"] if inside else row["outside"]
                    inside ^= row["quotes"] % 2 == 1
            want = json.loads(documents[name])
            assert [json.loads(x) for x in got] == (want if isinstance(want, list) else [want])
        return
    schema = "k int, t string, d array<struct<x:int>>"
    got = json_arrays.read_large_json_array(spark, str(tmp_path), T.StructType.fromDDL(schema), size)
    one = [(r["k"], r["t"], r["d"] and [(x["x"],) for x in r["d"]]) for r in TRICKY]
    want = [("a", *r) for r in one] + [("b", *r) for r in one] + [("e", *one[2]), ("g", None, None, None)]
    assert sorted(((r.path[-6], r.k, r.t, r.d and [tuple(x) for x in r.d]) for r in got.collect()), key=repr) == sorted(
        ((f, k, t, d if d != [] else []) for f, k, t, d in want), key=repr
    )


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"k": k, "t": "x" * (k % 50)} for k in range(5000)]))
    found = json_arrays.array_elements(spark, [str(path)], 20_000)
    tasks = found.select(F.spark_partition_id().alias("p")).distinct().count()
    assert found.count() == 5000 and tasks > 3


def test_every_file_has_an_outcome(spark, tmp_path):
    names = "|".join(schemas.OD_RAW.names)
    line = "20240105|0|1|2|1|2|r"
    write_gz(tmp_path / "good.csv.gz", line, line, header=names)
    write_gz(tmp_path / "some.csv.gz", line, "20240105|0", line + "|too|many", "", header=names)
    write_gz(tmp_path / "none.csv.gz", header=names)
    write_gz(tmp_path / "other.csv.gz", line, header="a|b")
    write_gz(tmp_path / "cut.csv.gz", *[f"2024010{k % 9 + 1}|{k}|{k * 7919 % 1000}|2|{k}|2|r" for k in range(20_000)], header=names)
    whole = (tmp_path / "cut.csv.gz").read_bytes()
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) * 2 // 3])  # most rows can be read
    (tmp_path / "junk.csv.gz").write_bytes(b"no gzip")
    (tmp_path / "zero.csv").write_bytes(b"")
    (tmp_path / "bare.csv").write_text(names)
    (tmp_path / "last.csv").write_text(f"{names}\n{line}")
    paths = [(str(p),) for p in sorted(tmp_path.iterdir())] + [(str(tmp_path / "gone.csv"),), (None,), (str(tmp_path / "good.csv.gz"),)]
    got, told = outcomes.load_files(spark, spark.createDataFrame(paths, "path string"), schemas.OD_RAW)
    found = {r.source_file.rsplit("/", 1)[1].split(".")[0]: (r.status, r.n_rows, r.n_rejected) for r in told.collect()}
    assert found == {
        "good": ("loaded", 2, 0), "some": ("loaded", 1, 2), "none": ("empty", 0, 0), "other": ("failed", 0, 0), "cut": ("failed", 0, 0),
        "junk": ("failed", 0, 0), "zero": ("empty", 0, 0), "bare": ("empty", 0, 0), "last": ("loaded", 1, 0), "gone": ("missing", 0, 0),
    }
    assert got.count() == 4 and got.columns == [*schemas.OD_RAW.names, "loaded_at", "source_file"]
    assert rows(outcomes.outcome_totals(told)) == [(10, 3, 3, 3, 1, 4, 2)]
    nothing, none = outcomes.load_files(spark, spark.createDataFrame([], "path string"), schemas.OD_RAW)
    assert nothing.count() == 0 and rows(outcomes.outcome_totals(none)) == [(0, 0, 0, 0, 0, 0, 0)]
