"""The registered queries and the pipeline on the smallest data."""

import itertools
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flowlake.llm.langid import fit_languages, identify
from flowlake.llm.mixing import mix_sources
from flowlake.llm.queries import ORACLE, QUERIES, domain_column, tokenizer_path
from tests.llm import data
from tests.llm.test_text_operators import held, shingles

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data is not here")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in cursor.description)
    want = cursor.fetchdf()[columns].astype(str).values.tolist()
    df = QUERIES[name](spark, SMALL)
    got = df.select(*columns).toPandas().astype(str).values.tolist()
    assert sorted(df.columns) == columns and sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_language_query_learns_what_it_did_not_see(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = [r for r in QUERIES["op2_language_id"](spark, SMALL).collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)


def test_scores_beat_the_unigram_on_held_out_texts(spark):
    got = [r for r in QUERIES["op6_hmm_score"](spark, SMALL).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["near duplicates"]
    sets = {r.doc_id: shingles(r.text, 5) for r in before}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    roots = data.union_find(pairs, sets)
    assert {r.doc_id for r in after} == set(roots.values()) and len(after) < len(before)
    before, after = kept["benchmark decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    four = lambda text: set(zip(*(data.words(text, True)[k:] for k in range(4))))
    short = [r for r in before if len(data.words(r.text)) < 3000]  # eleven of thirteen words hold four in a row
    near = {r.doc_id: [i for i in items if four(i) & four(r.text)] for r in short}
    dirty = {r.doc_id for r in short if any(held(r.text, i) for i in near[r.doc_id])}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {r.doc_id for r in short} & gone == dirty and dirty
    before, after = kept["language id"]
    told = identify(spark.createDataFrame(before), fit_languages(spark.createDataFrame(before)))
    assert {r.doc_id for r in after} == {r.doc_id for r in told.where("lang_pred != 'und' and not rejected").collect()}
    assert len(after) >= 0.98 * sum(any(c.isalpha() for c in r.text or "") for r in before)
    before, after = kept["mixing sources"]
    frame = spark.createDataFrame(before)
    levels = [domain_column(), F.col("lang"), F.col("source")]
    weights = corpus_pipeline.supply_weights(frame, levels)
    mixed = mix_sources(frame, levels, weights, corpus_pipeline.SHARE, corpus_pipeline.EPOCHS).collect()
    times = {r.doc_id: r.mix_copies + (r.mix_prefix > 0) for r in mixed}
    assert Counter(r.doc_id for r in after) == Counter({k: n for k, n in times.items() if n})
    before, after = kept["token files"]
    encoder = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    at, want = 0, []
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in after) == want


def test_stages_on_odd_rows(spark):
    """Null, empty and repeated rows, user columns named like inner ones, and no rows at all."""
    made = [r for r in data.rows(data.texts(3, 80)) if r[0] is not None or r[1] is None]
    made += [(900, made[0][1], "en", "src1", 1, "x", 1, 1, [1])] * 3 + [(901, made[0][1], "en", "src1", 1, "x", 1, 1, [1])]
    docs = spark.createDataFrame(made, data.SCHEMA)
    names = ["copies", "copy", "mix_copies", "mix_prefix", "mix_tokens", "row", "hash", "count", "l0"]
    docs = docs.select("*", *[(F.coalesce("doc_id", F.lit(-1)) * 7 + k).alias(n) for k, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns, name
        for r in after.collect():
            assert [r[n] for n in names] == [(-1 if r.doc_id is None else r.doc_id) * 7 + k for k in range(len(names))], name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    ids = Counter(r.doc_id for r in kept)
    first = made[0][1]
    assert [r.doc_id for r in kept if r.text == first] == [0]
    assert all(n == 1 for k, n in ids.items() if k is not None)
    last = corpus_pipeline.tokens(spark, docs, SMALL)
    assert last.count() == docs.count() and corpus_pipeline.tokens(spark, docs.limit(0), SMALL).count() == 0


@pytest.mark.parametrize("hot", ["src1", "src2", "src7"])
def test_mixture_drops_no_text_whatever_source_is_large(spark, hot):
    """A third of the tokens in any one source, and a third under a fifth language or none."""
    rows = [(k, "w " * (5 + k % 40), ["en", "de", "fr", "es", "it", None][k % 6], hot if k % 3 == 0 else f"src{k % 20}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    times = {r.doc_id: r["count"] for r in corpus_pipeline.mixture(spark, docs, SMALL).groupBy("doc_id").count().collect()}
    assert set(times) == {r[0] for r in rows} and set(times.values()) <= {1, 2}
    taken = sum(len(r[1].split()) * times[r[0]] for r in rows)
    assert taken >= 1.34 * sum(len(r[1].split()) for r in rows)
