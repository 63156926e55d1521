"""Token files and token counts against the tokenizers themselves."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlake.llm import token_counts, token_files
from tests.llm import data

P = pytest.importorskip("public_tokenizers")

ODD = [
    "It's 'sabc don't <|endoftext|> x<|startoftext|>y", "ÉCOLE İstanbul ΣΑΣ Straße", "tab\there\xa0nb em sp\x1cfs",
    "...,, ., a., b,.  \n\n  x \n", "foo.,bar, 12,5 1.", "́abc ́ d́", "日本語 テスト", "\U0001f642\U0001f642a \U0001f642",
    " lead", "trail  ", "\n\n", "a  b", "x" * 70 + ",", "word " * 400,
]


@pytest.fixture(scope="module")
def made():
    return data.rows([*data.texts(7, 30), *ODD], first=-3)


def test_token_files(spark, made, tmp_path):
    path, name = str(tmp_path / "out"), P.path("word_bpe_49k.json")
    docs = spark.createDataFrame(made, data.SCHEMA).repartition(5)
    manifest = token_files.write_token_files(docs, path, name, end_id=1)
    got = token_files.read_token_files(spark, path).collect()
    encoder = Tokenizer.from_file(name)
    ids = [(r[0], [*encoder.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in made]
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ids), key=lambda i: (i is not None, i or 0))
    want = sorted((repr(i), np.array(t, "<u4").tobytes()) for i, t in ids)
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens * 4) == (at, len(r.ids))
        at += r.n_tokens
    rows = manifest.orderBy("shard").collect()
    assert sum(r.tokens for r in rows) == at and sum(r.documents for r in rows) == len(made)
    for r in rows:  # the files as another program maps them
        offsets = np.memmap(f"{path}/{r.name}.offsets", "<u8", "r")
        assert len(offsets) == r.documents + 1 and offsets[-1] == r.tokens
        assert len(np.memmap(f"{path}/{r.name}.ids", f"<u{r.width}", "r")) == r.tokens
        assert r.base == sum(x.tokens for x in rows if x.shard < r.shard)
    crc = token_files.read_token_files(spark, path).where("doc_id = 0").select(F.crc32("ids")).first()[0]
    assert crc == zlib.crc32(dict(ids[:10]).get(0) and np.array(dict(ids)[0], "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_and_texts_beyond_a_batch(spark, tmp_path, name, monkeypatch):
    """Texts are whole for a tokenizer that keeps white space, and a long text is one text."""
    text = open(P.path(name)).read()
    assert token_files.drops_spaces(text) == name.startswith("word")
    long = "words and, more\tof  them\n" * 100_000
    assert len(long) > token_files.PIECE
    made = [(1, "hi there"), (2, long), (3, None), (4, ""), (5, " x  y "), (6, "end")]
    path = str(tmp_path / "out")
    token_files.write_token_files(spark.createDataFrame(made, "doc_id long, text string"), path, P.path(name), end_id=1)
    encoder = Tokenizer.from_str(text)
    want = [(k, np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for k, t in made]
    assert sorted((r.doc_id, bytes(r.ids)) for r in token_files.read_token_files(spark, path).collect()) == want


def test_shards_grow_past_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "MAX_SHARDS", 30)
    docs = spark.createDataFrame([(k, "a b") for k in range(500)], "doc_id long, text string")
    manifest = token_files.write_token_files(docs, str(tmp_path / "out"), P.path("word_bpe_49k.json"), 1, shard_bytes=10)
    assert manifest.count() <= 30
    got = token_files.read_token_files(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(k, 3 * k, 3) for k in range(500)]


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(spark.createDataFrame([], data.SCHEMA), path, P.path("word_bpe_49k.json"), end_id=1)
    assert token_files.read_token_files(spark, path).collect() == []


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 20)
    text = open(P.path("word_bpe_49k.json")).read()
    encoder, plain = token_files.WordEncoder(text, "<u4"), Tokenizer.from_str(text)
    rng = random.Random(3)
    values = [*(t or "" for t in data.texts(8, 20)), *ODD]
    for _ in range(3):
        rng.shuffle(values)
        for text, found in zip(values, encoder.encode(values)):
            assert found == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize(("rule", "lines"), [("first", True), ("last", True), ("most", True), ("first", False)])
def test_token_counts(spark, made, rule, lines):
    name = P.path("byte_bpe_50k.json")
    docs = spark.createDataFrame(made, data.SCHEMA)
    got = token_counts.token_counts(docs, name, ["source", "text"], rule, lines).collect()
    encoder = Tokenizer.from_file(name)
    want = []
    for r in made:
        values = [r[3] or "", r[1] or ""]
        whole, sections, at = "\n".join(values), [], 0
        for field, value in zip(("source", "text"), values):
            cuts = [0, *(k + 1 for k, c in enumerate(value) if c == "\n" and lines)]
            sections += [(field, k, at + c) for k, c in enumerate(cuts)]
            at += len(value) + 1
        ends = [*(s[2] for s in sections[1:]), len(whole)]
        counts = [[0, 0] for _ in sections]
        for a, b in encoder.encode(whole, add_special_tokens=False).offsets:
            held = [(min(b, e) - max(a, s[2]), k) for k, (s, e) in enumerate(zip(sections, ends)) if min(b, e) > max(a, s[2])]
            owner = {"first": held[0][1], "last": held[-1][1], "most": max(held, key=lambda h: (h[0], -h[1]))[1]}[rule]
            counts[owner][0] += 1
            counts[owner][1] += len(held) > 1
        want += [(r[0], f, k, s, e - s, n, c) for (f, k, s), e, (n, c) in zip(sections, ends, counts)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_token_counts_of_nothing(spark):
    empty = spark.createDataFrame([], data.SCHEMA)
    assert token_counts.token_counts(empty, P.path("byte_bpe_50k.json"), ["text"]).collect() == []
    with pytest.raises(ValueError):
        token_counts.token_counts(empty, "x", ["text"], rule="none")
