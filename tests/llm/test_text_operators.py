"""Substring dedup, Jaccard classes and decontamination against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowlake.llm import decontam, jaccard
from flowlake.llm.components import components
from flowlake.llm.substrings import COVER, PERIOD, substring_dedup
from flowlake.llm.words import PIECE, grams, split_words
from tests.llm import data


def alike(size):
    """Two different words whose polynomials agree modulo 2**64, whatever the base and the byte values."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_made_to_agree_have_different_hashes(size):
    assert len(set(split_words(pa.array([" ".join(alike(size))])).hash.tolist())) == 2


def test_no_repeat_is_seen_in_words_made_to_agree(spark):
    """And no table stays in the catalog, whose files the result still reads."""
    one, other = alike(2048)
    rows = [(1, " ".join([one] * 20)), (2, " ".join([other] * 20)), (3, " ".join([one] * 20))]
    found = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("flowlake_blocks")] == []
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found.collect()} == {1: (20, 0), 2: (20, 0), 3: (20, 20)}


def test_words_of_many_texts():
    values = ["a b", None, "", " b  a\x0b", "A b", "äö\x85x", "x" * (PIECE + 5) + " tail", "tail"]
    found = split_words(pa.chunked_array([values[:3], values[3:]], pa.string()))
    own = [
        [bytes(found.data[a:b]).decode() for a, b in zip(found.start[i:j], found.end[i:j])]
        for i, j in zip(found.first, found.first[1:])
    ]
    assert own == [data.words(v) for v in values]
    key = {}
    for word, hashed in zip(itertools.chain(*own), found.hash.tolist()):
        assert key.setdefault(word, hashed) == hashed
    assert len(set(key.values())) == len(key)
    folded = split_words(pa.array(["A b", "a B", "Q" * 300 + "x", "q" * 300 + "X"]), lower=True)
    assert folded.hash[4] == folded.hash[5]
    assert folded.hash[0] == folded.hash[2] and folded.hash[1] == folded.hash[3]
    assert len(grams(found.hash[:1], 2)) == 0


def test_cover_meets_every_pair_of_offsets():
    for i, j in itertools.product(range(PERIOD), repeat=2):
        assert any((i + k) % PERIOD in COVER and (j + k) % PERIOD in COVER for k in range(PERIOD))


def removed(docs, size):
    first = {}
    lists = [(i, data.words(t)) for i, t in docs]
    for i, own in lists:
        for k in range(len(own) - size + 1):
            key = tuple(own[k : k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, own in lists:
        gone = set()
        for k in range(len(own) - size + 1):
            if i is not None and first[tuple(own[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [7, 13])
def test_substring_dedup(spark, window):
    made = data.rows(data.texts())
    docs = spark.createDataFrame(made, data.SCHEMA)
    got = sorted((tuple(r) for r in substring_dedup(docs, window=window).collect()), key=repr)
    assert got == removed([(r[0], r[1]) for r in made], window)
    assert sum(r[2] for r in got) > 100


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(spark.createDataFrame([], data.SCHEMA)).collect() == []


def shingles(text, size):
    own = data.words(text, lower=True)
    if 0 < len(own) < size:
        return {tuple(own)}
    return {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}


def brute_classes(made, size, percent):
    sets = {}
    for i, text in [(r[0], r[1]) for r in made]:
        if i is not None:
            sets[i] = shingles(text, size)
    pairs = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return data.union_find(pairs, sets), sets


@pytest.mark.parametrize(("size", "percent", "chunk"), [(4, 85, 96), (2, 60, 3)])
def test_jaccard_classes(spark, monkeypatch, size, percent, chunk):
    """Small chunks send a crowd of copies, and what it does not link, through every round."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rng = random.Random(5)
    crowd = [f"k{j}" for j in range(200)]
    values = data.texts(2)
    for _ in range(25):
        own = list(crowd)
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(200)] = rng.choice(["x", "y", "z"])
        values.append(" ".join(own))
    made = data.rows(values)
    docs = spark.createDataFrame(made, data.SCHEMA)
    want, sets = brute_classes(made, size, percent)
    got = jaccard.jaccard_classes(docs, size, percent).collect()
    assert len(got) == len(made)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        if r.doc_id is not None:
            assert r.n_shingles == len(sets[r.doc_id])
    assert len(set(want.values())) < len(want) - 20


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_classes(spark.createDataFrame([], data.SCHEMA), 4, 85).collect() == []
    only = spark.createDataFrame(data.rows([None, "", " ", "a"]), data.SCHEMA)
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_classes(only, 4, 85).collect()}[3] == 3


def test_signature_tree_prunes_nothing_that_links():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, 80).astype(np.uint64)
        for _ in range(3):
            own = base.copy()
            own[rng.integers(0, 80, 4)] = rng.integers(0, 2**63, 4).astype(np.uint64)
            sets.append(np.unique(own[: rng.integers(70, 81)]))
    sets.sort(key=len)
    forest = jaccard.Forest(np.arange(len(sets)), np.array([len(s) for s in sets]), sets, 75)
    forest.within(jaccard.Node(forest, 0, len(sets)))
    pairs = [
        (a, b) for a, b in itertools.combinations(range(len(sets)), 2)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
    ]
    assert data.union_find(forest.links, range(len(sets))) == data.union_find(pairs, range(len(sets)))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    chain = list(range(1000, 1060))
    rng.shuffle(chain)
    pairs = [*zip(chain, chain[1:]), *((7, k) for k in range(8, 60)), (3, 4), (4, 3), (5, 5), (None, 1)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    assert got == data.union_find(real, {x for p in real for x in p})


# -- decontamination ------------------------------------------------------------------------------


def test_masks_meet_every_pair_of_replaced_words():
    for gone in itertools.combinations(range(decontam.WINDOW), decontam.MAY_DIFFER):
        assert any(
            all(start + k not in gone for k, taken in enumerate(mask) if taken == "1")
            for mask in decontam.MASKS
            for start in range(decontam.WINDOW - len(mask) + 1)
        )


def test_masks_of_short_items_meet_every_replaced_word():
    for size in range(1, decontam.WINDOW):
        masks = decontam.masks_of(size)
        assert all(len(m) == size for m in masks)
        assert size < 8 or all(any(m[k] == "0" for m in masks) for k in range(size))


@pytest.mark.parametrize("proposals", [1 << 21, 1000])
def test_one_word_over_and_over(monkeypatch, proposals):
    """A seed that repeats in text and item: every alignment once, in bounded parts."""
    monkeypatch.setattr(decontam, "PROPOSALS", proposals)
    items = decontam.Items([1, 2], [" ".join(["a"] * 200), " ".join(["a"] * 9 + ["b"])])
    words = split_words(pa.array([" ".join(["x"] + ["a"] * 1500), "a a a a", " ".join(["a"] * 10)]), lower=True)
    assert items.matches(words) == [(0, 0, 13, 13, 1, 0), (0, 1, 9, 10, 1, 0), (2, 1, 9, 10, 0, 0)]


def test_short_items_are_looked_up_when_asked_for(spark):
    docs = spark.createDataFrame([(1, "say Two Words here"), (2, "two other words"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "two words"), (8, "")], "item_id long, text string")
    assert decontam.contamination(docs, bench).collect() == []
    assert [tuple(r) for r in decontam.contamination(docs, bench, min_words=1).collect()] == [(1, 7, 2, 2, 1, 0)]
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, bench, min_words=1).collect()) == [2, 3]


def held(text, item):
    own, want = data.words(text, lower=True), data.words(item, lower=True)
    if len(want) < decontam.MIN_WORDS:
        return None
    size = min(len(want), 13)
    allowed = 2 if len(want) >= 13 else 1 if len(want) >= 8 else 0
    best = None
    for a in range(len(own) - size + 1):
        for b in range(len(want) - size + 1):
            same = sum(x == y for x, y in zip(own[a : a + size], want[b : b + size]))
            if same >= size - allowed and (best is None or (-same, a, b) < (-best[0], *best[2:])):
                best = (same, size, a, b)
    return best


@pytest.mark.parametrize("block", [1 << 21, 60])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    rng = random.Random(9)
    vocab = data.vocabulary(rng)
    items = [" ".join(rng.choices(vocab, k=n)) for n in (5, 8, 12, 13, 20, 50, 30, 7, 9, 10, 11)]
    items += [items[4], "two words", None, ""]
    values = data.texts(3, 30)
    for k, item in enumerate(x for x in items if x):
        own = data.words(item)
        for changed in range(4):
            new = list(own)
            for _ in range(changed):
                new[rng.randrange(len(new))] = "replaced"
            values.append(" ".join([*rng.choices(vocab, k=k), *new, *rng.choices(vocab, k=4)]))
        values.append(" ".join(own[: len(own) // 2]))
    made = data.rows(values)
    docs = spark.createDataFrame(made, data.SCHEMA)
    bench = spark.createDataFrame([*enumerate(items), (None, items[3])], "item_id long, text string")
    want = []
    for r in made:
        for i, item in enumerate(items):
            if r[1] and item and (found := held(r[1], item)):
                want.append((r[0], i, *found))
    got = [tuple(r) for r in decontam.contamination(docs, bench).collect()]
    assert Counter(got) == Counter(want) and len(want) > 20
    clean = decontam.decontaminate(docs, bench)
    dirty = {w[0] for w in want}
    assert clean.schema == docs.schema
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in made if r[0] not in dirty)


def test_contamination_without_benchmark(spark):
    docs = spark.createDataFrame(data.rows(["a b c"]*4), data.SCHEMA)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs, empty).collect() == []
    assert decontam.decontaminate(docs, empty).count() == docs.count()
    assert decontam.contamination(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []
