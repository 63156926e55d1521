"""Language identification, language-model scores and near vectors."""

import itertools
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import hmm, langid, vectors
from tests.llm import data


def two_languages(rng, count):
    kinds = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["schr", "ung", "ßei", "keit"]}
    out = []
    for k in range(count):
        lang = "aa" if k % 3 else "bb"
        own = ["".join(rng.choices(kinds[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60))]
        out.append((k, " ".join(own).capitalize() + ".", lang))
    return out


def test_language_id(spark):
    rng = random.Random(4)
    rows = two_languages(rng, 240)
    extra = [(900, None, "aa"), (901, "", "bb"), (902, "12 .. 3", None), (903, "Ж" * 300, None), (904, "Bami lota!", None), (None, "ungkeit", None)]
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = langid.fit_languages(docs, F.col("doc_id") % 4 != 2)
    assert model.languages == ["aa", "bb"]
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(rows) + len(extra)
    assert all(got[k].lang_pred == lang for k, _, lang in rows)
    for k in (900, 901, 902):
        assert (got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True)
    assert got[903].rejected and got[904].lang_pred == "aa" and got[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5].score > 0.9
    kept = langid.known_language(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {k for k, _, _ in rows} | {904, None}


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, model).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0), model).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test data is not here")
@pytest.mark.parametrize("out", ["es", "fr"])
def test_texts_of_a_language_left_out_of_the_fit_are_rejected(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null")
    model = langid.fit_languages(docs, (F.col("lang") != out) & (F.col("doc_id") % 4 != 2))
    probe = docs.where((F.col("lang") == out) | (F.col("doc_id") % 4 == 2))
    found = probe.select("doc_id", "lang").join(langid.identify(probe, model), "doc_id").collect()
    unknown, known = [r for r in found if r.lang == out], [r for r in found if r.lang != out]
    assert sum(r.rejected for r in unknown) >= 0.9 * len(unknown)
    assert sum(r.rejected for r in known) <= 0.02 * len(known)


def test_a_language_of_few_texts_has_a_limit(spark):
    rng = random.Random(5)
    rows = two_languages(rng, 240)
    few = [(500 + k, "ko no wa ra yu " * 20 + "ko", "cc") for k in range(3)]  # none of them calibrates
    docs = spark.createDataFrame([*rows, *few], "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert model.languages == ["aa", "bb", "cc"] and np.isfinite(model.limits).all()
    _, _, rejected, _ = model.predict(["ko no wa ra yu " * 30, "ko xq zv wj kk qq nv rr " * 30])
    assert rejected.tolist() == [False, True]


def test_kneser_ney_is_a_distribution_and_arrays_agree():
    rng = np.random.default_rng(1)
    symbols = 6
    ids = rng.integers(0, symbols - 1, 500).astype(np.uint16)
    keys, counts = np.unique(langid._keys(ids, langid.ORDER)[3:], return_counts=True)
    model = langid.KneserNey(keys, counts, symbols)
    for context in itertools.product(range(symbols), repeat=3):
        grams = np.array([sum(int(c) << (16 * (3 - k)) for k, c in enumerate((*context, x))) for x in range(symbols)], np.uint64)
        assert model.chance(4, grams).sum() == pytest.approx(1)
    shared = langid.LanguageModel(["a"], np.arange(1, symbols - 1))
    for order in range(1, langid.ORDER + 1):
        seen = np.arange(symbols, dtype=np.uint64) if order == 1 else model.levels[order - 1][0]
        shared.grams.append(langid.Grams(seen, np.log(model.chance(order, seen))[:, None]))
        after = model.levels[order - 1][3]
        shared.weights.append(langid.Grams(after, np.log(model.backoff(order, after))[:, None]))
    probe = rng.integers(0, symbols, 2000).astype(np.uint16)
    want = np.log(model.chance(4, langid._keys(probe, 4)))
    assert shared._logs(probe)[3:, 0] == pytest.approx(want[3:], rel=1e-4)


def test_hash_array_finds_what_it_holds():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**60, 5000).astype(np.uint64))
    table = langid.Grams(keys[::2], np.arange(len(keys[::2]), dtype=float)[:, None])
    row, found = table.find(keys)
    assert found[::2].all() and not found[1::2].any()
    assert table.values[row[::2], 0].tolist() == list(range(len(keys[::2])))


# -- hidden Markov model ------------------------------------------------------------------------------


def small_model(seed, states=3, symbols=4):
    rng = np.random.default_rng(seed)
    part = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1])
    return hmm.Model(part(states), part(states, states), np.ascontiguousarray(part(states, symbols).T))


def paths(model, text):
    total, posterior = 0.0, np.zeros_like(model.emit)
    for states in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[states[0]] * model.emit[text[0], states[0]]
        for a, b, x in zip(states, states[1:], text[1:]):
            p *= model.move[a, b] * model.emit[x, b]
        total += p
        for s, x in zip(states, text):
            posterior[x, s] += p
    return total, posterior / total


def test_likelihood_and_counts_against_all_paths():
    model = small_model(1)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 5, 3, 6, 1)]
    want = [paths(model, t) for t in texts]
    assert model.log_likelihood(texts) == pytest.approx([np.log(p) for p, _ in want])
    starts, moves, emits = model.expected(texts)
    assert emits == pytest.approx(sum(c for _, c in want))
    assert starts.sum() == pytest.approx(len(texts)) and moves.sum() == pytest.approx(sum(len(t) - 1 for t in texts))
    assert list(model.batches(texts, 2))  # batches smaller than a text
    every = [np.array(t, np.uint16) for t in itertools.product(range(4), repeat=3)]
    assert np.exp(model.log_likelihood(every)).sum() == pytest.approx(1)


def test_scores(spark):
    made = data.rows(data.texts(6, 80))
    docs = spark.createDataFrame(made, data.SCHEMA)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = hmm.score_texts(docs, held, states=3).collect()
    assert len(got) == len(made)
    train, out = {}, {}
    lists = [[*data.words(r[1], lower=True), None] for r in made]
    is_held = [r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in made]
    for own, h in zip(lists, is_held):
        for w in [] if h else own:
            train[w] = train.get(w, 0) + 1
    total, distinct = sum(train.values()), len(train)
    for r, own, h in zip(made, lists, is_held):
        base = sum(np.log10((train.get(w, 0) + 1) / (total + distinct + 1)) for w in own)
        out.setdefault(r[0], []).append((h, len(own), sum(w in train for w in own), total, round(base, 6)))
    for r in got:
        mine = (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        assert mine in out[r.doc_id]
        assert np.isfinite(r.score) and r.score < 0


def test_scores_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = hmm.score_texts(docs, F.lit(True), states=2).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert hmm.score_texts(docs.limit(0), F.lit(False), states=2).collect() == []


# -- near vectors ------------------------------------------------------------------------------------


def test_near_vectors(spark, monkeypatch):
    """A crowd larger than a block, pairs near the threshold, and vectors that link with nothing."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(32)
    made = [centre + 0.2 * rng.standard_normal(32) for _ in range(90)]
    for spread in (0.3, 0.45, 0.5):
        for _ in range(30):
            base = rng.standard_normal(32)
            made += [base, base + spread * rng.standard_normal(32)]
    made += [rng.standard_normal(32) * 1e200, np.zeros(32), rng.standard_normal(8)]
    values = [[float(x) for x in v] for v in made]
    odd = [None, [], [1.0, None], [float("nan")] * 32, [float("inf")] * 32]
    ids = rng.permutation(len(values) + len(odd)).tolist()
    rows = [(i, v, 1) for i, v in zip(ids, [*values, *odd])]
    rows += [rows[0], (None, values[0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("component", F.lit("x"))
    unit = {i: np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) for i, v in zip(ids, values) if np.any(v)}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    degree = {i: 0 for i in ids}
    for pair in links:
        for i in pair:
            degree[i] += 1
    want = data.union_find(links, ids)
    got = vectors.near_vectors(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id) == (0, None)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert max(degree.values()) > 80


def test_near_vectors_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(empty).collect() == []


@pytest.mark.parametrize("run", [64, 2048])
def test_near_vectors_in_a_dense_table(spark, monkeypatch, run):
    """A third of the rows lies around one centre: pairs at the threshold stand among many that are close
    but no links, more than any bounded window over sorted signs reaches; runs larger than a block too."""
    monkeypatch.setattr(vectors, "RUN", run)
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    hot = unit(unit(rng.standard_normal(64)) + 0.085 * rng.standard_normal((4000, 64)))
    made = np.concatenate([hot, unit(rng.standard_normal((8000, 64)))])
    picked = np.concatenate([np.arange(400), np.arange(4000, 4100)])
    aside = rng.standard_normal((len(picked), 64))
    aside = unit(aside - (aside * made[picked]).sum(1, keepdims=True) * made[picked])
    made = np.concatenate([made, 0.905 * made[picked] + np.sqrt(1 - 0.905**2) * aside])
    near = np.triu(made @ made.T >= 0.9, 1)
    links = list(zip(*np.nonzero(near)))
    want, degree = data.union_find(links, range(len(made))), near.sum(0) + near.sum(1)
    assert len(links) >= 500
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(made)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    assert got == {k: (int(degree[k]), int(want[k])) for k in range(len(made))}


def test_equal_vectors_take_part_once(spark, monkeypatch):
    """A third of the rows and more are one vector: work grows with the different ones, links count all."""
    monkeypatch.setattr(vectors, "RUN", 64)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    made = [base] * 20_000 + [base + 0.05 * rng.standard_normal(16) for _ in range(5)] + [rng.standard_normal(16) for _ in range(500)]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(made)], "vec_id long, embedding array<double>")
    spied = []
    planned = vectors.plan_passes
    monkeypatch.setattr(vectors, "plan_passes", lambda usable, rows, *rest: spied.append(rows) or planned(usable, rows, *rest))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(frame).collect()}
    unit = np.array([v / np.linalg.norm(v) for v in made])
    unit[:20_000] = unit[0]
    weight = np.concatenate([[20_000], np.ones(505)])
    some = unit[[0, *range(20_000, 20_505)]]
    near = some @ some.T >= 0.9
    degree = near @ weight - 1
    assert spied == [506]
    assert all(got[k] == (degree[0], 0, k == 0) for k in range(20_000))
    assert [got[20_000 + k][0] for k in range(505)] == degree[1:].astype(int).tolist()
    assert [got[20_000 + k][1] for k in range(5)] == [0] * 5


def test_windows_reach_over_partitions(spark):
    """Neighbours in the order of one pass meet although leading signs differ and partitions part them."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 24))
    made = np.stack([base, base + 0.1 * rng.standard_normal(base.shape)], 1).reshape(-1, 24)
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    rows = [(k, 24, v.tobytes(), 1) for k, v in enumerate(made)]
    classes = spark.createDataFrame(rows, vectors.VECTORS + ", n long")
    found = {tuple(sorted(r)) for r in vectors._links(classes, len(rows), 1, 24, 0.9).collect()}
    order = np.argsort(vectors._signs(made, 1, vectors.BITS)[:, 0], kind="stable")
    beside = {tuple(sorted((int(a), int(b)))) for a, b in zip(order, order[1:]) if made[a] @ made[b] >= 0.9}
    leading = vectors._signs(made, 1, vectors.BITS)[:, 0] >> (vectors.BITS - 24)
    assert beside <= found and any(leading[a] != leading[b] for a, b in beside)
    assert all(made[a] @ made[b] >= 0.9 for a, b in found)


def test_a_pair_is_decided_alike_wherever_it_is_met():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((200, 48))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    threshold = float((a[3] * a[8]).sum())
    whole = vectors._near(a, a, threshold)
    assert whole[3, 8] and (whole == whole.T).all()
    for size in (1, 7, 33):
        parts = [np.concatenate([vectors._near(a[i : i + size], a[j : j + 5], threshold) for j in range(0, 200, 5)], 1) for i in range(0, 200, size)]
        assert (np.concatenate(parts) == whole).all()


def test_passes_follow_the_chance_of_a_miss():
    agree = 1 - np.arccos(0.9) / np.pi
    for signs in (1, 6, 14):
        passes = vectors.passes_needed(0.9, signs)
        assert (1 - agree**signs) ** passes <= vectors.MISS < (1 - agree**signs) ** (passes - 1)
    assert vectors.passes_needed(0.9, 0) == 1


def plain_symbols(text):
    """Lower-case letters with one 0 for each run of other characters, after three 0 that absorb a leading run."""
    out = [0, 0, 0]
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif out[-1] != 0:
            out.append(0)
    return out


class PlainKneserNey:
    """Interpolated Kneser-Ney by dictionaries, straight from the definition."""

    def __init__(self, texts, symbols):
        self.symbols, self.counts = symbols, []
        grams = Counter()
        for text in texts:
            s = plain_symbols(text)
            grams.update(tuple(s[k - 3 : k + 1]) for k in range(3, len(s)))
        for _ in range(4):
            self.counts.insert(0, grams)
            lower = Counter()
            for gram in grams:  # each kind of letter before counts once
                lower[gram[1:]] += 1
            grams = lower
        self.discounts = []
        for grams in self.counts:
            n = Counter(grams.values())
            self.discounts.append(min(max(n[1] / max(n[1] + 2 * n[2], 1), 0.1), 0.95))

    def chance(self, gram):
        if not gram:
            return 1 / self.symbols
        grams, discount = self.counts[len(gram) - 1], self.discounts[len(gram) - 1]
        followers = [n for g, n in grams.items() if g[:-1] == gram[:-1]]
        lower = self.chance(gram[1:])
        if not followers:
            return lower
        total = sum(followers)
        return max(grams.get(gram, 0) - discount, 0) / total + discount * len(followers) / total * lower

    def entropy(self, text):
        s = plain_symbols(text)
        logs = [math.log(self.chance(tuple(s[k - 3 : k + 1]))) for k in range(3, len(s))]
        return -sum(logs) / len(logs)


def test_entropies_and_choice_against_plain_models(spark, monkeypatch):
    """Counts, discounts, back-off, entropy and choice, also where a text goes over many chunks."""
    rng = random.Random(6)
    kinds = {"en": ["the", "then", "when", "hen", "new"], "xx": ["zha", "azh", "hazz", "zah", "new"]}
    rows = []
    for k in range(60):
        lang = sorted(kinds)[k % 2]
        rows.append((k, ", ".join(rng.choices(kinds[lang], k=rng.randint(5, 30))) + ".", lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    sample = docs.selectExpr("*", "xxhash64(doc_id, text) as h").collect()
    counted = {}
    for lang in kinds:
        order = sorted((r for r in sample if r.lang == lang), key=lambda r: (r.h, r.text))
        counted[lang] = [r.text for n, r in enumerate(order, 1) if n % 5 != 0]
    letters = {c for texts in counted.values() for t in texts for c in t.lower() if c.isalpha()}
    plain = {lang: PlainKneserNey(texts, len(letters) + 2) for lang, texts in counted.items()}
    probes = ["The new hen", "azh zah!", "then,zha", "n", "new new  new", "the hazz " * 30]
    want = np.array([[plain[lang].entropy(t) for lang in model.languages] for t in probes])
    for chunk in (langid.CHUNK, 7):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        got = model.entropies(["", *probes])[0][1:]
        assert np.allclose(got, want, rtol=2e-5)
    found = langid.identify(spark.createDataFrame(enumerate(probes), "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {k: model.languages[int(w.argmin())] for k, w in enumerate(want)}
    monkeypatch.undo()
    long = "the hen, " * (langid.CHUNK // 4)
    entropy, count, _ = model.entropies([long])
    assert count[0] == len(plain_symbols(long)) - 3 > 2 * langid.CHUNK - 9
    once = model.entropies([long[:900]])[0]
    assert np.allclose(entropy, once, rtol=0.01)
