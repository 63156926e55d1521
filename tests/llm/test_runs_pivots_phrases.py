"""Periodic runs, pivot clusters and phrase dedup against plain counterparts."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm.phrases import PART, phrase_dedup
from flowlake.llm.pivots import choose_pivots, nearest, pivot_clusters, squared
from flowlake.llm.queries import op11_periodic_runs
from flowlake.llm.squares import find_runs, periodic_runs
from tests.conftest import rows as collected
from tests.llm.data import SCHEMA, rows, texts, words


def plain_runs(ws):
    found = {}
    for q in range(1, len(ws) // 3 + 1):
        i = 0
        while i + q < len(ws):
            start = i
            while i + q < len(ws) and ws[i] == ws[i + q]:
                i += 1
            if i > start and i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def looping(rng, count, kinds):
    ws = [f"w{rng.randrange(kinds)}" for _ in range(count)]
    for _ in range(rng.randint(0, 3)):
        if count > 10:
            a = rng.randrange(count)
            p = rng.randint(1, max(1, (count - a) // 3))
            for i in range(a, rng.randint(a, count)):
                ws[i] = ws[a + (i - a) % p]
    return ws


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(150):
        docs = [looping(rng, rng.choice([0, 5, 30, 100, 300]), rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 5))]
        docs.append((["a"] * rng.randint(1, 40) + ["b"]) * rng.randint(1, 8))
        first = np.cumsum([0, *map(len, docs)])
        _, ids = np.unique([w for d in docs for w in d] or ["x"], return_inverse=True)
        ids = ids[: first[-1]]
        got = [(int(s), int(e - s), int(q)) for s, e, q in find_runs(ids, first)]
        assert got == [(s + f, n, q) for d, f in zip(docs, first.tolist()) for s, n, q in plain_runs(d)]


def thue_morse(power):
    word = [0]
    for _ in range(power):
        word += [1 - x for x in word]
    return word


def test_words_that_defeat_plain_sums_make_no_run():
    word = thue_morse(12)
    assert [r for r in plain_runs(word[:600])] == [] and len(find_runs(np.array(word * 2), np.array([0, len(word) * 2]))) == 0


def test_run_table(spark):
    rng = random.Random(8)
    values = [*texts(4, 30), *(" ".join(looping(rng, n, 3)) for n in (24, 60, 200)), "x " * 400_000]
    made = rows(values)
    got = collected(periodic_runs(spark.createDataFrame(made, SCHEMA)))
    want = []
    for r in made:
        ws = words(r[1])
        runs = [(0, len(ws), 1)] if len(ws) > 100_000 else plain_runs(ws)  # longer than any batch
        want.append((r[0], len(ws), runs, collapsed(ws, runs)))
    assert sorted(((a, b, [tuple(x) for x in c], d) for a, b, c, d in got), key=repr) == sorted(want, key=repr)
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_run_query(spark, tmp_path):
    rng = random.Random(2)
    values = [None, "", *(" ".join(looping(rng, rng.randint(1, 250), rng.choice([2, 60]))) for _ in range(120))]
    spark.createDataFrame(rows(values)[:-2], SCHEMA).distinct().write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for k, text in enumerate(values):
        ws, h = words(text), zlib.crc32(str(k).encode())
        n, g = len(ws), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(ws)
        s, m, q = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(ws, runs))]
        want.append((k, len(runs), s, m, q, m and 1000 * m // q, *digest))
    got = op11_periodic_runs(spark, str(tmp_path))
    assert collected(got) == sorted(want, key=repr)
    assert dict(got.dtypes)["exponent_milli"] == "bigint" and any(r[1] > 1 for r in want)


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, id string, pivots string"


def plain_clusters(vectors, count, rounds):
    """Rows (id, integers) to (id, cluster, distance, cluster inertia, inertia, centroid) by exact integers."""
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q, i) for i, q in vectors if i is not None)
    centroids = [q for _, q, _ in order[:count]]
    for turn in range(rounds + 1):
        told = [min((sum((x - y) ** 2 for x, y in zip(q, c)), k) for k, c in enumerate(centroids)) for _, q in vectors]
        if turn < rounds:
            for k in range(len(centroids)):
                own = [q for (_, q), (_, n) in zip(vectors, told) if n == k]
                if own:
                    centroids[k] = [sum(column) // len(own) for column in zip(*own)]
    sums = [sum(d for d, n in told if n == k) for k in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, sums[n], sum(sums), names[n]) for (i, _), (d, n) in zip(vectors, told)]


def start():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters(spark, spread):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(9, 16))
    made = [[float(x) for x in np.float32(middles[k % 9] + spread * rng.normal(size=16))] for k in range(300)]
    made += [made[0]] * 4 + [[0.0] * 16]
    bad = [None, [], [1.0] * 15, [1.0] * 17, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [3e38] * 16]
    ids = [*range(len(made)), *range(1000, 1000 + len(bad)), 5, None]
    given = [*made, *bad, made[5], made[7]]
    df = spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in zip(ids, given)], VECTORS)
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in zip(ids, given) if i is None or i < 1000]
    assert collected(pivot_clusters(df, start(), size=16, count=5, rounds=4)) == sorted(plain_clusters(good, 5, 4), key=repr)
    few = df.where("vec_id < 3")
    assert collected(pivot_clusters(few, start(), size=16, count=5, rounds=2)) == sorted(plain_clusters(good[:3], 5, 2), key=repr)
    assert pivot_clusters(df.limit(0), start(), size=16).count() == 0


def test_pivots_rule_centroids_out():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-4000, 4000, (32, 16))
    vectors = centroids[rng.integers(0, 32, 2000)] + rng.integers(-300, 300, (2000, 16))
    pivots = choose_pivots(vectors[:200], 12)
    table = np.stack([np.sqrt(squared(vectors, p).astype(float)) for p in pivots], 1)
    number, best, measured = nearest(vectors, table, centroids, pivots)
    every = ((vectors[:, None] - centroids) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (best == every.min(1)).all()
    assert measured < 2000 * 32 / 8


def plain_phrases(documents, size=100):
    seen, out = {}, []
    for key, text in sorted(documents):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            if seen.setdefault(data[k : k + size], (key, k)) != (key, k):
                gone[k : k + size] = b"\1" * size
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((key, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def documents(seed, count):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeäñ€", k=rng.randint(1, 7))) for _ in range(300)]
    passages = [" ".join(rng.choices(vocab, k=rng.randint(15, 60))) for _ in range(6)]
    made = []
    for _ in range(count):
        kind = rng.random()
        if kind < 0.1:
            text = "".join(rng.choices("ab", k=rng.randint(0, 500)))
        elif kind < 0.2:
            text = "a" * rng.randint(0, 400) + rng.choice(["", "b"]) + "ab" * rng.randint(0, 200)
        elif kind < 0.3 and made:
            text = rng.choice(made)
        elif kind < 0.5 and made:
            letters = list(rng.choice(made) or "x")
            for _ in range(rng.randint(1, 4)):
                letters[rng.randrange(len(letters))] = rng.choice("xyz")
            text = "".join(letters[rng.randrange(len(letters)) :])
        elif kind < 0.52:
            text = rng.choice([None, ""])
        else:
            text = " ".join(rng.choices(vocab, k=rng.randint(0, 200)))
            for _ in range(rng.randint(0, 2)):
                cut = rng.randrange(len(text) + 1)
                text = text[:cut] + rng.choice(passages) + text[cut:]
        made.append(text)
    return made


def plain_rows(got):
    return sorted(((*r[:4], bytes(r[4])) for r in got), key=repr)


@pytest.mark.parametrize("block_bytes", [3_000, 1 << 22])
def test_phrases(spark, block_bytes):
    made = rows(documents(3, 250))
    made, loose = made[:-4], made[-4:]
    shuffled = random.Random(1).sample(made, len(made))
    got = phrase_dedup(spark.createDataFrame([*shuffled, *loose], SCHEMA), block_bytes=block_bytes).collect()
    want = plain_phrases([(r[0], r[1]) for r in made])
    repeated = [next(w for w in want if w[0] == r[0]) for r in loose if r[0] is not None]
    untouched = [(None, len((r[1] or "").encode()), 0, 0, (r[1] or "").encode()) for r in loose if r[0] is None]
    assert plain_rows(got) == sorted([*want, *repeated, *untouched], key=repr)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("flowlake_phrases")]


def test_long_texts_and_sizes_of_phrases(spark):
    rng = random.Random(9)
    own = "".join(rng.choices("abcdefgh ", k=PART + 50_000))
    made = [(1, own[: PART + 10_000]), (2, own[30_000:] + own[5:405]), (3, "z" * (PART + 99)), (4, own[-300:])]
    got = phrase_dedup(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert plain_rows(got) == sorted(plain_phrases(made), key=repr)
    small = [(k, t) for k, t in enumerate(documents(4, 60))]
    got = phrase_dedup(spark.createDataFrame(small, "doc_id long, text string"), size=61, block_bytes=2_000).collect()
    assert plain_rows(got) == sorted(plain_phrases(small, 61), key=repr)
    assert phrase_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
