"""Hidden Markov language model over words.

A word belongs to one symbol: a frequent word is its own, others share one of 1024 classes by their
last three bytes. The chance of a word in a state is that of its symbol there times the word's share
of the symbol, so the model covers an open vocabulary with a bounded number of parameters. Word
counts are exact over all training texts: blocks send their distinct words to hash buckets and get the
counts back. Baum-Welch adds up expected counts across partitions, one bounded row per task; the
score is the exact likelihood by the scaled forward recursion.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import bucket_count, text_blocks
from flowlake.llm.components import stored
from flowlake.llm.words import U64, bucket_of, mix, split_words

STATES, ITERATIONS = 8, 2
CLASSES, TAIL = 1024, 3
#: A word of at least one in so many training tokens is a symbol of its own; so there are at most as many.
FREQUENT = 4096
#: Texts (those of smallest hash) from which the states start; all training texts then train them.
START_TEXTS = 1024
#: Tokens in one padded batch. Longer training texts are cut there for Baum-Welch, never for scoring.
BATCH_TOKENS = 1 << 18
SEED = 11

SENT = "bucket int, block int, hash binary, count binary, class binary, total long"
REPLY = "kind int, block int, bucket int, one binary, two binary"
SYMBOLS = "id long, held boolean, n_tokens long, n_known long, base double, inner double, symbols binary"


def word_classes(words) -> np.ndarray:
    """Class of every word by its last bytes, A-Z folded."""
    key = np.zeros(len(words.start), U64)
    for k in range(1, TAIL + 1):
        at = words.end - k
        inside = at >= words.start
        byte = words.data[np.maximum(at, 0)].astype(U64)
        byte = np.where((byte >= 65) & (byte <= 90), byte + U64(32), byte)
        key = key * U64(257) + np.where(inside, byte + U64(1), U64(0))
    return (mix(key) % U64(CLASSES)).astype(np.uint16)


def _distinct(words):
    """Sorted distinct hashes, one place of each, and where every word stands among them."""
    order = np.argsort(words.hash, kind="stable")
    ordered = words.hash[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return ordered[new], order[new], rank


def _send(buckets: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words = split_words(table["text"], lower=True)
        keys, place, rank = _distinct(words)
        train = ~np.asarray(table["held"].combine_chunks())[words.text_of]
        counts = np.bincount(rank[train], minlength=len(keys)).astype(np.uint32)
        classes = word_classes(words)[place]
        of = bucket_of(keys, buckets)
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0])) if len(of) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(of))
        parts = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
        return pa.table({
            "bucket": pa.array(of[cuts], pa.int32()), "block": pa.array(np.full(len(cuts), key[0].as_py()), pa.int32()),
            "hash": parts(keys), "count": parts(counts), "class": parts(classes),
            "total": pa.array([int(counts[a:b].sum()) for a, b in zip(cuts, ends)], pa.int64()),
        })

    return send


def _count(total: int):
    """Counts of a bucket's words: back to the blocks (kind 0), frequent words (1), sums by class (2)."""

    def count(table: pa.Table) -> pa.Table:
        join = lambda c, t: np.frombuffer(b"".join(x.as_py() for x in table[c]), t)
        keys, counts, classes = join("hash", U64), join("count", np.uint32), join("class", np.uint16)
        sizes = np.array([len(x.as_py()) // 8 for x in table["hash"]], int)
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
        sums = np.add.reduceat(counts[order].astype(np.int64), starts)
        back = np.empty(len(keys), np.int64)
        back[order] = np.repeat(sums, np.diff(np.append(starts, len(keys))))
        back = back.astype(np.uint32) if len(back) and back.max() < 1 << 32 else back
        ends = np.cumsum(sizes)
        own = np.argsort(-sums, kind="stable")[: int(np.count_nonzero(sums * FREQUENT >= max(total, 1)))]
        rest = np.ones(len(sums), bool)
        rest[own] = False
        of, found = classes[order][starts][rest], sums[rest]
        per_class = [np.bincount(of, found, CLASSES).astype(np.int64), np.bincount(of, found > 0, CLASSES).astype(np.int64)]
        bucket = table["bucket"][0].as_py()
        rows = [(0, b, bucket, back[e - n : e].tobytes(), b"") for b, e, n in zip(table["block"].to_pylist(), ends, sizes)]
        rows.append((1, -1, bucket, keys[order][starts][own].tobytes(), sums[own].tobytes()))
        rows.append((2, -1, bucket, per_class[0].tobytes(), per_class[1].tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in REPLY.split(", ")])

    return count


@dataclass
class Vocabulary:
    """Bounded totals: frequent words, sums by class, and those over all training tokens."""

    frequent: np.ndarray  # sorted hashes; symbol k is the k-th
    frequent_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    ends: int

    @property
    def tokens(self) -> int:
        return int(self.frequent_counts.sum() + self.class_tokens.sum() + self.ends)

    @property
    def distinct(self) -> int:
        return int(len(self.frequent) + self.class_words.sum() + (self.ends > 0))

    @property
    def end_symbol(self) -> int:
        return len(self.frequent) + CLASSES

    @property
    def shares(self) -> np.ndarray:
        """Smoothed share of every symbol among all training tokens."""
        counts = np.concatenate([self.frequent_counts, self.class_tokens, [self.ends]]).astype(float)
        return (counts + 1) / (counts.sum() + len(counts))


def _encode(vocabulary: Vocabulary, buckets: int):
    """Symbols, base score and the words' shares of their symbols, for every text of a block."""
    v = vocabulary

    def encode(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        words = split_words(table["text"], lower=True)
        keys, place, rank = _distinct(words)
        back = dict(zip(replies["bucket"].to_pylist(), replies["one"].to_pylist()))
        of, sizes = np.unique(bucket_of(keys, buckets), return_counts=True)
        parts = [np.frombuffer(back[int(b)], np.uint32 if len(back[int(b)]) == 4 * n else np.int64) for b, n in zip(of, sizes)]
        counts = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        at = np.searchsorted(v.frequent, keys)
        own = np.zeros(len(keys), bool)
        inside = at < len(v.frequent)
        own[inside] = v.frequent[at[inside]] == keys[inside]
        classes = word_classes(words)[place].astype(np.int64)
        symbol = np.where(own, at, len(v.frequent) + classes).astype(np.uint16)
        inner = np.where(own, 0.0, np.log10((counts + 1) / (v.class_tokens + v.class_words + 1)[classes]))
        base = np.log10((counts + 1) / (v.tokens + v.distinct + 1))
        end = np.log10((v.ends + 1) / (v.tokens + v.distinct + 1))
        texts = len(words.first) - 1
        per_text = lambda x: np.bincount(words.text_of, x[rank], texts).astype(float)
        flat = symbol[rank]
        stop = np.uint16(v.end_symbol).tobytes()
        return pa.table({
            "id": table["id"].combine_chunks(), "held": table["held"].combine_chunks(),
            "n_tokens": pa.array(words.counts + 1, pa.int64()),
            "n_known": pa.array(per_text((counts > 0).astype(float)).astype(np.int64) + (v.ends > 0), pa.int64()),
            "base": pa.array(per_text(base) + end), "inner": pa.array(per_text(inner)),
            "symbols": pa.array([flat[a:b].tobytes() + stop for a, b in zip(words.first, words.first[1:])], pa.binary()),
        })

    return encode


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states

    def batches(self, texts: list[np.ndarray], limit: int = BATCH_TOKENS):
        """(places, padded symbols by time, active texts by time), texts of similar length together."""
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        at = 0
        while at < len(order):
            longest = len(texts[order[at]])
            part = order[at : at + max(1, limit // longest)]
            padded = np.zeros((longest, len(part)), np.int64)
            for column, k in enumerate(part):
                padded[: len(texts[k]), column] = texts[k]
            lengths = np.array([len(texts[k]) for k in part])
            yield part, padded, len(part) - np.searchsorted(lengths[::-1], np.arange(longest), "right")
            at += len(part)

    def log_likelihood(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of each sequence's chance; memory does not grow with its length."""
        out = np.zeros(len(texts))
        for part, padded, active in self.batches(texts):
            logs = np.zeros(len(part))
            state = None
            for t, n in enumerate(active):
                before = np.broadcast_to(self.start, (n, len(self.start))) if state is None else state[:n] @ self.move
                state = before * self.emit[padded[t, :n]]
                scale = state.sum(1)
                state /= scale[:, None]
                logs[:n] += np.log(scale)
            out[part] = logs
        return out

    def expected(self, texts: list[np.ndarray]):
        """Baum-Welch counts: starts, moves and emissions (symbols x states)."""
        states = len(self.start)
        starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros_like(self.emit)
        for _, padded, active in self.batches(texts):
            shown = self.emit[padded]
            forward, scales = np.zeros(shown.shape), np.ones(padded.shape)
            for t, n in enumerate(active):
                now = (self.start if t == 0 else forward[t - 1, :n] @ self.move) * shown[t, :n]
                scales[t, :n] = now.sum(1)
                forward[t, :n] = now / scales[t, :n, None]
            back = np.ones(shown.shape[1:])
            for t in range(len(active) - 1, -1, -1):
                n = active[t]
                gamma = forward[t, :n] * back[:n]
                ahead = shown[t, :n] * back[:n] / scales[t, :n, None]
                forward[t, :n] = gamma  # not needed any more
                if t:
                    moves += forward[t - 1, :n].T @ ahead
                    back[:n] = ahead @ self.move.T
            starts += forward[0].sum(0)
            flat = padded.ravel()
            for k in range(states):
                emits[:, k] += np.bincount(flat, forward[:, :, k].ravel(), len(emits))
        return starts, moves * self.move, emits


def _start_model(texts: list[np.ndarray], shares: np.ndarray, states: int) -> Model:
    """States from a mixture of symbol distributions over a bounded sample of texts."""
    random = np.random.default_rng(SEED)
    symbols = len(shares)
    emit = np.tile(shares[:, None], (1, states)) * random.uniform(0.9, 1.1, (symbols, states))
    if texts:
        rows = np.array([np.bincount(t, minlength=symbols) for t in texts], np.float32)
        size = rows.sum(1, keepdims=True)
        chosen = [int(np.argmax(size))]
        for _ in range(states - 1):  # spread the first guesses: the text that those so far explain worst
            emit = (rows[chosen] + 50 * shares) / (size[chosen] + 50)
            worst = (rows @ (np.log(emit) - np.log(shares)).T / size).max(1)
            worst[size[:, 0] < 30] = np.inf
            worst[chosen] = np.inf
            chosen.append(int(np.argmin(worst)))
        emit = (rows[chosen] + 50 * shares) / (size[chosen] + 50)
        for _ in range(10):
            odds = rows @ np.log(emit).T
            odds = np.exp(odds - odds.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            emit = odds.T @ rows + 50 * shares
            emit /= emit.sum(1, keepdims=True)
        emit = emit.T
    emit = emit / emit.sum(0)
    move = np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
    return Model(np.full(states, 1 / states), move, np.ascontiguousarray(emit, dtype=float))


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(batch.schema.get_field_index("symbols"))]


def _slices(batches, texts: int = 2048):
    for batch in batches:
        for at in range(0, len(batch), texts):
            yield batch.slice(at, texts)


PARTS = 16


def _train(table: DataFrame, model: Model, shares: np.ndarray, slots: int = 1) -> Model:
    """One round of Baum-Welch over all training texts; sums of tasks meet in ``slots`` groups a part first."""

    def expect(batches):
        sums = None
        for batch in _slices(batches):
            texts = [t[a : a + BATCH_TOKENS] for t in _arrays(batch) for a in range(0, len(t), BATCH_TOKENS)]
            found = np.concatenate([x.ravel() for x in model.expected(texts)])
            sums = found if sums is None else sums + found
        if sums is not None:
            cut = np.array_split(sums, PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in cut], pa.binary())], ["part", "sums"])

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in part["sums"])
        return pa.table({"part": part["part"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "part int, sums binary"
    sums = table.where("not held").select("symbols").mapInArrow(expect, kind)
    sums = sums.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(slots)))
    sums = sums.groupBy("part", "slot").applyInArrow(add, kind)
    rows = sums.groupBy("part").applyInArrow(add, kind).collect()
    if not rows:
        return model
    sums = np.concatenate([np.frombuffer(bytes(r.sums)) for r in sorted(rows, key=lambda r: r.part)])
    k = len(model.start)
    starts, moves, emits = sums[:k], sums[k : k + k * k].reshape(k, k), sums[k + k * k :].reshape(-1, k)
    emits = emits + 20 * shares[:, None]
    moves = moves + 1.0 / k
    return Model((starts + 1) / (starts + 1).sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def score_texts(
    docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, iterations: int = ITERATIONS
) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``held`` is true where a text does not train. Tokens are words with A-Z lower-cased, then one end.
    base_score is the add-one unigram score, score the model's, both log10 of the whole text. Null and
    empty texts are the end alone; a text of more than BATCH_TOKENS tokens trains in sequences of
    as many, and is scored as one. A null ``held`` counts as held out. Repeated rows train and are
    scored each; other columns are ignored. Without training texts every symbol is as likely.
    """
    slim = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(held, F.lit(True)).alias("held"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    table, blocks, size = text_blocks(slim, "text", ["id"])
    buckets = bucket_count(size // 12)
    groups = table.groupBy("block")
    sent = stored(groups.applyInArrow(_send(buckets), SENT), "block-words")
    total = sent.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    ends = table.where("not held").count()
    replies = stored(sent.groupBy("bucket").applyInArrow(_count(total + ends), REPLY), "word-counts")
    vocabulary = _vocabulary(replies, ends, buckets)
    encoded = groups.cogroup(replies.where("kind = 0").select("block", "bucket", "one").groupBy("block"))
    coded = stored(encoded.applyInArrow(_encode(vocabulary, buckets), SYMBOLS), "symbols")

    shares = vocabulary.shares
    place = F.xxhash64(F.lit(SEED), "id", "symbols")  # a share of the texts first, so tasks send few of them
    near = (place.cast("double") / F.lit(2.0**64) + 0.5) * F.lit(ends) <= 2 * START_TEXTS + 50
    first = coded.where("not held").where(near).orderBy(place, "symbols").limit(START_TEXTS).select("symbols").collect()
    model = _start_model([np.frombuffer(bytes(r.symbols), np.uint16) for r in first], shares, states)
    for _ in range(iterations):
        model = _train(coded, model, shares, math.isqrt(blocks))

    def score(batches):
        for batch in _slices(batches):
            found = model.log_likelihood(_arrays(batch)) / np.log(10)
            inner = np.asarray(batch.column(batch.schema.get_field_index("inner")))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "held", "n_tokens", "n_known", "base")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found + inner)], ["id", "held", "n_tokens", "n_known", "base", "score"])

    done = coded.mapInArrow(score, "id long, held boolean, n_tokens long, n_known long, base double, score double")
    return done.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


def _vocabulary(replies: DataFrame, ends: int, buckets: int) -> Vocabulary:
    """At most FREQUENT words and CLASSES sums reach the driver, the sums as one row per root of the buckets."""
    frequent = [(x, y) for r in replies.where("kind = 1").collect() for x, y in zip(np.frombuffer(bytes(r.one), U64), np.frombuffer(bytes(r.two), np.int64))]
    frequent.sort()
    parts = replies.where("kind = 2").withColumn("part", F.pmod("bucket", F.lit(math.isqrt(buckets))).cast("int"))
    rows = parts.select("part", "one", "two").groupBy("part").applyInArrow(_sum_classes, "one binary, two binary").collect()
    sums = [sum((np.frombuffer(bytes(r[k]), np.int64) for r in rows), np.zeros(CLASSES, np.int64)) for k in (0, 1)]
    keys = np.array([x for x, _ in frequent], U64)
    return Vocabulary(keys, np.array([y for _, y in frequent], np.int64), *sums, ends)


def _sum_classes(table: pa.Table) -> pa.Table:
    sums = (sum(np.frombuffer(x.as_py(), np.int64) for x in table[c]) for c in ("one", "two"))
    return pa.table([pa.array([x.tobytes()], pa.binary()) for x in sums], names=["one", "two"])
