"""Language identification by interpolated Kneser-Ney models over characters.

Texts become sequences of lower-case letters, with one boundary for any run of other characters. Per
language, four-letter counts give a Kneser-Ney model whose lower orders use continuation counts. All
languages share sorted arrays of hashed grams, one per order, with a column of log probabilities per
language; grams that no language has seen add a back-off weight and go to the next order. The
language of lowest cross-entropy per letter wins; its score is calibrated on texts kept out of the
counts, and so is the cross-entropy beyond which a text is rejected, which depends on the text's length.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.components import stored
from flowlake.llm.tasks import pieces, small_batches
from flowlake.llm.words import U64, mix

ORDER = 4
#: Labelled texts per language in the bounded sample, those of smallest hash; every fifth calibrates.
FIT_TEXTS = 500
#: Positions whose probabilities a task holds at once; a longer text goes on where it stopped.
CHUNK = 1 << 18
#: Texts may lie above their language's median as far as this quantile of calibration texts, in deviations of
#: letters and of texts so many times the standard one.
REJECT_QUANTILE, REJECT_SPREADS = 0.999, 4.0
#: Positions of the stretches that tell how letters deviate, and calibration texts a spread of its own takes.
STRETCH, LIMIT_TEXTS = 16, 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letter_codes(texts: list[str]):
    """Code points of each text with letters or signs after ORDER - 1 boundaries: (codes, firsts, number of the text).

    A run of characters that are no letters is one 0; code points of letters stay.
    """
    pad = "\0" * (ORDER - 1)
    owner = [k for k, text in enumerate(texts) if text]
    slices = [pad + texts[k].lower() for k in owner]
    codes = np.frombuffer("".join(slices).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(0))
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in slices])]).astype(np.int64)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    for k in range(ORDER - 1):
        keep[firsts[:-1] + k] = True
    if len(firsts) > 1:  # the pad already is a boundary
        after = firsts[:-1] + ORDER - 1
        after = after[after < firsts[1:]]
        keep[after] = codes[after] != 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], kept[firsts], np.array(owner, np.int64)


def _keys(ids: np.ndarray, order: int) -> np.ndarray:
    """Packed gram of ``order`` ids that ends at each position; 16 bits an id."""
    key = np.zeros(len(ids), U64)
    for back in range(order - 1, -1, -1):
        key <<= U64(16)
        key[back:] |= ids[: len(ids) - back].astype(U64)
    return key


class Grams:
    """Sorted hashed grams with rows of values, found by an index over the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys.astype(U64))
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], U64(2**64 - 1))
        self.values = np.concatenate([values[order], values[:1] * 0]).astype(np.float32)
        self.shift = U64(64 - max(8, int(np.ceil(np.log2(len(keys) + 1))) + 2))
        self.index = np.searchsorted(self.hashes, np.arange((1 << int(64 - int(self.shift))) + 1, dtype=U64) << self.shift)
        self.index[-1] = len(keys)
        self.index = self.index.astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, found) of packed grams."""
        hashes = mix(keys)
        at = self.index[hashes >> self.shift]
        found = self.hashes[at] == hashes
        open_ = np.flatnonzero(~found & (self.hashes[at] < hashes))
        while len(open_):
            at[open_] += 1
            now = self.hashes[at[open_]]
            hit = now == hashes[open_]
            found[open_[hit]] = True
            open_ = open_[now < hashes[open_]]
        return at, found


class KneserNey:
    """One language: counts by order, from distinct packed grams of the highest."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, symbols: int):
        self.symbols = symbols
        self.levels = []
        for order in range(ORDER, 0, -1):
            ones, twos = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
            discount = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.95)
            contexts, at = np.unique(keys >> U64(16), return_inverse=True)
            totals, kinds = np.bincount(at, counts, len(contexts)), np.bincount(at, minlength=len(contexts))
            self.levels.insert(0, (keys, counts, discount, contexts, totals, kinds))
            if order > 1:  # continuation: how many different letters stand before
                keys, counts = np.unique(keys & U64((1 << (16 * (order - 1))) - 1), return_counts=True)

    def backoff(self, order: int, contexts: np.ndarray) -> np.ndarray:
        """Weight of the lower order after a context; 1 if the context is new."""
        _, _, discount, known, totals, kinds = self.levels[order - 1]
        at = np.minimum(np.searchsorted(known, contexts), max(len(known) - 1, 0))
        seen = known[at] == contexts
        return np.where(seen, discount * kinds[at] / totals[at], 1.0)

    def chance(self, order: int, grams: np.ndarray) -> np.ndarray:
        if order == 0:
            return np.full(len(grams), 1.0 / self.symbols)
        keys, counts, discount, known, totals, _ = self.levels[order - 1]
        lower = self.chance(order - 1, grams & U64((1 << (16 * (order - 1))) - 1))
        contexts = grams >> U64(16)
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        count = np.where(keys[at] == grams, counts[at], 0)
        place = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
        total = np.where(known[place] == contexts, totals[place], np.inf)
        return np.maximum(count - discount, 0) / total + self.backoff(order, contexts) * lower


@dataclass
class LanguageModel:
    """Bounded by the fitting sample; shipped to tasks."""

    languages: list[str] = field(default_factory=list)
    letters: np.ndarray | None = None  # sorted code points; letter k has id k + 1, others the last id
    grams: list[Grams] = field(default_factory=list)  # by order from 1
    weights: list[Grams] = field(default_factory=list)  # back-off by context, by order from 1
    platt: tuple[float, float] = (0.0, 1.0)
    limits: np.ndarray | None = None  # by language: median, spread of texts, spread of letters

    def ids(self, codes: np.ndarray) -> np.ndarray:
        table = getattr(self, "_table", None)
        if table is None:
            table = np.full(0x110000, len(self.letters) + 1, np.uint16)
            table[0] = 0
            table[self.letters] = np.arange(1, len(self.letters) + 1)
            self._table = table
        return table[codes]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per letter by text and language, positions, letters) of every text."""
        codes, firsts, owner = letter_codes(texts)
        ids = self.ids(codes)
        sums, count, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts))
        if not len(owner):
            return sums, count, letters
        begin, end = firsts[:-1] + ORDER - 1, firsts[1:]
        for low, logs in self._chunks(ids):
            totals = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
            here = slice(np.searchsorted(end, low, "right"), np.searchsorted(begin, low + len(logs), "left"))
            upto = np.clip(end[here] - low, 0, len(logs))
            sums[owner[here]] += totals[upto] - totals[np.clip(begin[here] - low, 0, upto)]
        count[owner] = end - begin
        real = np.concatenate([[0], np.cumsum(codes != 0)])
        letters[owner] = real[end] - real[begin]
        return -sums / np.maximum(count, 1)[:, None], count, letters

    def _chunks(self, ids: np.ndarray):
        """(first position, log probabilities by language) of stretches of positions, each with what stands before it."""
        for low in range(0, len(ids), CHUNK):
            before = min(low, ORDER - 1)
            yield low, self._logs(ids[low - before : low + CHUNK])[before:]

    def _logs(self, ids: np.ndarray) -> np.ndarray:
        row, found = self.grams[-1].find(_keys(ids, ORDER))
        logs = self.grams[-1].values[row]
        rest = np.flatnonzero(~found)
        logs[rest] = 0
        full = _keys(ids, ORDER)[rest]
        for order in range(ORDER - 1, 0, -1):
            if not len(rest):
                break
            context, known = self.weights[order].find(full >> U64(16))
            logs[rest[known]] += self.weights[order].values[context[known]]
            full = full & U64((1 << (16 * order)) - 1)
            row, found = self.grams[order - 1].find(full)
            logs[rest[found]] += self.grams[order - 1].values[row[found]]
            rest, full = rest[~found], full[~found]
        return logs

    def limit(self, language: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Highest cross-entropy accepted of a text of ``count`` positions."""
        middle, text, letter = self.limits[language].T
        return middle + np.sqrt(text**2 + letter**2 / np.maximum(count, 1))

    def predict(self, texts: list[str]):
        """(language, score, rejected, cross-entropy) of every text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool), np.zeros(len(texts))
        entropy, count, letters = self.entropies(texts)
        best = entropy.argmin(1)
        lowest = entropy[np.arange(len(texts)), best]
        score = 1 / (1 + np.exp(-np.clip(self.platt[0] + self.platt[1] * _margin(entropy, count), -50, 50)))
        none = letters == 0
        rejected = none | (lowest > self.limit(best, count))
        return [UNKNOWN if n else self.languages[b] for b, n in zip(best, none)], np.where(none, 0.0, score), rejected, lowest


def _margin(entropy: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Lead of the best over the second language, by the root of the length."""
    if entropy.shape[1] < 2:
        return np.sqrt(count)
    two = np.partition(entropy, 1, axis=1)
    return (two[:, 1] - two[:, 0]) * np.sqrt(count)


def _platt(margin: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """Logistic fit with smoothed targets and a weak pull to (0, 1)."""
    good = right.sum()
    target = np.where(right, (good + 1) / (good + 2), 1 / (len(right) - good + 2))
    x, w = np.stack([np.ones_like(margin), margin], 1), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (target - p) - 0.1 * (w - [0.0, 1.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w = w + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return float(w[0]), float(max(w[1], 1e-3))


def fit_languages(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = FIT_TEXTS) -> LanguageModel:
    """Fit on at most ``texts`` labelled texts per language, those of smallest id hash.

    Rows with null text, null language, or not ``usable`` teach nothing. Without any, the model knows
    no language and calls every text unknown.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(usable) if usable is not None else docs
    rows = rows.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        "text is not null and lang is not null"
    )
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    near = (F.col("h").cast("double") / F.lit(2.0**64) + 0.5) * F.col("n") <= 2 * texts + 50
    sample = rows.join(F.broadcast(counts) if counts.count() <= 10_000 else counts, "lang").where(near)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = stored(sample.withColumn("rank", rank).where(F.col("rank") <= texts).select("lang", "rank", "text"), "language-sample")

    counting = sample.where("rank % 5 != 0")
    alphabet = counting.mapInArrow(_code_points, "code int").distinct().collect()
    letters = np.array(sorted(r.code for r in alphabet), np.int64)[:65_000]
    model = LanguageModel(letters=letters)
    sums = counting.mapInArrow(_gram_counts(model), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    langs = np.array(table["lang"].to_pylist(), object)
    grams, n = table["gram"].to_numpy().view(U64), table["n"].to_numpy()
    models = []
    for lang in sorted(set(langs)):
        own = np.flatnonzero(langs == lang)
        own = own[np.argsort(grams[own])]
        model.languages.append(lang)
        models.append(KneserNey(grams[own], n[own], len(letters) + 2))
    if models:
        for order in range(1, ORDER + 1):
            seen = np.unique(np.concatenate([m.levels[order - 1][0] for m in models]))
            if order == 1:
                seen = np.arange(len(letters) + 2, dtype=U64)
            model.grams.append(Grams(seen, np.log(np.stack([m.chance(order, seen) for m in models], 1))))
            after = np.unique(np.concatenate([m.levels[order - 1][3] for m in models]))
            model.weights.append(Grams(after, np.log(np.stack([m.backoff(order, after) for m in models], 1))))
        _calibrate(model, sample.where("rank % 5 = 0").select("lang", "text").toArrow())
    return model


def _calibrate(model: LanguageModel, sample: pa.Table) -> None:
    # without any calibration text, a text must only be likelier than a blind guess
    model.limits = np.tile([np.log(len(model.letters) + 2), 0.0, 0.0], (len(model.languages), 1))
    if not sample.num_rows:
        return
    labels, texts = np.array(sample["lang"].to_pylist(), object), sample["text"].to_pylist()
    entropy, count, letters = model.entropies(texts)
    used = letters > 0
    right = np.array([model.languages[b] == lang for b, lang in zip(entropy.argmin(1), labels)])
    if not used.any():
        return
    model.platt = _platt(_margin(entropy, count)[used], right[used])
    own = [np.flatnonzero(used & (labels == lang)) for lang in model.languages]
    middles = [np.median(entropy[rows, k]) if len(rows) else None for k, rows in enumerate(own)]
    highest = max(m for m in middles if m is not None)
    above = [entropy[rows, k] - (middles[k] if len(rows) else 0) for k, rows in enumerate(own)]
    stretches = [_stretches(model, k, [texts[x] for x in rows]) for k, rows in enumerate(own)]
    over, length = np.concatenate(above), count[np.concatenate(own)]
    for k, rows in enumerate(own):  # languages with few texts take the deviations of all together
        pool = [k] if len(rows) >= LIMIT_TEXTS else range(len(own))
        values = np.concatenate([stretches[x] for x in pool])
        letter = REJECT_SPREADS * np.sqrt(STRETCH) * _spread(values) if len(values) else 0.0
        # texts that mix languages are rare, so their quantile is that of all languages
        beyond = np.sqrt(np.maximum(np.maximum(over, 0) ** 2 - letter**2 / length, 0))
        text = _spread(np.concatenate([above[x] for x in pool]))
        model.limits[k] = middles[k] if len(rows) else highest, max(np.quantile(beyond, REJECT_QUANTILE) + text, REJECT_SPREADS * text), letter


def _spread(values: np.ndarray) -> float:
    """Standard deviation as the upper half without its outliers has it."""
    middle, upper = np.quantile(values, [0.5, 0.9])
    return float(upper - middle) / 1.2816


def _stretches(model: LanguageModel, k: int, texts: list[str]) -> np.ndarray:
    """Cross-entropies of short stretches of each whole text under language ``k``, less the text's own."""
    out = [np.zeros(0)]
    for text in filter(None, texts):
        parts = [logs[:, k] for _, logs in model._chunks(model.ids(letter_codes([text])[0]))]
        logs = -np.concatenate(parts)[ORDER - 1 :].astype(np.float64)
        whole = logs[: len(logs) // STRETCH * STRETCH]
        if len(whole):
            out.append(whole.reshape(-1, STRETCH).mean(1) - logs.mean())
    return np.concatenate(out)


def _code_points(batches):
    for piece in pieces(batches, "text"):
        codes = letter_codes(piece.column(piece.schema.get_field_index("text")).to_pylist())[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(codes[codes != 0]).astype(np.int32))], ["code"])


def _gram_counts(model: LanguageModel):
    def count(batches):
        for piece in pieces(batches, "text"):
            langs = piece.column(piece.schema.get_field_index("lang")).to_pylist()
            texts = piece.column(piece.schema.get_field_index("text")).to_pylist()
            for lang in sorted(set(langs)):
                codes, firsts, _ = letter_codes([t for t, x in zip(texts, langs) if x == lang])
                real = np.ones(len(codes), bool)
                for k in range(ORDER - 1):
                    real[firsts[:-1] + k] = False
                found, n = np.unique(_keys(model.ids(codes), ORDER)[real], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    return count


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, rejected, cross_entropy) of every row, from the text alone.

    A null text or one without letters is "und" with score 0 and rejected. Ties go to the first
    language by name. Other columns are ignored; repeated rows are judged each. A text is scored as one
    sequence however long it is.
    """

    def predict(batches):
        for piece in pieces(batches, "text", 1 << 18):
            found = model.predict([t or "" for t in piece.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, found)], ["id", "lang_pred", "score", "rejected", "cross_entropy"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = f"id {slim.schema['id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean, cross_entropy double"
    return slim.mapInArrow(predict, kind).withColumnRenamed("id", id_col)


def known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text the model does not reject."""

    def keep(batches):
        for piece in pieces(batches, text_col, 1 << 18):
            texts = piece.column(piece.schema.get_field_index(text_col)).to_pylist()
            yield piece.filter(pa.array(~model.predict([t or "" for t in texts])[2]))

    return docs.mapInArrow(keep, docs.schema)
