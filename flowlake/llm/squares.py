"""Periodic runs by catching squares over completed power-of-two blocks of words.

Words of a text are appended one after the other. Every block of L = 8, 16, 32, ... words that is complete
becomes a catcher: with each further word the L words that end there are compared with the catcher's, as
hashes of L words that are put together from those of L / 2. A catcher watches the words up to 2 L after
its start, the smallest also those that overlap it. A match at distance q is a square, the block and its
repetition. Squares of one distance at neighbouring blocks merge, and comparing words to the left
and right of them gives the run. All appends of a batch of texts happen together, one size after the
other, so a task does a few array operations a size.

A run of smallest period q and at least max(24, 3 q) words holds a whole block of its size in its first
2 q words (in its first 15 for q below 8), so none is missed; a multiple of the period gives the same
run again and falls away as the larger one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.tasks import pieces, small_batches
from flowlake.llm.words import U64, mix, split_words, word_array

SMALLEST = 8
LEAST_WORDS, LEAST_PERIODS = 24, 3
PRIME = (1 << 61) - 1
STEP = 0x1B873593CC9E2D51 % PRIME
RUNS = "array<struct<start: long, length: long, period: long>>"


def _times(a, b):
    """Products modulo 2**61 - 1."""
    low, half = U64((1 << 31) - 1), U64(31)
    au, ad, bu, bd = a >> half, a & low, b >> half, b & low
    middle = ad * bu + au * bd
    total = au * bu * U64(2) + (middle >> U64(30)) + ((middle & U64((1 << 30) - 1)) << half) + ad * bd
    return _reduced(total)


def _reduced(x):
    x = (x & U64(PRIME)) + (x >> U64(61))
    return np.where(x >= U64(PRIME), x - U64(PRIME), x)


class _Prefixes:
    """Sums of word values times powers, so that equal stretches are told in one step."""

    def __init__(self, ids: np.ndarray):
        count = len(ids)
        self.power = np.ones(count + 1, U64)
        have, step = 1, STEP
        while have <= count:
            upto = min(2 * have, count + 1)
            self.power[have:upto] = _times(self.power[: upto - have], U64(step))
            have, step = 2 * have, step * step % PRIME
        terms = _times(_reduced(mix(ids.astype(U64) + U64(0x632BE59BD9B4E019))), self.power[:count])
        high = np.concatenate([np.zeros(1, U64), np.cumsum(terms >> U64(32), dtype=U64)])
        low = np.concatenate([np.zeros(1, U64), np.cumsum(terms & U64((1 << 32) - 1), dtype=U64)])
        self.sum = _reduced(_times(_reduced(high), U64(1 << 32)) + _reduced(low))

    def same(self, at, apart, length):
        """Whether ``length`` words from ``at`` equal those ``apart`` further on."""
        between = lambda i: _reduced(self.sum[i + length] + U64(PRIME) - self.sum[i])
        return _times(between(at), self.power[apart]) == between(at + apart)

    def stretch(self, at, apart, limit, back: bool):
        """Words from ``at`` on (``back``: before it) that equal those ``apart`` further, up to ``limit``."""
        found, step = np.zeros_like(at), 1
        while step <= limit.max(initial=0):
            step *= 2
        while step:
            longer = found + step
            fits = np.flatnonzero(longer <= limit)
            start = at[fits] - longer[fits] if back else at[fits] + found[fits]
            good = fits[self.same(start, apart[fits], np.full(len(fits), step))]
            found[good] += step
            step //= 2
        return found


def _squares(ids: np.ndarray, first: np.ndarray):
    """(block start, distance, block size) of every square that a catcher sees, size by size."""
    counts = np.diff(first)
    place = np.arange(len(ids)) - np.repeat(first[:-1], counts)
    at, of = np.arange(len(ids)), np.repeat(counts, counts)
    keys, size = mix(ids.astype(U64) + U64(0x9E3779B97F4A7C15)), 1
    while len(keys):
        if size >= SMALLEST:
            whole = place + size <= of
            into = place & (size - 1)
            for apart in (into, into + size) if size == SMALLEST else (into + size,):
                ends = np.flatnonzero(whole & (apart > 0) & (apart <= place))
                ends = ends[keys[ends] == keys[ends - apart[ends]]]
                if len(ends):
                    yield at[ends] - apart[ends], apart[ends], size
        longer = max(LEAST_WORDS, LEAST_PERIODS * 2 * size)
        stay = of >= longer
        joined = keys * U64(0xD6E8FEB86659FD93)
        joined[:-size] += keys[size:] if size < len(keys) else U64(0)
        keys = mix(joined)
        if not stay.all():
            keys, place, at, of = keys[stay], place[stay], at[stay], of[stay]
        size *= 2


def find_runs(ids: np.ndarray, first: np.ndarray):
    """(start, end, period) of all runs, by start and period; text d has words first[d] to first[d + 1].

    A run has at least max(24, 3 periods) words, its period is the smallest one, and no neighbouring word
    of its text extends it.
    """
    prefixes, found = None, []
    for start, apart, size in _squares(ids, first):
        order = np.lexsort((start, apart))
        start, apart = start[order], apart[order]
        text = np.searchsorted(first, start, "right")
        joins = (np.diff(start) == size) & (np.diff(apart) == 0) & (np.diff(text) == 0)
        heads = np.flatnonzero(np.concatenate([[True], ~joins]))
        tails = np.append(heads[1:], len(start)) - 1
        low, high, apart, text = start[heads], start[tails] + size, apart[heads], text[heads]
        prefixes = prefixes or _Prefixes(ids)
        sure = prefixes.same(low, apart, high - low)
        low, high, apart, text = low[sure], high[sure], apart[sure], text[sure]
        # A whole further block of equal words would have been a square of its own.
        high = high + prefixes.stretch(high, apart, np.minimum(size, first[text] - apart - high), False)
        low = low - prefixes.stretch(low, apart, np.minimum(size, low - first[text - 1]), True)
        end = high + apart
        enough = end - low >= np.maximum(LEAST_WORDS, LEAST_PERIODS * apart)
        found.append(np.stack([low, end, apart], 1)[enough])
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.zeros(len(runs), bool)
    again[1:] = (np.diff(runs[:, 0]) == 0) & (np.diff(runs[:, 1]) == 0)
    runs = runs[~again]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of repeated words in every text, and the text with each run cut to its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they stand. A run is a stretch of words with smallest
    period q and at least max(24, 3 q) words that no neighbouring word extends. Returns id_col, n_words,
    runs (start, length and period in words, by start and period) and text (words that no run holds after
    its first q words, joined by one space), one row per row of ``docs``.

    Null and empty texts have no words, no runs and an empty text. Ids play no part, so null and repeated
    ones are rows like others; other columns are ignored, whatever their names. A text is worked on whole
    however long it is; a task holds one long text or about 1 MB of short ones, in memory proportional to
    their words. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def catch(batches):
        for piece in pieces(batches, "text"):
            words = split_words(piece.column(1))
            spelled = word_array(words)
            ids = spelled.dictionary_encode().indices.to_numpy()
            runs = find_runs(ids, words.first)
            edge = np.zeros(len(ids) + 1, np.int32)
            np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edge, runs[:, 1], -1)
            keep = np.cumsum(edge)[: len(ids)] == 0
            left = np.concatenate([[0], np.cumsum(keep)])[words.first]
            kept = pa.ListArray.from_arrays(left.astype(np.int32), spelled if keep.all() else spelled.filter(pa.array(keep)))
            per_text = np.searchsorted(runs[:, 0], words.first)
            origin = words.first[np.searchsorted(words.first, runs[:, 0], "right") - 1]
            listed = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - origin), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                ["start", "length", "period"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), listed),
                    pc.binary_join(kept, " "),
                ],
                ["id", "n_words", "runs", "text"],
            )

    kind = dict(slim.dtypes)["id"]
    done = slim.mapInArrow(catch, f"id {kind}, n_words long, runs {RUNS}, text string")
    return done.withColumnRenamed("id", id_col)
