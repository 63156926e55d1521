"""Benchmark decontamination by spaced seeds.

A mask picks six of eight word positions. Every benchmark position and every training position is
hashed under each mask; equal hashes propose an alignment of an item and a text, and the alignment is
verified word by word: 13 consecutive positions of which at most two differ. The masks are chosen so
that every placing of two differing words in 13 positions leaves one of them untouched somewhere. An item of
8 to 12 words may have one word replaced: three masks as long as the item leave out every third word, and
one of them leaves out the replaced one. Shorter items must occur whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.tasks import pieces, small_batches
from flowlake.llm.words import U64, mix, split_words

MASKS = ("11101011", "11001111")
WINDOW, MAY_DIFFER = 13, 2
#: Least words of an item below WINDOW of which one may be replaced.
ONE_MAY_DIFFER = 8
#: Items with fewer words are no evidence by themselves, unless asked for, and match nothing.
MIN_WORDS = 5
#: Proposed alignments handled at once.
PROPOSALS = 1 << 21
#: Benchmark words looked up in one pass; a larger benchmark takes several passes over the texts.
BLOCK_WORDS = 1 << 21
FILTER_BITS = 22
FOUND = "doc_id long, item_id long, n_matched long, n_window long, doc_start long, item_start long"


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the picked words at each position where the mask fits."""
    count = len(hashes) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.full(count, len(mask), U64)
    for k, taken in enumerate(mask):
        if taken == "1":
            total *= U64(0x9E3779B97F4A7C15)
            total += hashes[k : k + count]
    return mix(total)


def tolerance(words: int) -> tuple[int, int]:
    """(window, words in it that may differ) of an item of so many words."""
    if words >= WINDOW:
        return WINDOW, MAY_DIFFER
    return words, int(words >= ONE_MAY_DIFFER)


def masks_of(words: int) -> tuple[str, ...]:
    """Masks under which an item of so many words is looked up."""
    if words >= WINDOW:
        return MASKS
    if words < ONE_MAY_DIFFER:
        return ("1" * words,)
    return tuple("".join("0" if k % 3 == r else "1" for k in range(words)) for r in range(3))


class Items:
    """Distinct texts of one block of a benchmark and their seeds, sorted; shipped to tasks."""

    def __init__(self, ids: list[int], texts: list[str], min_words: int = MIN_WORDS):
        distinct: dict[bytes, list[int]] = {}
        words = split_words(pa.array(texts, pa.string()), lower=True)
        for k, item in enumerate(ids):
            own = words.hash[words.first[k] : words.first[k + 1]]
            if len(own) >= max(1, min_words):
                distinct.setdefault(own.tobytes(), []).append(item)
        self.ids = [sorted(x) for x in distinct.values()]
        self.words = [np.frombuffer(x, U64) for x in distinct]
        sizes = {min(len(w), WINDOW) for w in self.words}
        self.masks = [mask for n in sorted(sizes, reverse=True) for mask in masks_of(n)]
        self.tables = [self._table(m) for m in self.masks]

    def _table(self, mask: str):
        keys, owner, place = [np.zeros(0, U64)], [np.zeros(0, int)], [np.zeros(0, int)]
        for k, own in enumerate(self.words):
            if mask in masks_of(len(own)):
                found = seeds(own, mask)
                keys.append(found)
                owner.append(np.full(len(found), k))
                place.append(np.arange(len(found)))
        keys, owner, place = map(np.concatenate, (keys, owner, place))
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[keys >> U64(64 - FILTER_BITS)] = True
        return keys[order], owner[order], place[order], seen

    def matches(self, words):
        """(text, item text, matched, window, first word in the text, in the item): the best of each pair."""
        best: dict[tuple[int, int], tuple] = {}
        text_of, left = words.text_of, words.left
        tried = set()
        for mask, (keys, owner, place, seen) in zip(self.masks, self.tables):
            own = seeds(words.hash, mask)
            at = np.flatnonzero(seen[own >> U64(64 - FILTER_BITS)] & (left[: len(own)] >= len(mask)))
            low = np.searchsorted(keys, own[at], "left")
            runs = np.searchsorted(keys, own[at], "right") - low
            at, low, runs = at[runs > 0], low[runs > 0], runs[runs > 0]
            ends = np.cumsum(runs)
            cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, PROPOSALS))
            cuts = np.unique(np.append(cuts, len(at)))
            for a, b in zip(cuts, cuts[1:]):  # a seed that repeats proposes many, so a part at a time
                many = runs[a:b]
                hit = np.repeat(low[a:b], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                texts, starts = np.repeat(text_of[at[a:b]], many), np.repeat(at[a:b], many)
                pair, shift = texts * len(self.words) + owner[hit], starts - words.first[texts] - place[hit]
                order = np.lexsort((shift, pair))
                pair, shift = pair[order], shift[order]
                once = np.ones(len(pair), bool)
                once[1:] = (np.diff(pair) != 0) | (np.diff(shift) != 0)
                for (text, item), move in zip((divmod(x, len(self.words)) for x in pair[once].tolist()), shift[once].tolist()):
                    if (text, item, move) in tried:
                        continue
                    tried.add((text, item, move))
                    if found := self._verified(words.hash[words.first[text] : words.first[text + 1]], self.words[item], move):
                        kept = best.get((text, item))
                        if kept is None or (-found[0], *found[2:]) < (-kept[0], *kept[2:]):
                            best[text, item] = found
        return [(t, i, *found) for (t, i), found in sorted(best.items())]

    @staticmethod
    def _verified(text: np.ndarray, item: np.ndarray, shift: int):
        low, high = max(0, -shift), min(len(item), len(text) - shift)
        size, allowed = tolerance(len(item))
        if high - low < size:
            return None
        same = np.concatenate([[0], np.cumsum(item[low:high] == text[low + shift : high + shift])])
        matched = same[size:] - same[:-size]
        k = int(np.argmax(matched))
        return (int(matched[k]), size, low + k + shift, low + k) if matched[k] >= size - allowed else None


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, min_words: int = MIN_WORDS) -> list[Items]:
    """The benchmark in blocks of about BLOCK_WORDS words, each small enough to ship to every task."""
    small_batches(benchmark.sparkSession)
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_WORDS))
    out = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        out.append(Items([r.id for r in rows], [r.text for r in rows], min_words))
    return [x for x in out if x.ids]


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per text and benchmark item that it holds: (doc_id, item_id, n_matched, n_window, doc_start, item_start).

    Words are runs of non-space with A-Z lower-cased. Held means: some 13 consecutive words of the
    item are found at one place of the text with at most two of them replaced; an item of 8 to 12 words
    is found with at most one replaced, a shorter one whole. The row describes the window with most matches, the first in the text, then
    in the item, of several. Null and empty texts, and items that are null, without an id or under ``min_words``
    words match nothing (1 looks up every word); a null doc_id stays null; items of equal text are all reported; repeated rows are reported
    again; a text of any length is searched whole; other columns are ignored. A larger benchmark is looked up in blocks, one pass each.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = [slim.mapInArrow(_finder(x), FOUND) for x in benchmark_blocks(benchmark, item_col, item_text, min_words)]
    if not parts:
        return slim.sparkSession.createDataFrame([], FOUND)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _finder(items: Items):
    def find(batches):
        for piece in pieces(batches, "text"):
            rows = [
                (piece.column(0)[text].as_py(), item, *found)
                for text, k, *found in items.matches(split_words(piece.column(1), lower=True))
                for item in items.ids[k]
            ]
            if rows:
                names = [x.split()[0] for x in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return find


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Rows of ``docs``, all columns, whose text holds no benchmark item (see ``contamination``)."""
    for items in benchmark_blocks(benchmark, item_col, item_text, min_words):

        def clean(batches, items=items):
            for piece in pieces(batches, text_col):
                words = split_words(piece.column(piece.schema.get_field_index(text_col)), lower=True)
                keep = np.ones(len(piece), bool)
                keep[[text for text, *_ in items.matches(words)]] = False
                yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
