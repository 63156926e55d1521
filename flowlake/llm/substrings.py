"""Substring dedup by difference-cover anchors.

Positions of a text modulo 7 that lie in {0, 1, 3} form a difference cover: for any two offsets some
shift below 7 brings both onto the cover. So two equal windows of 13 words always share an anchor of
7 words at the same place inside the window, though only 3 of 7 positions are hashed. Windows around
an anchor that other texts share are the extensions of that match; they are compared by 128-bit hashes
and each learns whether its words also start in a text with a smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import bucket_count, text_blocks
from flowlake.llm.components import stored
from flowlake.llm.words import U64, bucket_of, grams, pack, split_words, unpack

#: Cover of the differences modulo the period.
PERIOD, COVER = 7, (0, 1, 3)
PACKED = "bucket int, block int, first binary, second binary, ids binary"
ANSWER = "block int, bucket int, kind int, bits binary"


def _owners(order, keys_differ, values):
    """Smallest value of each run of equal keys, in sorted order, and where the runs start."""
    starts = np.flatnonzero(np.concatenate([[True], keys_differ])) if len(order) else np.zeros(0, int)
    return starts, np.minimum.reduceat(values[order], starts) if len(order) else values[:0]


class _Block:
    """Anchors and windows of one block of texts."""

    def __init__(self, table: pa.Table, window: int):
        self.window, self.anchor = window, window - PERIOD + 1
        self.ids = table["id"].combine_chunks()
        ids = self.ids
        self.known = ~np.asarray(ids.is_null())
        self.id = np.asarray(ids.fill_null(0)).astype(np.int64)
        self.words = w = split_words(table["text"])
        self.text_of = w.text_of
        left = w.left
        place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], w.counts)
        usable = self.known[self.text_of]
        on = np.isin(place % PERIOD, COVER) & (left >= self.anchor) & usable
        self.at = np.flatnonzero(on)
        self.key = grams(w.hash, self.anchor)[self.at]
        self.order = np.argsort(self.key, kind="stable")
        self.starts, self.owner = _owners(self.order, np.diff(self.key[self.order]) != 0, self.id[self.text_of[self.at]])
        self.whole = (left >= window) & usable

    def anchors(self):
        return self.key[self.order][self.starts]

    def windows(self, shared: np.ndarray):
        """Sorted distinct windows around shared anchors, and where each stands."""
        sorted_id = self.id[self.text_of[self.at[self.order]]]
        many = np.maximum.reduceat(sorted_id, self.starts) > self.owner if len(self.order) else shared
        flags = np.zeros(len(self.words.hash) + PERIOD + 1, np.int32)
        runs = np.diff(np.append(self.starts, len(self.order)))
        flags[self.at[self.order[np.repeat(shared | many, runs)]] + 1] = 1
        near = np.cumsum(flags)
        count = len(self.words.hash)
        found = np.flatnonzero((near[PERIOD : count + PERIOD] > near[:count]) & self.whole)
        first = grams(self.words.hash, self.window)[found]
        second = grams(self.words.hash, self.window, salt=0x5851F42D4C957F2D)[found]
        order = np.lexsort((second, first))
        differ = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
        starts, owner = _owners(order, differ, self.id[self.text_of[found]])
        return found, order, starts, owner, first[order][starts], second[order][starts]


def _rows(block: int, buckets: int, first, second=None, ids=None):
    """One row per hash bucket of sorted distinct hashes."""
    of = bucket_of(first, buckets)
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0])) if len(of) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(of))
    part = lambda x: [None if x is None else x[a:b].tobytes() for a, b in zip(cuts, ends)]
    binary = pa.binary()
    return pa.table({
        "bucket": pa.array(of[cuts], pa.int32()),
        "block": pa.array(np.full(len(cuts), block), pa.int32()),
        "first": pa.array(part(first), binary),
        "second": pa.array(part(second), binary),
        "ids": pa.array(part(ids), binary),
    })


def _joined(column, kind):
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


def _answers(table: pa.Table, flags: np.ndarray, kind: int):
    counts = np.array([len(x.as_py()) // 8 for x in table["first"]], int)
    ends = np.cumsum(counts)
    return pa.table({
        "block": table["block"].combine_chunks(),
        "bucket": table["bucket"].combine_chunks(),
        "kind": pa.array(np.full(len(counts), kind), pa.int32()),
        "bits": pa.array([pack(flags[e - n : e]) for e, n in zip(ends, counts)], pa.binary()),
    })


def _shared(table: pa.Table) -> pa.Table:
    """Which hashes of a bucket occur in several blocks."""
    key = _joined(table["first"], U64)
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    flags = np.zeros(len(key), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return _answers(table, flags, 0)


def _earlier(table: pa.Table) -> pa.Table:
    """Which windows of a bucket have a text with a smaller id in another block."""
    first, second = _joined(table["first"], U64), _joined(table["second"], U64)
    ids = _joined(table["ids"], np.int64)
    order = np.lexsort((second, first))
    differ = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    starts, owner = _owners(order, differ, ids)
    flags = np.zeros(len(ids), bool)
    flags[order] = np.repeat(owner, np.diff(np.append(starts, len(order)))) < ids[order]
    return _answers(table, flags, 1)


def _flags(answers: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits for sorted distinct hashes, as their buckets sent them back."""
    if not len(keys):
        return np.zeros(0, bool)
    bits = {b: x for b, k, x in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "bits"))) if k == kind}
    found, counts = np.unique(bucket_of(keys, buckets), return_counts=True)
    return np.concatenate([unpack(bits[int(b)], int(n)) for b, n in zip(found, counts)])


def _kept(words, keep: np.ndarray):
    """Kept words of each text joined by one space, as an Arrow column."""
    at = np.flatnonzero(keep)
    sizes = words.end[at] - words.start[at] + 1  # a space after each
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    source = np.arange(total) + np.repeat(words.start[at] - (ends - sizes), sizes)
    source[ends - 1] = 0
    out = words.data[source] if total else np.zeros(0, np.uint8)
    out[ends - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(keep)])[words.first]  # kept words before each text
    offsets = np.concatenate([[0], ends])[kept]
    last = offsets[1:][np.diff(kept) > 0] - 1  # the space after a text's last word
    stay = np.ones(total, bool)
    stay[last] = False
    offsets = offsets - np.concatenate([[0], np.cumsum(np.diff(kept) > 0)])
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[stay].tobytes())
    )


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """Remove every word inside a window of ``window`` words that also starts in a text with a smaller id.

    Returns id_col, n_words, n_removed and text (the kept words joined by one space), one row per
    row of ``docs``; other columns are ignored, whatever their names. Null and empty texts have no
    words and an empty result. A row with a null id is neither changed nor a source. Rows that share an
    id count as one text for the comparison. Windows are judged on the input.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table, _, size = text_blocks(slim, "text", ["id"])
    buckets = bucket_count(size // 12)  # about 0.43 anchors a word
    groups = table.groupBy("block")

    def anchors(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        return _rows(key[0].as_py(), buckets, _Block(part, window).anchors())

    sent = groups.applyInArrow(anchors, PACKED)
    shared = stored(sent.groupBy("bucket").applyInArrow(_shared, ANSWER), "shared-anchors")

    def windows(key: tuple[pa.Scalar, ...], part: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(part, window)
        _, _, _, owner, first, second = block.windows(_flags(answers, 0, block.anchors(), buckets))
        return _rows(key[0].as_py(), buckets, first, second, owner)

    sent = groups.cogroup(shared.groupBy("block")).applyInArrow(windows, PACKED)
    earlier = sent.groupBy("bucket").applyInArrow(_earlier, ANSWER)

    def apply(key: tuple[pa.Scalar, ...], part: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(part, window)
        found, order, starts, owner, first, _ = block.windows(_flags(answers, 0, block.anchors(), buckets))
        before = _flags(answers, 1, first, buckets)
        runs = np.diff(np.append(starts, len(order)))
        again = np.zeros(len(order), bool)
        again[order] = np.repeat(before, runs) | (block.id[block.text_of[found[order]]] > np.repeat(owner, runs))
        words = block.words
        edge = np.zeros(len(words.hash) + window + 1, np.int32)
        np.add.at(edge, found[again], 1)
        np.add.at(edge, found[again] + window, -1)
        gone = np.cumsum(edge)[: len(words.hash)] > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
        return pa.table({
            "id": block.ids,
            "n_words": pa.array(words.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "text": _kept(words, ~gone).cast(pa.string()),
        })

    answers = shared.union(earlier)
    done = groups.cogroup(answers.groupBy("block")).applyInArrow(apply, "id long, n_words long, n_removed long, text string")
    return done.withColumnRenamed("id", id_col)
