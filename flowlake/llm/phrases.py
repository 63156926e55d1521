"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over 8 bytes triggers a phrase wherever it is least among some 50 neighbouring places, so
phrases depend on nearby bytes alone, equal strings are parsed alike, and any 100 bytes hold a trigger whose
next 51 bytes, its anchor, are inside them too. The surroundings of a trigger, all bytes that a string of
100 bytes with this anchor can reach, are an entry of the dictionary; the texts' triggers in
turn are the parse. Two orders then say which strings came before:

* The parse is sorted by entry. Strings at an entry's later occurrences came before, all at once, however
  often a text was copied; those at its first occurrence have come before only from another entry.
* The dictionary, each entry once, at its first occurrence, and only entries whose anchor another entry
  shares, is sorted by its suffixes, cut to 100 bytes. Equal ones stand side by side, the first in corpus
  order is new.

Sorting goes by 96-bit hashes instead of bytes, spread over buckets by their leading bits: only equality counts here.
Texts are dealt into blocks by id, so that a block's number says where its strings stand in the corpus;
inside a block places say it. Hashes travel packed and once a block, answers are one bit each.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import BLOCK_BYTES, bucket_count
from flowlake.llm.components import stored
from flowlake.llm.tasks import tidy
from flowlake.llm.words import U64, bucket_of, column_bytes, mix, pack, unpack

#: Bytes under the rolling hash, and bytes parsed at once.
ROLLING, PART = 8, 1 << 19
ANCHOR, PARSE, RIVALS, SUFFIX = range(4)
SENT = "kind int, bucket int, block int, first binary, second binary, third binary"
ANSWER = "block int, kind int, bucket int, bits binary"
FACTOR = {1: U64(0x9FB21C651E98DF25), 2: U64(0xD1342543DE82EF95)}


def _reach(values, width: int, pick):
    """``pick`` (minimum or maximum) over each ``width`` neighbours, from the first of them."""
    have, out, count = 1, values, len(values) - width + 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[:count], out[width - have : width - have + count]) if have < width else out


class _Runs:
    """Sorted distinct keys of some places: the groups, and the earliest place of each."""

    def __init__(self, first: np.ndarray, second: np.ndarray | None, rank: np.ndarray):
        keys = (rank, first) if second is None else (rank, second, first)
        self.order = np.lexsort(keys)
        one = first[self.order]
        differ = np.diff(one) != 0
        if second is not None:
            two = second[self.order]
            differ |= np.diff(two) != 0
        self.starts = np.flatnonzero(np.concatenate([[True], differ])) if len(one) else np.zeros(0, int)
        self.sizes = np.diff(np.append(self.starts, len(one)))
        self.first = one[self.starts]
        self.second = None if second is None else two[self.starts]
        self.rank = rank

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each group, given to each of its places."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, self.sizes)
        return out

    def later(self) -> np.ndarray:
        """Whether a place has an earlier one in its group."""
        least = self.rank[self.order[self.starts]] if len(self.order) else self.rank
        return self.rank > self.spread(least)


class _Block:
    """Texts of one block, their bytes and triggers."""

    def __init__(self, table: pa.Table, size: int):
        self.size, self.stretch = size, size // 2
        self.anchor = size - self.stretch + 1
        self.ids = table["id"].combine_chunks()
        data, offsets = column_bytes(table["text"])
        self.offsets, self.bytes = offsets, data
        self.padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.load = np.ndarray((len(data) + 1,), "<u8", self.padded, strides=(1,))
        order = np.lexsort((np.asarray(table["tie"].combine_chunks()), np.asarray(self.ids)))
        differ = [np.diff(np.asarray(c.combine_chunks())[order]) != 0 for c in (table["tie"], table["id"])]
        turn = np.empty(len(order), np.int64)
        turn[order] = np.concatenate([[0], np.cumsum(differ[0] | differ[1])]) if len(order) else turn
        self.turn = turn  # equal for rows that agree in id and text
        at = self.triggers()
        self.text = np.searchsorted(offsets, at, "right") - 1
        room = at + self.anchor <= offsets[1:][self.text]
        self.at, self.text = at[room], self.text[room]
        self.low, self.high = offsets[:-1][self.text], offsets[1:][self.text]
        self.rank = self.ranks(self.at, self.text)

    def ranks(self, at, text):
        """Corpus order of places inside the block."""
        return (self.turn[text] << 32) + at - self.offsets[:-1][text]

    def triggers(self) -> np.ndarray:
        """Places whose rolling hash is least in some stretch that lies in one text."""
        count, width = len(self.bytes), self.stretch
        sizes = np.diff(self.offsets)
        edge = np.zeros(count + 1, np.int8)
        ends = self.offsets[1:]
        np.add.at(edge, np.where(sizes >= self.size, ends - (width + ROLLING - 2), self.offsets[:-1]), 1)
        np.add.at(edge, ends, -1)
        closed, found = np.cumsum(edge, dtype=np.int8)[:count] > 0, []
        for low in range(0, count, PART):
            high = min(low + PART, count)
            start, stop = max(0, low - width + 1), min(count, high + width)
            hashed = self.load[start:stop] * U64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> U64(29)
            hashed *= U64(0xBF58476D1CE4E5B9)
            values = (hashed >> U64(32)).astype(np.uint32) | np.uint32(1)
            if len(values) < width:
                continue
            least = _reach(values, width, np.minimum)
            least[closed[start : start + len(least)]] = 0
            spread = np.zeros(len(values) + width - 1, np.uint32)
            spread[width - 1 : width - 1 + len(least)] = least
            most = _reach(spread, width, np.maximum)
            found.append(np.flatnonzero(most[low - start : high - start] == values[low - start : high - start]) + low)
        return np.concatenate(found) if found else np.zeros(0, int)

    def hashes(self, at, steps, low=None, high=None, salt=None):
        """Two hashes of the bytes that lie ``steps`` after each place, 8 at a time."""
        one = np.full(len(at), 0x243F6A8885A308D3, U64)
        two = np.full(len(at), 0x13198A2E03707344, U64)
        if salt is not None:
            one, two = one ^ mix(salt), two + mix(~salt)
        for step in steps:
            place = at + step
            if low is not None:
                place = np.clip(place, low, high - 8)
            word = self.load[place]
            one = (one ^ word) * FACTOR[1]
            one ^= one >> U64(32)
            two = (two + word) * FACTOR[2]
            two ^= two >> U64(29)
        return mix(one), (mix(two) >> U64(32)).astype(np.uint32)

    def anchors(self) -> _Runs:
        steps = [*range(0, self.anchor - 8, 8), self.anchor - 8]
        return _Runs(self.hashes(self.at, steps)[0], None, self.rank)

    def parse(self, chosen) -> _Runs:
        """Entries of the chosen triggers: hashes of their surroundings, cut where the text ends."""
        at, low, high = self.at[chosen], self.low[chosen], self.high[chosen]
        before = np.minimum(at - low, self.stretch - 1)
        after = np.minimum(high - at, self.size)
        steps = [*range(1 - self.stretch, self.size - 8, 8), self.size - 8]
        salt = (before * 65536 + after).astype(U64)
        return _Runs(*self.hashes(at, steps, low, high, salt), self.rank[chosen])

    def reached(self, chosen) -> np.ndarray:
        """Whether a string starts at a place that holds the anchor of a chosen trigger."""
        low = np.maximum(self.at[chosen] - self.stretch + 1, self.low[chosen])
        high = np.minimum(self.at[chosen], self.high[chosen] - self.size)
        edge = np.zeros(len(self.bytes) + 2, np.int32)
        real = high >= low
        np.add.at(edge, low[real], 1)
        np.add.at(edge, high[real] + 1, -1)
        return np.cumsum(edge)[: len(self.bytes)] > 0

    def suffixes(self, starts: np.ndarray) -> _Runs:
        steps = [*range(0, self.size - 8, 8), self.size - 8]
        text = np.searchsorted(self.offsets, starts, "right") - 1
        return _Runs(*self.hashes(starts, steps), self.ranks(starts, text))


def _sent(kind: int, block: int, buckets: int, first, *others) -> pa.Table:
    """One row for each bucket of sorted hashes."""
    of = bucket_of(first, buckets)
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0])) if len(of) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(of))
    packed = [[x[a:b].tobytes() for a, b in zip(cuts, ends)] for x in (first, *others)]
    packed += [[None] * len(cuts)] * (3 - len(packed))
    whole = lambda x: pa.array(np.full(len(cuts), x), pa.int32())
    names = ["kind", "bucket", "block", "first", "second", "third"]
    return pa.table([whole(kind), pa.array(of[cuts], pa.int32()), whole(block), *(pa.array(x, pa.binary()) for x in packed)], names)


def _answered(table: pa.Table) -> pa.Table:
    """What a bucket tells each block about each of its hashes, in one bit.

    Anchors: another block has it. Parse and dictionary: an earlier block has it. Rivals: the blocks'
    entries of an anchor are not all the same.
    """
    kind = table["kind"][0].as_py()
    firsts = table["first"].to_pylist()
    counts = np.array([len(x) // 8 for x in firsts])
    flat = lambda column, of: np.frombuffer(b"".join(table[column].to_pylist()), of)
    first = np.frombuffer(b"".join(firsts), U64)
    block = np.repeat(np.asarray(table["block"].combine_chunks()), counts)
    if kind in (PARSE, SUFFIX):
        runs = _Runs(first, flat("second", np.uint32), block)
        flags = runs.later()
    else:
        runs = _Runs(first, None, block)
        flags = runs.spread(runs.sizes > 1)
        if kind == RIVALS:
            least, most = (flat(c, U64)[runs.order] for c in ("second", "third"))
            rivals = np.minimum.reduceat(least, runs.starts) != np.maximum.reduceat(most, runs.starts)
            flags = runs.spread(rivals)
    ends = np.cumsum(counts)
    return pa.table({
        "block": table["block"].combine_chunks(), "kind": table["kind"].combine_chunks(), "bucket": table["bucket"].combine_chunks(),
        "bits": pa.array([pack(flags[e - n : e]) for e, n in zip(ends, counts)], pa.binary()),
    })


def _bits(answers: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits for sorted hashes, as their buckets sent them back."""
    if not len(keys):
        return np.zeros(0, bool)
    bits = {b: x for b, k, x in zip(*(answers[c].to_pylist() for c in ("bucket", "kind", "bits"))) if k == kind}
    found, counts = np.unique(bucket_of(keys, buckets), return_counts=True)
    return np.concatenate([unpack(bits[int(b)], int(n)) for b, n in zip(found, counts)])


class _Steps:
    """What a block works out from the answers it has; each step repeats the ones before."""

    def __init__(self, table: pa.Table, size: int, buckets: int, answers: pa.Table | None = None):
        self.block, self.buckets, self.answers = _Block(table, size), buckets, answers
        self.anchors = self.block.anchors()

    def bits(self, kind, keys):
        return _bits(self.answers, kind, keys, self.buckets)

    def entries(self):
        """Triggers whose anchor occurs again, and their entries."""
        again = self.bits(ANCHOR, self.anchors.first) | (self.anchors.sizes > 1)
        self.chosen = np.flatnonzero(self.anchors.spread(again))
        self.parse = self.block.parse(self.chosen)
        keys = np.empty(len(self.anchors.order), U64)
        keys[self.anchors.order] = np.repeat(self.anchors.first, self.anchors.sizes)
        self.rivals = _Runs(keys[self.chosen], None, self.block.rank[self.chosen])
        entry = self.parse.spread(self.parse.first)[self.rivals.order]
        ends = (np.minimum.reduceat, np.maximum.reduceat)
        self.least, self.most = (f(entry, self.rivals.starts) if len(entry) else entry for f in ends)

    def dictionary(self):
        """Strings that came before by the parse, and those that the dictionary has to tell."""
        self.entries()
        earlier = self.parse.spread(self.bits(PARSE, self.parse.first)) | self.parse.later()
        rival = self.rivals.spread(self.bits(RIVALS, self.rivals.first) | (self.least != self.most))
        self.known = self.block.reached(self.chosen[earlier])
        asked = self.block.reached(self.chosen[rival & ~earlier]) & ~self.known
        self.starts = np.flatnonzero(asked)
        self.suffixes = self.block.suffixes(self.starts)

    def repeated(self) -> np.ndarray:
        """Where a string starts that came before."""
        self.dictionary()
        earlier = self.suffixes.spread(self.bits(SUFFIX, self.suffixes.first)) | self.suffixes.later()
        self.known[self.starts[earlier]] = True
        return self.known


def phrase_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Remove each byte covered by a string of ``size`` bytes that also starts earlier in the corpus.

    Texts are UTF-8 bytes in the order of their ids; earlier is a smaller id, or a smaller place in the
    same text. Strings are judged on the input, overlaps count, and none crosses texts. Returns id_col,
    n_bytes, n_removed, n_spans (removed stretches of the text that nothing kept parts) and kept (the
    remaining bytes, binary, as a cut may part a character), one row per row of ``docs``; other columns are ignored.

    Null and empty texts have no bytes; texts shorter than ``size`` stay as they are. A row with a
    null id is neither changed nor a source. Rows that share an id stand in the order of their texts'
    hashes, and rows that share id and text count as one text. A text longer than a block makes its block longer.
    An empty table gives no rows.
    """
    if not 40 <= size <= 4096:
        raise ValueError("strings have 40 to 4096 bytes")
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets, blocks = bucket_count(2 * total // (size // 2)), max(24, -(-total // block_bytes))
    name = f"flowlake_phrases_{uuid.uuid4().hex}"
    dealt = slim.where("id is not null").withColumn("tie", F.xxhash64("text")).repartitionByRange(blocks, "id", "tie")
    tables = min(blocks, 20_000)
    dealt.withColumn("block", F.spark_partition_id()).write.bucketBy(tables, "block").option("compression", "zstd").saveAsTable(
        name, format="parquet"
    )
    groups = spark.table(name).groupBy("block")

    def anchors(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        steps = _Steps(part, size, buckets)
        return _sent(ANCHOR, key[0].as_py(), buckets, steps.anchors.first)

    def entries(key: tuple[pa.Scalar, ...], part: pa.Table, answers: pa.Table) -> pa.Table:
        steps, block = _Steps(part, size, buckets, answers), key[0].as_py()
        steps.entries()
        parse, rivals = steps.parse, steps.rivals
        return pa.concat_tables([
            _sent(PARSE, block, buckets, parse.first, parse.second),
            _sent(RIVALS, block, buckets, rivals.first, steps.least, steps.most),
        ])

    def suffixes(key: tuple[pa.Scalar, ...], part: pa.Table, answers: pa.Table) -> pa.Table:
        steps = _Steps(part, size, buckets, answers)
        steps.dictionary()
        return _sent(SUFFIX, key[0].as_py(), buckets, steps.suffixes.first, steps.suffixes.second)

    def apply(key: tuple[pa.Scalar, ...], part: pa.Table, answers: pa.Table) -> pa.Table:
        steps = _Steps(part, size, buckets, answers)
        block, starts = steps.block, np.flatnonzero(steps.repeated())
        edge = np.zeros(len(block.bytes) + 1, np.int32)
        edge[starts] += 1
        edge[starts + size] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = block.offsets[:-1][np.diff(block.offsets) > 0]
        opens[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(opens)])
        count = lambda x: pa.array(np.diff(x[block.offsets]), pa.int64())
        bounds = (block.offsets - before[block.offsets]).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(block.bytes[~gone].tobytes())])
        out = pa.table([block.ids, pa.array(np.diff(block.offsets)), count(before), count(spans), kept], ["id", "n_bytes", "n_removed", "n_spans", "kept"])
        tidy()
        return out

    def answered(sent: DataFrame, known: DataFrame | None, stage: str) -> DataFrame:
        told = sent.groupBy("kind", "bucket").applyInArrow(_answered, ANSWER)
        told = stored(told, f"phrases-{stage}")
        return told if known is None else known.union(told)

    known = answered(groups.applyInArrow(anchors, SENT), None, "anchors")
    for step, stage in ((entries, "parse"), (suffixes, "dictionary")):
        known = answered(groups.cogroup(known.groupBy("block")).applyInArrow(step, SENT), known, stage)
    done = groups.cogroup(known.groupBy("block")).applyInArrow(apply, RESULT)
    done = stored(done, "phrases-kept")
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    size_of = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    loose = slim.where("id is null").select(
        "id", size_of.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept"),
    )
    return done.union(loose).withColumnRenamed("id", id_col)


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
