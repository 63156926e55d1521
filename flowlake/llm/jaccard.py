"""N-gram Jaccard join by signature trees.

Texts of equal shingle sets are one class. Classes whose min-hashes agree in some band fall into one
forest, so that every pair at the threshold meets in a forest (it is missed with a chance below one in
a million). A forest is a signature tree: its nodes are chunks of sets of similar size, and below them
groups down to single sets; each holds the OR of its sets' bitmaps, the range of their sizes, and the
most shingles a bitmap hides. The dual traversal visits pairs of nodes, skips those whose sizes or
common bits rule the threshold out or whose sets are linked already, and verifies pairs of sets exactly.

Large forests are spread over tasks by pairs of chunks: first every chunk with itself and with the first
one, which joins a crowd of near copies in linear work, then what is left outside the largest class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.components import components, stored
from flowlake.llm.tasks import pieces, small_batches, tidy
from flowlake.llm.words import BASE, U64, mix, split_words

#: Rows of a band, and the accepted chance to miss a pair just at the threshold.
ROWS, MISS = 5, 1e-6
#: Sets in a chunk, in a leaf, and children of a node.
CHUNK, LEAF, FAN = 96, 4, 4
#: Up to so many ids may be broadcast to pick the texts of the forests; beyond it they are joined by shuffle.
BROADCAST_IDS = 1_000_000
SKETCH = "id long, n long, d1 long, d2 long, bands binary"
SETS = "id long, n long, shingles binary"


def shingle_sets(column, size: int):
    """Distinct shingle hashes of every text, sorted within it: (hashes, firsts).

    A text with fewer words than ``size`` is one shingle of all its words; one without words has none.
    """
    words = split_words(column, lower=True)
    left, text_of = words.left, words.text_of
    total, own = np.zeros(len(words.hash), U64), np.zeros(len(words.hash), U64)
    for k in range(size):  # words past the end of the text add nothing
        n = len(total) - k
        if n <= 0:
            break
        own[:n] = words.hash[k:]
        total = total * U64(BASE) + np.where(left > k, own, U64(0))
    place = np.arange(len(total)) - np.repeat(words.first[:-1], words.counts)
    take = (left >= size) | (place == 0)
    hashes, text_of = mix(total[take]), text_of[take]
    order = np.lexsort((hashes, text_of))
    hashes, text_of = hashes[order], text_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (np.diff(hashes) != 0) | (np.diff(text_of) != 0)
    return hashes[new], np.searchsorted(text_of[new], np.arange(len(words.first)))


def band_count(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _sketch(size: int, bands: int):
    random = np.random.default_rng(13)
    flips = random.integers(0, 2**32, bands * ROWS, dtype=np.uint32)
    factors = random.integers(0, 2**32, bands * ROWS, dtype=np.uint32) | np.uint32(1)

    def sketch(batches):
        for piece in pieces(batches, "text", 1 << 20):
            hashes, firsts = shingle_sets(piece.column(1), size)
            counts = np.diff(firsts)
            full = np.flatnonzero(counts)
            at = firsts[:-1][full]
            n = len(counts)
            d1, d2 = np.zeros(n, U64), np.zeros(n, U64)
            keys = np.zeros((n, bands), U64)
            if len(full):
                d1[full] = np.add.reduceat(mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5)), at)
                d2[full] = np.add.reduceat(mix(hashes ^ U64(0x0F0F0F0F0F0F0F0F)), at)
                short = (hashes >> U64(32)).astype(np.uint32)
                for band in range(bands):
                    key = np.full(len(full), band + 1, U64)
                    for k in range(band * ROWS, band * ROWS + ROWS):
                        key = key * U64(BASE) + np.minimum.reduceat((short ^ flips[k]) * factors[k], at).astype(U64)
                    keys[full, band] = mix(key)
            packed = [row.tobytes() if c else b"" for row, c in zip(keys, counts)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(counts), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(packed, pa.binary())],
                ["id", "n", "d1", "d2", "bands"],
            )

    return sketch


def _keys(batches):
    """One row per class and band."""
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            keys = np.frombuffer(b"".join(x.as_py() for x in part.column(1)), np.int64).reshape(len(part), -1)
            ids = np.repeat(np.asarray(part.column(0)), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "id"])


def _sets(size: int):
    def sets(batches):
        for piece in pieces(batches, "text", 1 << 20):
            hashes, firsts = shingle_sets(piece.column(1), size)
            packed = [hashes[a:b].tobytes() for a, b in zip(firsts, firsts[1:])]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(firsts)), pa.array(packed, pa.binary())], ["id", "n", "shingles"])

    return sets


class Node:
    """A part of a signature tree over sets[low:high]."""

    __slots__ = ("children", "hidden", "high", "largest", "low", "ored", "smallest")

    def __init__(self, forest: Forest, low: int, high: int):
        self.low, self.high, self.children = low, high, []
        if high - low > LEAF:
            step = -(-(high - low) // FAN)
            self.children = [Node(forest, a, min(a + step, high)) for a in range(low, high, step)]
        self.ored = np.bitwise_or.reduce(forest.bits[low:high], axis=0)
        self.smallest, self.largest = int(forest.sizes[low:high].min()), int(forest.sizes[low:high].max())
        self.hidden = int(forest.hidden[low:high].max())


class Forest:
    """Sets that meet in one task, ordered by size, with the links found so far."""

    def __init__(self, ids, sizes, sets, percent: int):
        self.ids, self.sizes, self.sets, self.percent = ids, sizes, sets, percent
        width = 1 << max(10, min(17, int(sizes.max() * 8 - 1).bit_length()))
        self.bits = np.zeros((len(ids), width // 64), U64)
        for k, own in enumerate(sets):
            place = own & U64(width - 1)
            np.bitwise_or.at(self.bits[k], (place >> U64(6)).astype(np.int64), U64(1) << (place & U64(63)))
        self.hidden = sizes - np.bitwise_count(self.bits).sum(1).astype(np.int64)
        self.parent = list(range(len(ids)))
        self.links: list[tuple[int, int]] = []

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def linked(self, a: Node, b: Node) -> bool:
        root = self.find(a.low)
        return all(self.find(k) == root for n in (a, b) for k in range(n.low, n.high))

    def possible(self, a: Node, b: Node) -> bool:
        """Whether sets of the two nodes may reach the threshold, by sizes and by common bits."""
        if a.largest * 100 < self.percent * b.smallest or b.largest * 100 < self.percent * a.smallest:
            return False
        most = int(np.bitwise_count(a.ored & b.ored).sum()) + min(a.hidden, b.hidden)
        return most * (100 + self.percent) >= self.percent * (a.smallest + b.smallest)

    def within(self, node: Node) -> None:
        if not node.children:
            for a in range(node.low, node.high):
                for b in range(a + 1, node.high):
                    self.verify(a, b)
        for k, child in enumerate(node.children):
            self.within(child)
            for other in node.children[:k]:
                self.across(other, child)

    def across(self, a: Node, b: Node) -> None:
        if not self.possible(a, b) or self.linked(a, b):
            return
        if a.children and (not b.children or a.high - a.low >= b.high - b.low):
            for child in a.children:
                self.across(child, b)
        elif b.children:
            for child in b.children:
                self.across(a, child)
        else:
            for x in range(a.low, a.high):
                for y in range(b.low, b.high):
                    self.verify(x, y)

    def verify(self, x: int, y: int) -> None:
        roots = self.find(x), self.find(y)
        if roots[0] == roots[1]:
            return
        a, b = self.sets[x], self.sets[y]
        if min(len(a), len(b)) * 100 < self.percent * max(len(a), len(b)):
            return
        common = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
        if common * (100 + self.percent) >= self.percent * (len(a) + len(b)):
            self.parent[max(roots)] = min(roots)
            self.links.append((int(self.ids[x]), int(self.ids[y])))


def _traverse(percent: int):
    def traverse(table: pa.Table) -> pa.Table:
        group = np.stack([np.asarray(table[c]) for c in ("n", "chunk", "j", "i", "forest")])
        order = np.lexsort(group)
        starts = (np.diff(group[2:, order]) != 0).any(0)
        cuts = np.flatnonzero(np.concatenate([[True], starts, [True]]))
        ids, sizes, packed, chunk = np.asarray(table["id"]), np.asarray(table["n"]), table["shingles"].combine_chunks(), group[1]
        links = []
        for low, high in zip(cuts, cuts[1:]):
            rows = order[low:high]
            sets = [np.frombuffer(packed[int(r)].as_buffer(), U64) for r in rows]
            forest = Forest(ids[rows], sizes[rows], sets, percent)
            first = int(np.count_nonzero(chunk[rows] == chunk[rows[0]]))
            if first == len(rows):
                forest.within(Node(forest, 0, first))
            else:
                forest.across(Node(forest, 0, first), Node(forest, first, len(rows)))
            links += forest.links
        tidy()
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return traverse


def jaccard_classes(docs: DataFrame, shingle: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) of every row of ``docs``.

    A text's set holds the hashes of its distinct runs of ``shingle`` words, A-Z lower-cased; with fewer
    words, the whole text as one; without words or text it is empty. Two texts link when
    100 * common >= percent * union; empty sets link with nothing. component_id is the smallest id
    reachable by links, the own id without any. A null id links with nothing and has a null
    component. Rows that repeat an id are one text with all their sets. Other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    sketch = stored(slim.mapInArrow(_sketch(shingle, band_count(percent)), SKETCH), "sketch")
    usable = sketch.where("n > 0 and id is not null")
    classes = stored(usable.groupBy("n", "d1", "d2").agg(F.min("id").alias("id"), F.min("bands").alias("bands")), "classes")

    # Classes that share a band join the forest of the band's smallest id.
    keyed = classes.select("id", "bands").mapInArrow(_keys, "key long, id long")
    heads = stored(keyed.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("k")).where("k > 1").select("key", "head"), "band-heads")
    meet = keyed.join(heads, "key").where("id != head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    forests = stored(components(meet).withColumnRenamed("component", "forest"), "forests")
    links = _links(slim, classes, forests, shingle, percent)
    joined = components(links)

    placed = classes.select("n", "d1", "d2", "id").join(joined, "id", "left")
    placed = stored(placed.select("n", "d1", "d2", F.coalesce("component", "id").alias("component")), "class-components")
    done = sketch.select("id", "n", "d1", "d2").join(placed, ["n", "d1", "d2"], "left")
    return done.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def _links(slim: DataFrame, classes: DataFrame, forests: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links that connect the classes of every forest."""
    sized = stored(forests.join(classes.select("id", "n"), "id"), "forest-sizes")
    # Chunks by size: place in the order of sizes, by counts per size, without ordering the forest's sets.
    counts = sized.groupBy("forest", "n").agg(F.count("*").alias("k"))
    before = F.sum("k").over(Window.partitionBy("forest").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)) - F.col("k")
    counts = stored(counts.withColumn("before", before), "size-counts")
    chunk = F.floor((F.col("before") + F.pmod(F.xxhash64("id"), "k")) / CHUNK).cast("int")
    chunked = stored(sized.join(counts, ["forest", "n"]).select("id", "forest", chunk.alias("chunk")), "chunks")
    wanted = F.broadcast(chunked) if chunked.count() <= BROADCAST_IDS else chunked
    texts = slim.join(wanted.select("id"), "id", "left_semi")
    sets = texts.mapInArrow(_sets(shingle), SETS)
    # A repeated id may bring several sets; each of them is a class of that id.
    sets = stored(sets.join(wanted, "id").select("id", "n", "shingles", "forest", "chunk"), "sets")

    chunks = stored(chunked.groupBy("forest").agg(F.max("chunk").alias("last")), "forest-chunks")
    wide = sets.join(chunks, "forest")
    own = wide.select("*", F.col("chunk").alias("i"), F.col("chunk").alias("j"))
    first = wide.where("chunk = 0 and last > 0").select("*", F.lit(0).alias("i"), F.explode(F.sequence(F.lit(1), "last")).alias("j"))
    rest = wide.where("chunk > 0").select("*", F.lit(0).alias("i"), F.col("chunk").alias("j"))
    links = _pairs(own.unionByName(first).unionByName(rest), percent)
    links = stored(links, "first-links")

    # Chunks with sets outside their forest's largest class meet the others they may link with.
    large = chunks.where("last > 1").select("forest")
    if large.isEmpty():
        return links
    part = sized.join(large, "forest", "left_semi").join(chunked.select("id", "chunk"), "id")
    part = stored(part.join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id")), "forest-classes")
    most = part.groupBy("forest", "component").count().groupBy("forest").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    nodes = part.join(most, "forest").groupBy("forest", "chunk").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max((F.col("component") != F.col("main")).cast("int")).alias("odd"),
    )
    nodes = stored(nodes, "chunk-nodes")
    a, b = nodes.where("odd = 1 and chunk > 0").alias("a"), nodes.where("chunk > 0").alias("b")
    fits = f"a.forest = b.forest and a.chunk != b.chunk and a.high * 100 >= {percent} * b.low and b.high * 100 >= {percent} * a.low"
    pairs = a.join(b, F.expr(fits)).select(
        F.col("a.forest").alias("forest"), F.least("a.chunk", "b.chunk").alias("i"), F.greatest("a.chunk", "b.chunk").alias("j")
    ).distinct()
    pairs = stored(pairs, "chunk-pairs")
    sides = pairs.withColumn("chunk", F.explode(F.array("i", "j")))
    return links.union(_pairs(sets.join(sides, ["forest", "chunk"]), percent))


def _pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Run the traversal of every (forest, i, j); many small forests share a task."""
    tasks = max(192, -(-placed.select("id").count() // 1000))
    dealt = placed.select("forest", "i", "j", "chunk", "id", "n", "shingles").withColumn("task", F.pmod(F.xxhash64("forest", "i", "j"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(_traverse(percent), "a long, b long")
