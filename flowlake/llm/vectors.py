"""Near-duplicate vectors by sorted projection passes.

In every pass a vector gets the signs of its products with BITS seeded random directions, and all vectors
are sorted by these signs, written one after another. A vector is compared with the neighbours that follow
it: WINDOW of them at least, and as many as share its leading signs. Vectors of equal leading signs are a
run; a run of more than RUN vectors is not put into a window but compared block against block, in tasks of
its own. So all pairs of a run meet, and a pair at the threshold agrees in one sign with a chance that the
angle gives: for any number of leading signs follows how many passes leave it apart with a chance of at
most MISS; a closer pair is missed with far less. The number of leading signs is the cheapest by the run
sizes measured on the table. Windows reach over the borders of partitions.

Equal vectors are one class and take part once. Pairs that reach the threshold link, and links of all
passes together give the components. A link never leaves its component, so the links of a class are then
counted inside its component, in blocks. Every comparison decides a pair alike: products within rounding
of the threshold are added up again in one fixed order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.components import components, stored

SEED = 5
#: Chance that no pass brings a pair exactly at the threshold together.
MISS = 1e-6
#: Signs that vectors are sorted by, those a run may share, and passes in which run sizes are measured.
BITS, MAX_SIGNS, PROBES = 60, 24, 3
#: Following neighbours that every vector is compared with, whatever their signs.
WINDOW = 32
#: Most vectors of a run that a window covers; larger runs are compared in blocks of as many.
RUN = 2048
#: Vectors compared with their windows at once.
CHUNK = 256
#: Cost of sending a vector to a task, in comparisons of two vectors.
SEND = 1000
#: Vectors of one component compared in one task with as many others.
BLOCK = 256
VECTORS = "vec_id long, dim int, vector binary"


def _usable(batches):
    """Unit vectors, as doubles, of the rows that can link with others."""
    for batch in batches:
        ids, rows, sizes = [], [], []
        for vec_id, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if vec_id is None or not values or None in values:
                continue
            vector = np.array(values, np.float64)
            top = np.abs(vector).max()
            if not np.isfinite(vector).all() or top == 0:
                continue
            vector /= top  # neither overflows nor vanishes when squared
            ids.append(vec_id)
            sizes.append(len(vector))
            rows.append((vector / np.linalg.norm(vector)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(rows, pa.binary())], ["vec_id", "dim", "vector"])


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(-1, dim)


def _by_dim(table):
    """(row numbers, dim) of the vectors of each length, in order."""
    dims = np.asarray(table["dim"] if isinstance(table, pa.Table) else table.column(table.schema.get_field_index("dim")))
    return [(np.flatnonzero(dims == d), int(d)) for d in np.unique(dims)]


def _signs(vectors: np.ndarray, passes: int, signs: int, salt: int = 0) -> np.ndarray:
    """Signs of every vector (rows) in every pass (columns) as one number, the first sign leading."""
    dim = vectors.shape[1]
    keys = np.zeros((len(vectors), passes), np.int64)
    for turn in range(passes if signs else 0):
        directions = np.random.default_rng([SEED, salt, turn, dim]).standard_normal((dim, signs))
        keys[:, turn] = (vectors @ directions > 0) @ (1 << np.arange(signs, dtype=np.int64)[::-1])
    return keys


def _run_sizes(passes: int, signs: int, salt: int = 0):
    """(dim, turn, key, n) of the runs of a batch; key are the leading signs."""

    def sizes(batches):
        for batch in batches:
            for rows, dim in _by_dim(batch):
                keys = _signs(_matrix(batch.column(2).take(pa.array(rows)), dim), passes, BITS, salt) >> (BITS - signs)
                for turn in range(passes):
                    key, n = np.unique(keys[:, turn], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), dim), pa.int32()), pa.array(np.full(len(key), turn), pa.int32()), pa.array(key), pa.array(n)],
                        ["dim", "turn", "key", "n"],
                    )

    return sizes


SIZES = "dim int, turn int, key long, n long"


def passes_needed(threshold: float, signs: int, miss: float = MISS) -> float:
    """Passes of so many signs after which a pair at the threshold is missed with a chance of ``miss``."""
    agree = 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi
    together = agree**signs
    if together >= 1:
        return 1
    return float(np.ceil(np.log(miss) / np.log1p(-together))) if together > 0 else np.inf


def plan_passes(usable: DataFrame, rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(passes, signs) of least cost, by the run sizes that each number of signs has in a few passes."""
    found = usable.mapInArrow(_run_sizes(PROBES, MAX_SIGNS, 1), SIZES).groupBy("dim", "turn", "key").agg(F.sum("n").alias("n"))
    cut = found.withColumn("signs", F.explode(F.array(*map(F.lit, range(MAX_SIGNS + 1)))))
    cut = cut.groupBy("dim", "turn", "signs", F.expr(f"shiftright(key, {MAX_SIGNS} - signs)").alias("key")).agg(F.sum("n").alias("n"))
    blocks = F.ceil(F.col("n") / RUN)
    # a run in blocks sends each vector once a block; both sides of a pair of blocks are compared
    cost = (F.col("n") * blocks * SEND + F.col("n").cast("double") * F.col("n") / 2) / PROBES
    costs = {r.signs: r.cost for r in cut.groupBy("signs").agg(F.sum(cost).alias("cost")).collect()}
    least = max(0, int(np.ceil(np.log2(max(rows, 1) / RUN))))  # no plan whose work is all pairs of a large table
    fit = [k for k in costs if k >= least and np.isfinite(passes_needed(threshold, k, miss))] or [0]
    signs = min(fit, key=lambda k: (passes_needed(threshold, k, miss) * costs.get(k, 0), k))
    return int(passes_needed(threshold, signs, miss)), signs


def _project(passes: int, signs: int):
    def project(batches):
        for batch in batches:
            for rows, dim in _by_dim(batch):
                part = batch.take(pa.array(rows))
                order = _signs(_matrix(part.column(2), dim), passes, BITS)
                for turn in range(passes):
                    bits = np.ascontiguousarray(order[:, turn])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), turn), pa.int32()), pa.array(bits >> (BITS - signs)), pa.array(bits), *part.columns[:3]],
                        ["turn", "key", "bits", "vec_id", "dim", "vector"],
                    )

    return project


def _near(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit vectors (left by right) reach the threshold, the same for a pair wherever it is met."""
    products = left @ right.T
    close = np.abs(products - threshold) <= 8 * left.shape[1] * np.finfo(np.float64).eps
    near = products >= threshold
    if close.any():
        a, b = np.nonzero(close)
        for at in range(0, len(a), 4096):
            rows, others = a[at : at + 4096], b[at : at + 4096]
            near[rows, others] = np.ascontiguousarray(left[rows] * right[others]).sum(1) >= threshold
    return near


def _reached(near: np.ndarray):
    """(first, other) rows of the components of a symmetric matrix of links, without single rows."""
    todo = near.any(1)
    while todo.any():
        first = int(todo.argmax())
        seen = np.zeros(len(near), bool)
        seen[first] = True
        edge = np.array([first])
        while len(edge):
            fresh = near[edge].any(0) & ~seen
            seen |= fresh
            edge = np.flatnonzero(fresh)
        todo &= ~seen
        seen[first] = False
        yield first, np.flatnonzero(seen)


def _connected(near: np.ndarray, ids: np.ndarray, others: np.ndarray):
    """Links that connect what ``near`` (ids by others) links: at most one a row and one a column."""
    rows = np.flatnonzero(near.any(1))
    if not len(rows):
        return
    near, ids = near[rows], ids[rows]
    columns = np.flatnonzero(near.any(0))
    a, b = [ids[near[:, columns].argmax(0)]], [others[columns]]
    shared = near.astype(np.float32)
    for first, rest in _reached(shared @ shared.T > 0):
        a.append(np.full(len(rest), ids[first]))
        b.append(ids[rest])
    yield np.concatenate(a), np.concatenate(b)


def _window_rows(a=None, b=None, border=None, head=None, part: pa.Table | None = None) -> pa.RecordBatch:
    """Links, or rows that stand at a border of partitions."""
    count = len(a) if part is None else len(part)
    empty = lambda kind: pa.nulls(count, kind)
    if part is None:
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), empty(pa.int32()), empty(pa.bool_()), *map(empty, BORDER_TYPES)]
    else:
        rows = [part[c].combine_chunks() for c in ("turn", "dim", "vec_id", "vector")]
        rows = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in rows]
        columns = [empty(pa.int64()), empty(pa.int64()), pa.array(np.full(count, border), pa.int32()), pa.array(np.full(count, head)), *rows]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "border", "head", "turn", "dim", "vec_id", "vector"])


BORDER_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
WINDOWED = "a long, b long, border int, head boolean, turn int, dim int, vec_id long, vector binary"


def _windows(threshold: float):
    """Links of each vector with the neighbours in its window; rows come sorted by pass, length and signs.
    The first and last WINDOW rows are sent on, so that windows reach into the next partition. Runs that
    come in blocks stand between them, group by group."""

    def links(table: pa.Table, last: bool):
        """Links of the rows whose windows are whole, and how many rows these are."""
        count = len(table)
        ids, key = np.asarray(table["vec_id"]), np.stack([np.asarray(table[c]) for c in ("turn", "dim", "key")])
        series = np.concatenate([[0], np.cumsum((np.diff(key[:2]) != 0).any(0))])
        run = np.concatenate([[0], np.cumsum((np.diff(key) != 0).any(0))])
        reach = np.arange(count) + 1 + WINDOW
        reach = np.maximum(reach, np.searchsorted(run, run, "right"))
        reach = np.minimum(reach, np.searchsorted(series, series, "right"))  # never into another pass or length
        done = count if last else max(0, count - RUN - WINDOW)
        out = []
        for at in range(0, done, CHUNK):
            upto = min(at + CHUNK, done)
            for one in np.unique(series[at:upto]):
                rows = at + np.flatnonzero(series[at:upto] == one)
                a, b = int(rows[0]), int(reach[rows].max())
                vectors = _matrix(table["vector"].slice(a, b - a), table["dim"][a].as_py())
                near = _near(vectors[: len(rows)], vectors, threshold)
                place = np.arange(a, b)
                near &= (place > rows[:, None]) & (place < reach[rows][:, None])
                out += _connected(near, ids[rows], ids[a:b])
        return out, done

    def windows(batches):
        part = TaskContext.get().partitionId()
        head, held, size, blocked = 0, [], 0, []

        def windowed(last: bool):
            nonlocal held, size
            table = pa.Table.from_batches(held).combine_chunks()
            found, done = links(table, last)
            held = table.slice(done).to_batches()
            size = len(table) - done
            for a, b in found:
                yield _window_rows(a, b)

        def compared():
            nonlocal blocked
            table = pa.Table.from_batches([x for _, x in blocked])
            blocked = []
            for a, b in _block_links(table, threshold):
                yield _window_rows(a, b)

        for batch in batches:
            blocks = np.asarray(batch.column(batch.schema.get_field_index("blocks"))) if len(batch) else np.zeros(0)
            group = np.stack([np.asarray(batch.column(batch.schema.get_field_index(c))) for c in GROUP]) if len(batch) else np.zeros((len(GROUP), 0))
            turns = (np.diff(blocks > 1) != 0) | ((np.diff(group) != 0).any(0) & (blocks[1:] > 1))
            cuts = np.unique([0, *(np.flatnonzero(turns) + 1).tolist(), len(batch)]).tolist()
            for a, b in zip(cuts, cuts[1:]):
                rows, key = batch.slice(a, b - a), group[:, a].tolist()
                if blocked and (blocks[a] == 1 or blocked[0][0] != key):
                    yield from compared()
                if blocks[a] > 1:
                    if size:
                        yield from windowed(True)
                    blocked.append((key, rows))
                    continue
                if head < WINDOW:
                    first = rows.slice(0, WINDOW - head)
                    head += len(first)
                    yield _window_rows(border=part, head=True, part=pa.Table.from_batches([first]))
                held.append(rows)
                size += len(rows)
                if size > 4 * (RUN + WINDOW):
                    yield from windowed(False)
        if blocked:
            yield from compared()
        if size:
            tail = pa.Table.from_batches(held).combine_chunks()
            yield from windowed(True)
            yield _window_rows(border=part + 1, head=False, part=tail.slice(max(0, len(tail) - WINDOW)).combine_chunks())

    return windows


def _across(threshold: float):
    """Links of the last rows of a partition with the first ones of the next, in the same pass and length."""

    def across(table: pa.Table) -> pa.Table:
        head, ids = np.asarray(table["head"]), np.asarray(table["vec_id"])
        found = []
        if head.any() and not head.all():
            vectors = _matrix(table["vector"], table["dim"][0].as_py())
            found = list(_connected(_near(vectors[~head], vectors[head], threshold), ids[~head], ids[head]))
        a, b = zip(*found) if found else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return across


def _block_links(table: pa.Table, threshold: float):
    """What all pairs of two blocks of a run connect. Each component is sent as a star: all links are
    counted later, so a crowd need not send each of them."""
    ids, own = np.asarray(table["vec_id"]), np.asarray(table["own"])
    vectors = _matrix(table["vector"], table["dim"][0].as_py())
    near = np.zeros((len(ids), len(ids)), bool)
    mine, others = np.flatnonzero(own == table["lo"][0].as_py()), np.flatnonzero(own == table["hi"][0].as_py())
    for at in range(0, len(mine), 512):
        rows = mine[at : at + 512]
        near[np.ix_(rows, others)] = _near(vectors[rows], vectors[others], threshold)
    np.fill_diagonal(near, False)
    near |= near.T
    for first, rest in _reached(near):
        yield np.full(len(rest), ids[first]), ids[rest]


#: What one comparison of blocks is about: a run, and two blocks of it. Runs in windows have block 0 only.
GROUP = ("turn", "dim", "key", "lo", "hi")


def _count(threshold: float):
    """Links of the classes on the left side of each block pair with the vectors of those on its right side."""

    def count(table: pa.Table) -> pa.Table:
        out_ids, out_links = [], []
        table = table.combine_chunks()
        group = np.stack([np.asarray(table[c]) for c in ("component", "i", "j")])
        order = np.lexsort(group)
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(group[:, order]) != 0).any(0), [True]]))
        left, ids, copies = np.asarray(table["left"]), np.asarray(table["vec_id"]), np.asarray(table["n"])
        for a, b in zip(cuts, cuts[1:]):
            rows = order[a:b]
            dim = table["dim"][int(rows[0])].as_py()
            vectors = _matrix(table["vector"].take(pa.array(rows)), dim)
            mine, other = left[rows], ~left[rows]
            if not other.any():  # a block with itself
                other = mine
            linked = _near(vectors[mine], vectors[other], threshold) & (ids[rows[mine]][:, None] != ids[rows[other]])
            out_ids.append(ids[rows[mine]])
            out_links.append(linked @ copies[rows[other]])
        return pa.table({"vec_id": np.concatenate(out_ids), "links": np.concatenate(out_links).astype(np.int64)})

    return count


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", miss: float = MISS
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row of ``vectors``.

    Vectors link when their cosine in doubles is at least ``threshold``; vectors of different length
    never do, nor do those that are null, empty, zero, hold null or non-finite components, or have no
    id. n_links counts other ids linked directly, component_id is the smallest id reachable (the own id
    for a vector without links, null for a null id), kept says whether it is the own id. Rows that repeat
    an id count once, with their smallest vector, and all get its result. Other columns are ignored.
    """
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    once = slim.groupBy("vec_id").agg(F.min("v").alias("v"))
    usable = stored(once.mapInArrow(_usable, VECTORS), "vectors")
    classes = usable.groupBy("dim", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
    classes = stored(classes.select("vec_id", "dim", "vector", "n"), "vector-classes")
    rows = classes.count()
    passes, signs = plan_passes(classes, rows, threshold, miss)
    found = stored(components(_links(classes, rows, passes, signs, threshold)).withColumnRenamed("id", "vec_id"), "vector-components")

    sizes = found.groupBy("component").agg(F.floor((F.count("*") + BLOCK - 1) / BLOCK).cast("int").alias("blocks"))
    placed = found.join(sizes, "component").join(classes, "vec_id").withColumn("own", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), "blocks").cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    kept = ["component", "vec_id", "dim", "vector", "n"]
    lefts = placed.select(*kept, F.lit(True).alias("left"), F.col("own").alias("i"), F.explode(others).alias("j"))
    rights = placed.select(*kept, F.lit(False).alias("left"), F.explode(others).alias("i"), F.col("own").alias("j")).where("i != j")
    pairs = lefts.union(rights)
    tasks = max(96, -(-found.count() // 2000))
    pairs = pairs.withColumn("task", F.pmod(F.xxhash64("component", "i", "j"), F.lit(tasks)))
    counted = pairs.groupBy("task").applyInArrow(_count(threshold), "vec_id long, links long")
    links_of = counted.groupBy("vec_id").agg(F.sum("links").alias("links"))

    # what is said of a class: most vectors stand alone and need no look-up
    alike = F.lit(1 if threshold <= 1 else 0)
    said = classes.select("vec_id", "n").join(found, "vec_id", "left").join(links_of, "vec_id", "left").where("n > 1 or component is not null")
    said = said.select(F.col("vec_id").alias("class"), (F.coalesce("links", F.lit(0)) + (F.col("n") - 1) * alike).alias("links"), "component")
    copies = classes.where("n > 1").select("dim", "vector", F.col("vec_id").alias("class")) if threshold <= 1 else None
    member = usable.select("vec_id", "dim", "vector")
    if copies is None:
        member = member.select("vec_id", F.col("vec_id").alias("class"))
    else:
        member = member.join(copies, ["dim", "vector"], "left").select("vec_id", F.coalesce("class", "vec_id").alias("class"))
    done = slim.select("vec_id").join(member.join(said, "class"), "vec_id", "left")
    component = F.coalesce("component", "class", "vec_id")
    return done.select(
        F.col("vec_id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )


def _links(classes: DataFrame, rows: int, passes: int, signs: int, threshold: float) -> DataFrame:
    """(a, b) of links that connect all classes which meet in a pass and reach the threshold."""
    runs = classes.mapInArrow(_run_sizes(passes, signs), SIZES).groupBy("dim", "turn", "key").agg(F.sum("n").alias("n"))
    full = stored(runs.where(F.col("n") > RUN).withColumn("blocks", F.ceil(F.col("n") / RUN).cast("int")), "vector-runs")
    dealt = classes.mapInArrow(_project(passes, signs), "turn int, key long, bits long, " + VECTORS)
    dealt = dealt.join(full.drop("n"), ["dim", "turn", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    # a run in blocks sends each vector once a block; a range parts neither a small run nor a pair of blocks
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other")
    more = full.agg(F.coalesce(F.sum(F.col("n") * (F.col("blocks") - 1)), F.lit(0))).first()[0]
    parts = max(24, -(-(rows * passes + more) // 20_000))
    ordered = dealt.repartitionByRange(parts, *GROUP).sortWithinPartitions(*GROUP, "bits", "vec_id")
    windowed = stored(ordered.mapInArrow(_windows(threshold), WINDOWED), "vector-windows")
    borders = windowed.where("border is not null").select("border", "head", "turn", "dim", "vec_id", "vector")
    across = borders.groupBy("border", "turn", "dim").applyInArrow(_across(threshold), "a long, b long")
    return windowed.where("a is not null").select("a", "b").union(across)
