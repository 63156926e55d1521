"""Points in many polygons, by equality of grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.functions.geo import edges, within_edges
from flowlake.sinks.tables import stored

#: A polygon's box is laid out in cells of 2**level degrees, so many or fewer a side (and one more for its place).
CELLS = 16
LEVELS = (-24, 9)

#: Rows at the same place are joined together, so many at once.
TOGETHER = 512


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def _overlaps(e: Column, axis: str, low: Column, high: Column) -> Column:
    """Whether the edge's box and a span have a coordinate in common, ends included."""
    one, two = e[f"{axis}1"], e[f"{axis}2"]
    return (F.least(one, two) <= high) & (F.greatest(one, two) >= low)


def polygon_cells(shapes: DataFrame, key: str) -> DataFrame:
    """(key, level, cx, cy, border, edges): the cells of each polygon, those an edge may pass marked.

    ``shapes`` has ``key`` and ``edges``. Small polygons have small cells, so each has some 300 at most; those
    wholly outside are left out. Marked cells have the edges that a test of places in them needs: those of their
    band of latitude but not wholly west of them, with a cell's width to spare for rounding. The band's edges
    are picked first, so that a cell sees a few of a polygon's edges only.
    """
    xs, ys = (F.concat(F.col(f"edges.{c}1"), F.col(f"edges.{c}2")) for c in "xy")
    boxed = shapes.where(F.size("edges") > 0).select(
        key, "edges", F.array_min(xs).alias("west"), F.array_max(xs).alias("east"), F.array_min(ys).alias("south"), F.array_max(ys).alias("north")
    )
    width = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"), F.lit(2.0 ** LEVELS[0]))
    level = F.greatest(F.lit(LEVELS[0]), F.least(F.lit(LEVELS[1]), F.ceil(F.log2(width / CELLS)).cast("int")))
    boxed = boxed.withColumn("level", level).withColumn("side", F.pow(F.lit(2.0), F.col("level")))
    side = F.col("side")
    across = F.sequence(_cell(F.col("west"), F.col("level")), _cell(F.col("east"), F.col("level")))
    up = F.sequence(_cell(F.col("south"), F.col("level")), _cell(F.col("north"), F.col("level")))

    def band(cy: Column) -> Column:
        """Edges with an unknown end stay: they keep a test from holding."""
        near = F.filter("edges", lambda e: F.coalesce(_overlaps(e, "y", cy * side, cy * side + side), F.lit(True)))
        return F.struct(cy.alias("cy"), near.alias("edges"))

    bands = boxed.select(key, "level", "side", across.alias("across"), F.explode(F.transform(up, band)).alias("band"))
    low_y = F.col("band.cy") * side

    def cell(cx: Column) -> Column:
        low_x = cx * side

        def marked(near: Column) -> Column:
            def meets(e: Column) -> Column:
                return _overlaps(e, "x", low_x, low_x + side) & _overlaps(e, "y", low_y, low_y + side)

            return F.transform(
                F.array(F.exists(near, meets)),
                lambda border: F.struct(
                    cx.alias("cx"), border.alias("border"), F.when(border, near).alias("edges"),
                    (border | within_edges(low_x + side / 2, low_y + side / 2, near)).alias("held"),
                ),
            )

        east = F.filter("band.edges", lambda e: F.coalesce(F.greatest(e["x1"], e["x2"]) >= low_x - side, F.lit(True)))
        return F.flatten(F.transform(F.array(east), marked))

    cells = F.filter(F.flatten(F.transform("across", cell)), lambda c: c["held"])
    found = bands.select(key, "level", F.col("band.cy").alias("cy"), F.explode(cells).alias("c"))
    return found.select(key, "level", "c.cx", "cy", "c.border", "c.edges")


def _together(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """(__lon, __lat, __rows): the rows of each place, in lists of :data:`TOGETHER` at most."""
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("__row")
    known = points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)).select(row, x.alias("__lon"), y.alias("__lat"))
    number = F.row_number().over(Window.partitionBy("__lon", "__lat").orderBy("__lon"))
    listed = known.withColumn("__list", F.floor((number - 1) / TOGETHER))
    return listed.groupBy("__lon", "__lat", "__list").agg(F.collect_list("__row").alias("__rows")).drop("__list")


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, key: str, lon: str = "lon", lat: str = "lat", geometry: str = "geometry"
) -> DataFrame:
    """Every row of ``points`` with the ``key`` of every polygon it lies strictly inside, a row for each pair.

    Places meet polygons where they share a cell, by an equi-join; inside a cell that no edge passes the answer is known,
    the others are tested exactly with the cell's own edges, boundary excluded. Pairs come out of that join as they
    are and are not shuffled again; rows at one place are told apart after it. Null places and null or empty geometries
    meet nothing. Rows of ``polygons`` that repeat a key are polygons of their own. A place has one cell for each level
    that occurs, at most 34; the list of levels comes to the driver. Work is dealt to as many tasks as shuffles have,
    as the few bytes that polygons and places have say nothing of the cells and pairs made of them.
    """
    if key in points.columns:
        raise ValueError(f"points have a column {key} of their own")
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shapes = polygons.select(F.col(key).alias("__key"), edges(F.col(geometry)).alias("edges")).repartition(tasks)
    cells = stored(polygon_cells(stored(shapes, "polygon-edges"), "__key"), "polygon-cells")
    levels = [r.level for r in cells.select("level").distinct().collect()]
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    if not levels:
        return points.where(F.lit(False)).withColumn(key, F.lit(None).cast(dict(polygons.dtypes)[key]))
    at, same = (F.col("__lon"), F.col("__lat")), ["level", "cx", "cy"]
    places = [F.struct(F.lit(n).alias("level"), *[_cell(v, F.lit(n)).alias(c) for v, c in zip(at, same[1:])]) for n in sorted(levels)]
    placed = _together(points, x, y).select("*", F.explode(F.array(*places)).alias("c")).select("__rows", *at, "c.*")
    placed = placed.repartition(tasks, *same).hint("merge")
    sure, near = (cells.where(kind).repartition(tasks, *same) for kind in (~F.col("border"), F.col("border")))
    met = placed.join(sure, same).select("__rows", "__key")
    tested = placed.join(near, same).where(within_edges(*at, F.col("edges"))).select("__rows", "__key")
    pairs = met.unionAll(tested).select(F.explode("__rows").alias("__row"), "__key")
    return pairs.select(*[F.col("__row").getField(c).alias(c) for c in points.columns], F.col("__key").alias(key))
