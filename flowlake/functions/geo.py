"""Planar geometry on WGS84 lon/lat, as SQL array expressions.

A geometry is ``array<array<array<struct<x,y>>>>``: polygons, their rings (shell first), vertices.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

_HEAD = r"^\s*(?:SRID=\d+;\s*)?(?:MULTI)?POLYGON\s*(?:ZM|Z|M)?\s*"


def parse_wkt(wkt: Column) -> Column:
    """POLYGON or MULTIPOLYGON text to the nested array; a polygon becomes a one-part geometry."""
    upper = F.upper(wkt)
    body = F.regexp_replace(F.regexp_replace(upper, _HEAD, ""), r"\s*([(),])\s*", "$1")
    nested = F.when(upper.rlike(r"^\s*(?:SRID=\d+;\s*)?MULTI"), body).otherwise(
        F.concat(F.lit("("), body, F.lit(")"))
    )
    inner = F.regexp_replace(nested, r"^\(\(\(|\)\)\)$", "")
    return F.transform(
        F.split(inner, r"\)\),\(\("),
        lambda polygon: F.transform(
            F.split(polygon, r"\),\("),
            lambda ring: F.transform(F.split(ring, ","), _vertex),
        ),
    )


def _vertex(text: Column) -> Column:
    numbers = F.split(F.trim(text), r"\s+")
    return F.struct(
        F.get(numbers, F.lit(0)).try_cast("double").alias("x"),
        F.get(numbers, F.lit(1)).try_cast("double").alias("y"),
    )


def is_valid_geometry(wkt: Column) -> Column:
    """Whether the text is a (multi)polygon of closed rings with numeric vertices."""

    def closed(ring: Column) -> Column:
        numeric = F.forall(ring, lambda v: v["x"].isNotNull() & v["y"].isNotNull())
        return (F.size(ring) >= 4) & numeric & (F.get(ring, F.lit(0)) == F.element_at(ring, -1))

    shaped = F.upper(wkt).rlike(_HEAD + r"\(\s*\(.*\)\s*\)\s*$")
    rings = F.flatten(parse_wkt(wkt))
    return F.coalesce(shaped & F.forall(rings, closed), F.lit(False))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Apply ``body`` to a value that is evaluated once and appears once in the plan.

    Without it every mention of a geometry would copy its whole parsing expression.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _moments(ring: Column, anchor: Column, sign: Column) -> Column:
    """Twice the area and the first moments of a ring about the anchor, times the sign."""
    count = F.size(ring) - 1

    def step(p: Column, q: Column) -> Column:
        px, py = p["x"] - anchor["x"], p["y"] - anchor["y"]
        qx, qy = q["x"] - anchor["x"], q["y"] - anchor["y"]
        cross = px * qy - qx * py
        return F.struct(
            cross.alias("a"), ((px + qx) * cross).alias("mx"), ((py + qy) * cross).alias("my")
        )

    total = _sum_moments(F.zip_with(F.slice(ring, 1, count), F.slice(ring, 2, count), step))
    return _bind(total, lambda t: _scaled(t, F.when(t["a"] < 0, -sign).otherwise(sign)))


def _scaled(moment: Column, factor: Column) -> Column:
    return F.struct(*[(moment[part] * factor).alias(part) for part in ("a", "mx", "my")])


def _sum_moments(moments: Column) -> Column:
    zero = F.struct(*[F.lit(0.0).alias(part) for part in ("a", "mx", "my")])
    return F.aggregate(
        moments,
        zero,
        lambda acc, m: F.struct(*[(acc[part] + m[part]).alias(part) for part in ("a", "mx", "my")]),
    )


def _geometry_moments(geometry: Column, anchor: Column) -> Column:
    def of_polygon(polygon: Column) -> Column:
        return F.transform(
            polygon,
            lambda ring, i: _moments(
                ring, anchor, F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
            ),
        )

    return _sum_moments(F.flatten(F.transform(geometry, of_polygon)))


def _anchor(geometry: Column) -> Column:
    zero = F.lit(0)
    return F.get(F.get(F.get(geometry, zero), zero), zero)


def area(geometry: Column) -> Column:
    """Planar area in square degrees, holes taken off, whatever the ring direction."""
    return _bind(geometry, lambda g: _geometry_moments(g, _anchor(g))["a"] / 2)


def centroid(geometry: Column) -> Column:
    """Area-weighted centroid ``struct<lon,lat>``; NULL when the geometry has no area."""

    def point(anchor: Column, moment: Column) -> Column:
        whole = moment["a"] * 3
        return F.when(
            moment["a"] != 0,
            F.struct(
                (anchor["x"] + F.try_divide(moment["mx"], whole)).alias("lon"),
                (anchor["y"] + F.try_divide(moment["my"], whole)).alias("lat"),
            ),
        )

    def of_geometry(g: Column) -> Column:
        return _bind(
            _anchor(g), lambda anchor: _bind(_geometry_moments(g, anchor), lambda m: point(anchor, m))
        )

    return _bind(geometry, of_geometry)


def distance_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def polygon_edges(wkt: str) -> list[dict[str, float]]:
    """Edges of a user-given (multi)polygon parameter; raises on anything else."""
    if not re.match(_HEAD + r"\(\s*\(", wkt, re.IGNORECASE):
        raise ValueError("polygon must be POLYGON or MULTIPOLYGON text")
    edges = []
    for ring in re.findall(r"\(([^()]+)\)", wkt):
        vertices = [tuple(map(float, pair.split()[:2])) for pair in ring.split(",")]
        if len(vertices) < 4 or vertices[0] != vertices[-1]:
            raise ValueError("every ring of the polygon must be closed")
        for (x1, y1), (x2, y2) in zip(vertices, vertices[1:]):
            slope = 0.0 if y1 == y2 else (x2 - x1) / (y2 - y1)
            edges.append({"x1": x1, "y1": y1, "x2": x2, "y2": y2, "slope": slope})
    return edges


def within_polygon(lon: Column, lat: Column, wkt: str) -> Column:
    """Whether a point lies strictly inside the polygon (even-odd rule, boundary excluded).

    The edges travel as one literal that constant folding parses once; the bounding box comes
    first, as plain comparisons that reach the scan.
    """
    edges = polygon_edges(wkt)
    xs = [e["x1"] for e in edges]
    ys = [e["y1"] for e in edges]
    box = lon.between(min(xs), max(xs)) & lat.between(min(ys), max(ys))
    literal = F.from_json(
        F.lit(json.dumps(edges)),
        "array<struct<x1:double,y1:double,x2:double,y2:double,slope:double>>",
    )

    return box & _bind(F.struct(lon.alias("lon"), lat.alias("lat")), lambda p: _inside(p, literal))


def _inside(p: Column, edges: Column) -> Column:
    """Even-odd rule for a point (lon, lat), boundary excluded."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > p["lat"]) != (e["y2"] > p["lat"])
        return spans & (p["lon"] < e["x1"] + e["slope"] * (p["lat"] - e["y1"]))

    def touches(e: Column) -> Column:
        turn = (e["x2"] - e["x1"]) * (p["lat"] - e["y1"]) - (e["y2"] - e["y1"]) * (p["lon"] - e["x1"])
        return (
            (turn == 0)
            & p["lon"].between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & p["lat"].between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    odd = F.size(F.filter(edges, crosses)) % 2 == 1
    return odd & ~F.exists(edges, touches)


def edges(geometry: Column) -> Column:
    """Edges of a geometry column, as :func:`polygon_edges` gives those of a text."""

    def of_ring(ring: Column) -> Column:
        ends = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

        def edge(e: Column) -> Column:
            a, b = e["a"], e["b"]
            slope = F.when(a["y"] == b["y"], F.lit(0.0)).otherwise(F.try_divide(b["x"] - a["x"], b["y"] - a["y"]))
            return F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"), slope.alias("slope"))

        return F.transform(ends, edge)

    rings = F.filter(F.flatten(geometry), lambda ring: F.size(ring) > 1)
    return F.flatten(F.transform(rings, of_ring))


def within_edges(lon: Column, lat: Column, edges_of: Column) -> Column:
    """Whether a point lies strictly inside the polygon whose :func:`edges` a column holds."""
    return _bind(F.struct(lon.alias("lon"), lat.alias("lat")), lambda p: _inside(p, edges_of))


def geojson(geometry: Column) -> Column:
    """MultiPolygon GeoJSON text."""
    coordinates = F.transform(
        geometry,
        lambda polygon: F.transform(
            polygon, lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"]))
        ),
    )
    return F.to_json(
        F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))
    )


def map_centre(wkt: str) -> Column:
    """Centroid of a report's polygon parameter, where a map of it would be centred."""
    polygon_edges(wkt)
    return centroid(parse_wkt(F.lit(wkt)))
