"""Points in territories: a covering of cells, an equi-join and an exact ring test."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.session import stored

EARTH_RADIUS_M = 6378137.0  # sphere of the web-mercator projection
#: Levels of cells: 4**n degrees wide, powers of two, so that the cell of a
#: coordinate and the borders of a cell are exact.
FINEST, COARSEST = -10, 15
#: Edges beyond which a cell is split, and how often that may happen.
CELL_EDGES = 16
SPLITS = 4


def _to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    lon = F.degrees(x / F.lit(EARTH_RADIUS_M))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(EARTH_RADIUS_M))) - F.lit(math.pi / 2))
    return lon, lat


def normalise_crs(
    df: DataFrame,
    srid: int,
    lon: str | None = None,
    lat: str | None = None,
    geometry: str | None = None,
) -> DataFrame:
    """Longitude/latitude degrees for point columns or a polygon column.

    4326 passes through and 3857 is unprojected; other systems raise.
    """
    if srid == 4326:
        return df
    if srid != 3857:
        raise ValueError(f"unsupported coordinate reference system {srid}: use 4326 or 3857")
    out = df
    if lon and lat:
        x, y = _to_degrees(F.col(lon), F.col(lat))
        out = out.withColumns({lon: x, lat: y})
    if geometry:

        def vertex(v: Column) -> Column:
            x, y = _to_degrees(v["x"], v["y"])
            return F.struct(x.alias("x"), y.alias("y"))

        out = out.withColumn(geometry, F.transform(geometry, lambda p: F.transform(p, lambda r: F.transform(r, vertex))))
    return out


def _edges(geometry: Column) -> Column:
    """All ring edges of a polygon -> ring -> vertex array; rings are closed."""

    def of_ring(ring: Column) -> Column:
        def edge(v: Column, i: Column) -> Column:
            nxt = F.get(ring, (i + F.lit(1)) % F.size(ring))
            return F.struct(v["x"].alias("x1"), v["y"].alias("y1"), nxt["x"].alias("x2"), nxt["y"].alias("y2"))

        return F.transform(ring, edge)

    return F.flatten(F.transform(F.flatten(geometry), of_ring))


# Tests on edges, as SQL: e names an edge of a lambda, x and y a place.


def _edge_side(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def _straddles(e: str, axis: str, at: str) -> str:
    return f"(({e}.{axis}1 > {at}) <> ({e}.{axis}2 > {at}))"


def _right(e: str, x: str, y: str) -> str:
    """Whether an edge that straddles height y meets it right of x. Where the
    ends settle it the product is not asked, so rounding cannot contradict them."""
    side = _edge_side(e, x, y)
    return f"(greatest({e}.x1, {e}.x2) > {x} AND (least({e}.x1, {e}.x2) > {x} OR ({side} <> 0 AND ({side} > 0) = ({e}.y2 > {e}.y1))))"


def _above(e: str, x: str, y: str) -> str:
    """Whether an edge that straddles x meets it above y, where x is taken a
    touch to the right and y a lesser touch up; the same product decides as in ``_right``."""
    side = _edge_side(e, x, y)
    by_side = f"if({side} = 0, {e}.y2 > {e}.y1, {side} < 0) = ({e}.x2 > {e}.x1)"
    return f"(greatest({e}.y1, {e}.y2) > {y} AND (least({e}.y1, {e}.y2) > {y} OR {by_side}))"


def _odd(edges: str, corner: str, x: str, y: str, x1: str, y1: str) -> str:
    """Whether a point is inside, from whether the upper right corner (x1, y1) of
    its cell is: the way goes right to the border and up along it, and every
    edge it crosses changes sides. Only edges that meet the cell can do that."""
    ahead = f"{_straddles('e', 'y', y)} AND {_right('e', x, y)} AND NOT {_right('e', x1, y)}"
    up = f"{_straddles('e', 'x', x1)} AND {_above('e', x1, y)} AND NOT {_above('e', x1, y1)}"
    return f"({corner} <> ((size(filter({edges}, e -> {ahead})) + size(filter({edges}, e -> {up}))) % 2 = 1))"


def _on_an_edge(edges: str, x: str, y: str) -> str:
    between = " AND ".join(f"{p} BETWEEN least(e.{a}1, e.{a}2) AND greatest(e.{a}1, e.{a}2)" for a, p in (("x", x), ("y", y)))
    return f"exists({edges}, e -> {_edge_side('e', x, y)} = 0 AND {between})"


def _meeting(edges: str, c: str) -> str:
    """The edges that meet the closed cell ``c``, some that pass very near included."""
    sides = ", ".join(_edge_side("e", f"{c}.x{i}", f"{c}.y{j}") for i in (0, 1) for j in (0, 1))
    boxes = " AND ".join(f"greatest(e.{a}1, e.{a}2) >= {c}.{a}0 AND least(e.{a}1, e.{a}2) <= {c}.{a}1" for a in "xy")
    slack = f"1e-9D * ({c}.x1 - {c}.x0) * (abs(e.x2 - e.x1) + abs(e.y2 - e.y1))"
    return f"filter({edges}, e -> {boxes} AND least({sides}) <= {slack} AND greatest({sides}) >= -({slack}))"


def _width(level: str) -> str:
    return f"if({level} >= 0, 1D * shiftleft(1L, 2 * ({level})), 1D / shiftleft(1L, -2 * ({level})))"


def _box(cx: str, cy: str, width: str) -> str:
    return f"named_struct('x0', ({cx}) * {width}, 'y0', ({cy}) * {width}, 'x1', ({cx} + 1) * {width}, 'y1', ({cy} + 1) * {width}, 'cx', {cx}, 'cy', {cy})"


def _first_cells(polys: DataFrame, geometry: str, keep: Sequence[str]) -> DataFrame:
    """A row for each cell of a polygon's first covering, whose cells are as wide
    as the polygon, so there are nine at most."""
    rows = polys.select(*keep, _edges(F.col(geometry)).alias("_edges")).filter("size(_edges) > 0")
    ends = [f"array_{m}(transform(_edges, e -> {f}(e.{a}1, e.{a}2))) AS _{a}{m}" for a in "xy" for m, f in (("min", "least"), ("max", "greatest"))]
    rows = rows.selectExpr("*", *ends)
    extent = f"greatest(_xmax - _xmin, _ymax - _ymin, {4.0**FINEST!r}D)"
    rows = rows.selectExpr("*", f"greatest({FINEST}, least({COARSEST}, CAST(ceil(log2({extent}) / 2) AS INT))) AS _level")
    rows = rows.selectExpr("*", f"{_width('_level')} AS _w")
    for a in "xy":
        rows = rows.selectExpr("*", f"explode(sequence(floor(_{a}min / _w), floor(_{a}max / _w))) AS _c{a}")
    rows = rows.selectExpr("*", f"{_box('_cx', '_cy', '_w')} AS _box")
    beyond = f"size(filter(_edges, e -> {_straddles('e', 'y', '_box.y1')} AND {_right('e', '_box.x1', '_box.y1')}))"
    kept = [f"`{k}`" for k in keep]
    return rows.selectExpr(*kept, "_level", "_cx", "_cy", f"{beyond} % 2 = 1 AS _corner", f"{_meeting('_edges', '_box')} AS _edges")


def _split(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Cells that many edges meet as sixteen cells of the next level."""
    boxes = f"transform(sequence(0L, 15L), k -> {_box('(_cx * 4 + k % 4)', '(_cy * 4 + k div 4)', '_w / 4')})"
    corner = _odd("_edges", "_corner", "c.x1", "c.y1", "(_cx + 1) * _w", "(_cy + 1) * _w")
    parts = f"transform({boxes}, c -> named_struct('_level', _level - 1, '_cx', c.cx, '_cy', c.cy, '_corner', {corner}, '_edges', {_meeting('_edges', 'c')}))"
    itself = "array(named_struct('_level', _level, '_cx', _cx, '_cy', _cy, '_corner', _corner, '_edges', _edges))"
    rows = rows.selectExpr("*", f"{_width('_level')} AS _w")
    kept = [f"`{k}`" for k in keep]
    rows = rows.selectExpr(*kept, f"inline(if(size(_edges) > {CELL_EDGES} AND _level > {FINEST}, {parts}, {itself}))")
    return rows.filter("_corner OR size(_edges) > 0")


def polygon_cells(polys: DataFrame, geometry: str, keep: Sequence[str]) -> DataFrame:
    """A quadtree covering: one row per (polygon, cell) that can hold an inside
    point, with the cell's level and place.

    Cells of level n are 4**n degrees wide. A polygon starts with cells as wide
    as itself; a cell that more than ``CELL_EDGES`` edges meet is split, ``SPLITS``
    times at most. A cell carries the edges that meet it and whether its upper
    right corner is inside (``_corner``); one without edges lies inside as a whole, and
    cells outside are left out. So a polygon costs cells by its outline, not by its area.
    """
    rows = _first_cells(polys, geometry, keep).filter("_corner OR size(_edges) > 0")
    for _ in range(SPLITS):
        rows = _split(rows, keep)
    return rows


def spatial_join(
    points: DataFrame,
    polys: DataFrame,
    lon: str,
    lat: str,
    geometry: str,
    keep: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Points with the ``keep`` columns of every polygon strictly around them.

    Boundary points are outside; a point in k polygons yields k rows; with
    ``how='left'`` other points stay with NULLs. The distinct coordinates look up
    their cell at each level that the covering uses, an equi-join; points then
    take what was found for their coordinates. So a place that a third of the
    points share is tested once. How the sides meet is left to adaptive
    execution, which knows their real sizes.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    index = stored(polygon_cells(polys, geometry, keep))
    levels = sorted(r["_level"] for r in index.select("_level").distinct().collect())  # some twenty at most
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    placed = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    spots = points.filter(placed).select(x.alias("_mx"), y.alias("_my")).distinct()
    sought = spots.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).selectExpr("*", f"{_width('_level')} AS _w")
    sought = sought.selectExpr("*", "floor(_mx / _w) AS _cx", "floor(_my / _w) AS _cy")
    odd = _odd("_edges", "_corner", "_mx", "_my", "(_cx + 1) * _w", "(_cy + 1) * _w")
    found = sought.join(index, ["_level", "_cx", "_cy"]).filter(f"if(size(_edges) = 0, _corner, {odd} AND NOT {_on_an_edge('_edges', '_mx', '_my')})")
    found = found.select("_mx", "_my", F.lit(0).alias("_far"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keep)])
    # points without coordinates get keys of their own, so that they do not all
    # meet in the partition of the NULL key
    far = F.when(placed, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*points.columns), F.lit(10_000)).cast("int"))
    spread = points.withColumns({"_px": F.when(placed, x).otherwise(F.lit(0.0)), "_py": F.when(placed, y).otherwise(F.lit(0.0)), "_pf": far})
    same = (F.col("_px") == F.col("_mx")) & (F.col("_py") == F.col("_my")) & (F.col("_pf") == F.col("_far"))
    return spread.join(found, same, how).select(*[spread[c] for c in points.columns], *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)])


def territory_rollup(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    area: str,
    count_out: str = "facility_count",
    area_out: str = "area_total",
) -> DataFrame:
    """Facility count and whole-unit area per territory; unknown keys dropped,
    unknown areas count 0."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(id_col).alias(count_out), F.coalesce(F.sum(area), F.lit(0)).cast("long").alias(area_out))
    )
