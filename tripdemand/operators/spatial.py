"""Point -> borough polygon containment join, as Spark jobs.

A point belongs to the first borough (smallest ``borough_code``) one of
whose polygons strictly contains it; a point on an edge is outside that
polygon, and a point in no polygon gets ``EWR``.

Design (all Spark, no per-row geometry library):

* A coarse grid covers the polygons' bounding box. A cell that more than
  ``max_edges`` edges come near is split into 16 x 16 cells, and so on: detailed
  shores get small cells, plain ones keep large cells, and a cell's edge list
  stays bounded however many edges a polygon has. (Only edges that meet in
  one vertex cannot be told apart; splitting ends after ``MAX_LEVELS``.)
* A cell knows the inside-set of one reference point, just right of its right
  side at half height. A point's own set is that set, with each polygon flipped
  once per edge crossed on the way from the point along its horizontal to
  the reference's vertical and along that to the reference: both lie inside
  the cell's margin, so only the cell's edges matter (parity per polygon, so
  holes work). Polygons on whose edge the point lies are removed.
* Crossings follow one rule everywhere: heights count as a little above,
  verticals as (much less) a little right of their value, and which side of an edge
  a corner lies on is decided by one cross product for both legs.
* Reference sets are handed down: a child's set is its parent's with the
  crossings between their references. Per row of children a crossing flips all
  columns left of it, so a parity count per (row, column, polygon) suffices:
  edges are joined by the y-bands (child rows) they span, and no edge meets
  every cell.
* The tables are bounded by the polygon file, not by the number of points. They
  are broadcast after a size check; the point side never shuffles, so a
  hot region (a third of all trips in one borough) costs nothing extra.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdemand.schemas import OUTSIDE_BOROUGH
from tripdemand.session import scratch_root

# A polygon reference inside the index: ordering by it picks the smallest
# borough code. Names live in a separate (tiny) code -> name table.
POLY_TYPE = T.StructType([
    T.StructField("borough_code", T.IntegerType()),
    T.StructField("polygon_id", T.LongType()),
])
# Cells per side of the coarse grid: about 8 * sqrt(#edges) in these bounds; splitting does the rest.
MIN_CELLS_PER_SIDE, MAX_CELLS_PER_SIDE = 16, 128
# Edges of a cell's list, children per side of a split cell, and how often a cell is split.
MAX_EDGES, FAN, MAX_LEVELS = 64, 16, 5
# Parts of a cell's side: edges this near count as in the cell; its reference is half as far right of it.
MARGIN, REFERENCE = 0.01, 0.005
DEFAULT_INDEX_BROADCAST_ROWS = 4_000_000


def auto_cells_per_side(n_edges: int) -> int:
    return int(min(MAX_CELLS_PER_SIDE, max(MIN_CELLS_PER_SIDE, 8 * math.sqrt(max(n_edges, 1)))))


def _x_at(e, y: Column) -> Column:
    """x of the edge's line at height y (NULL for a horizontal edge)."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]


def _spans(e, y: Column) -> Column:
    """Half-open rule: the edge crosses the horizontal line at height y."""
    return (e["y1"] > y) != (e["y2"] > y)


def _spans_x(e, x: Column) -> Column:
    """The same for the vertical line at x."""
    return (e["x1"] > x) != (e["x2"] > x)


def _cross(e, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def _left_of(e, x: Column, y: Column) -> Column:
    """An edge that spans y meets that height right of x (not at x)."""
    c = _cross(e, x, y)
    return (F.when((e["x1"] <= x) & (e["x2"] <= x), F.lit(False)).when((e["x1"] > x) & (e["x2"] > x), F.lit(True))
            .when(e["y2"] > e["y1"], c > 0).otherwise(c < 0))


def _above(e, x: Column, y: Column) -> Column:
    """An edge that spans the vertical at x meets it above y; through (x, y) itself, if it rises to the right."""
    c = _cross(e, x, y)
    rises = (e["y2"] > e["y1"]) == (e["x2"] > e["x1"])
    return (F.when((e["y1"] <= y) & (e["y2"] <= y) & ((e["y1"] < y) | (e["y2"] < y)), F.lit(False))
            .when((e["y1"] > y) & (e["y2"] > y), F.lit(True))
            .when(e["y1"] == e["y2"], F.lit(False))
            .when(c == 0, rises)
            .when(e["x2"] > e["x1"], c < 0).otherwise(c > 0))


def _on_segment(e, x: Column, y: Column) -> Column:
    """Inside the edge's box (cheap, checked first) and on its line."""
    return ((x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
            & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
            & (_cross(e, x, y) == 0))


class PolygonIndex:
    """Adaptive grid over borough polygon edges; :meth:`locate` runs the join."""

    def __init__(self, edges: DataFrame, cells_per_side: int | None = None,
                 max_broadcast_rows: int = DEFAULT_INDEX_BROADCAST_ROWS, max_edges: int = MAX_EDGES):
        self.max_broadcast_rows = max_broadcast_rows
        self.max_edges = max_edges
        # Every table of the index is a reliable checkpoint in the shared
        # checkpoint folder: an executor loss re-reads it instead of
        # rebuilding, and plans that use the index see a plain scan. So are the
        # edges: a cached table would keep the session's number of shuffle
        # partitions, each a task that reports to the driver in every job below.
        scratch_root(edges.sparkSession)
        edges = edges.select(F.col("borough_code").cast("int").alias("borough_code"), "borough",
                             F.col("polygon_id").cast("long").alias("polygon_id"),
                             *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).checkpoint(eager=True)
        e = edges.select(F.struct("borough_code", "polygon_id").alias("poly"), "x1", "y1", "x2", "y2")
        # Borough names by code, one row per borough (the edge table already
        # carries one name per code).
        names = edges.groupBy(F.col("borough_code").alias("_code")).agg(F.min("borough").alias("_name"))
        # One aggregate row: the bounding box of every edge.
        box = e.agg(F.min(F.least("x1", "x2")).alias("minx"), F.max(F.greatest("x1", "x2")).alias("maxx"),
                    F.min(F.least("y1", "y2")).alias("miny"), F.max(F.greatest("y1", "y2")).alias("maxy"),
                    F.count("*").alias("n")).first()
        if not box or not box["n"]:  # no polygons: every point is outside
            self.cells_per_side = 0
            self.delta, self.gx0, self.gy0, self.ncols, self.nrows = 1.0, 0.0, 0.0, 0, 0
        else:
            w, h = box["maxx"] - box["minx"], box["maxy"] - box["miny"]
            span = max(w, h) or 1.0
            cells_per_side = cells_per_side or auto_cells_per_side(box["n"])
            self.cells_per_side = cells_per_side
            self.delta = span / cells_per_side
            self.gx0 = box["minx"] - 2 * self.delta
            self.gy0 = box["miny"] - 2 * self.delta
            self.ncols = int(math.ceil(w / self.delta)) + 4
            self.nrows = int(math.ceil(h / self.delta)) + 4
        self._build(e)
        self.names = names.checkpoint(eager=True)
        # Names have at most one row per edge: the edge count bounds them.
        self.n_names = box["n"] if box else 0

    # -- geometry of the cells (the same expressions at build and at lookup) --
    def _size(self, level: int) -> float:
        return self.delta / FAN ** level

    def _cell_of(self, v: Column, origin: float, level: int = 0) -> Column:
        # Sizes differ by powers of two, so a point's cells are nested exactly.
        return F.floor((v - F.lit(origin)) / F.lit(self._size(level)))

    def _ref_x(self, cx: Column, level: int) -> Column:
        d = self._size(level)
        return F.lit(self.gx0) + (cx + 1) * F.lit(d) + F.lit(REFERENCE * d)

    def _ref_y(self, cy: Column, level: int) -> Column:
        return F.lit(self.gy0) + (cy + 0.5) * F.lit(self._size(level))

    # -- index construction (small, bounded by the polygons) -----------------
    def _cells_near(self, e: DataFrame, level: int) -> DataFrame:
        """(px, py, cx, cy, edge) for the children of the cells (px, py) that an edge comes near."""
        d = self._size(level)
        m = MARGIN * d
        ymin, ymax = F.least("y1", "y2"), F.greatest("y1", "y2")
        low = F.greatest(F.col("r0"), self._cell_of(ymin - m, self.gy0, level))
        high = F.least(F.col("r1"), self._cell_of(ymax + m, self.gy0, level))
        rows = e.where(low <= high).withColumn("cy", F.explode(F.sequence(low, high)))
        below = F.lit(self.gy0) + F.col("cy") * F.lit(d)
        ylo, yhi = F.greatest(ymin, below - m), F.least(ymax, below + d + m)
        # A nearly level edge is not cut to the row: its x at a height is too uncertain.
        flat = (ymax - ymin < m) | (ylo > yhi)
        edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
        xmin, xmax = F.least("x1", "x2"), F.greatest("x1", "x2")
        xa = F.when(flat, xmin).otherwise(F.greatest(xmin, F.least(_x_at(edge, ylo), _x_at(edge, yhi))))
        xb = F.when(flat, xmax).otherwise(F.least(xmax, F.greatest(_x_at(edge, ylo), _x_at(edge, yhi))))
        mx = F.lit(m) + (xmax - xmin) * 1e-6
        first = F.greatest(F.col("c0"), self._cell_of(xa - mx, self.gx0, level))
        last = F.least(F.col("c1"), self._cell_of(xb + mx, self.gx0, level))
        return (rows.withColumn("first", first).withColumn("last", last).where("first <= last")
                .withColumn("cx", F.explode(F.sequence("first", "last")))
                .select("px", "py", "cx", "cy", "edge"))

    def _flips(self, e: DataFrame, level: int) -> DataFrame:
        """(cx, cy, poly) of children whose reference and the parent's lie on different sides of a polygon's boundary."""
        d = self._size(level)
        edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
        # The y-bands (child rows) whose reference height an edge spans.
        ymin, ymax = F.least("y1", "y2"), F.greatest("y1", "y2")
        low = F.greatest(F.col("r0"), self._cell_of(ymin, self.gy0, level) - 1)
        high = F.least(F.col("r1"), self._cell_of(ymax, self.gy0, level) + 1)
        across = e.where(low <= high).withColumn("cy", F.explode(F.sequence(low, high)))
        y = self._ref_y(F.col("cy"), level)
        across = across.where(_spans(edge, y) & (F.col("at_x").isNull() | ~_left_of(edge, F.col("at_x"), y)))
        # The last column whose reference is left of the edge: an estimate, settled by the rule itself.
        near = self._cell_of(_x_at(edge, y), self.gx0, level) - 2
        column = near - 1
        for k in range(4):
            column = column + _left_of(edge, self._ref_x(near + k, level), y).cast("long")
        across = across.select("px", "py", "c0", "c1", "cy", "poly", F.least(F.col("c1"), column).alias("upto"))
        # Edges that cross the parent's vertical flip whole rows.
        down = e.where(F.col("at_x").isNotNull()).where(_spans_x(edge, F.col("at_x"))) \
            .withColumn("cy", F.explode(F.sequence("r0", "r1"))) \
            .where(_above(edge, F.col("at_x"), y) != _above(edge, F.col("at_x"), F.col("at_y"))) \
            .select("px", "py", "c0", "c1", "cy", "poly", F.col("c1").alias("upto"))
        odd = (across.unionByName(down).where("upto >= c0").groupBy("px", "py", "c0", "c1", "cy", "poly", "upto").count()
               .where("count % 2 = 1"))
        # At most one entry per column is left in a row; a column is flipped by the entries at or right of it.
        rows = odd.groupBy("px", "py", "c0", "c1", "cy", "poly").agg(F.collect_list("upto").alias("upto"))
        return rows.select("px", "py", "cy", "poly", F.explode(F.filter(
            F.sequence("c0", "c1"), lambda c: F.size(F.filter("upto", lambda u: u >= c)) % 2 == 1)).alias("cx")) \
            .select("cx", "cy", "poly")

    def _build(self, e: DataFrame) -> None:
        """Tables per level: cells (cx, cy, has_edges, split, inside), and one of edge lists by (level, cx, cy)."""
        self.levels, lists = [], []
        edge = F.struct("x1", "y1", "x2", "y2", "poly").alias("edge")
        # The whole grid is the root; its reference lies right of all edges, outside everything.
        held = e.select(F.lit(0).cast("long").alias("px"), F.lit(0).cast("long").alias("py"), edge)
        inside = None
        for level in range(MAX_LEVELS):
            width = (F.lit(self.ncols), F.lit(self.nrows)) if level == 0 else (F.lit(FAN), F.lit(FAN))
            c0, r0 = (F.col("px") * FAN, F.col("py") * FAN) if level else (F.lit(0), F.lit(0))
            parents = held.select("px", "py", "edge.*", "edge").withColumn("c0", c0.cast("long")).withColumn("r0", r0.cast("long")) \
                .withColumn("c1", F.col("c0") + width[0] - 1).withColumn("r1", F.col("r0") + width[1] - 1)
            ref = (self._ref_x(F.col("px"), level - 1), self._ref_y(F.col("py"), level - 1)) if level else (F.lit(None), F.lit(None))
            parents = parents.withColumn("at_x", ref[0].cast("double")).withColumn("at_y", ref[1].cast("double"))
            near = self._cells_near(parents, level).checkpoint(eager=True)
            flips = self._flips(parents, level)
            if level:  # what the parent's reference is inside of, for all its children
                flips = flips.unionByName(inside.select(
                    F.explode(F.sequence(F.col("cx") * FAN, F.col("cx") * FAN + FAN - 1)).alias("cx"), "cy", "poly")
                    .select("cx", F.explode(F.sequence(F.col("cy") * FAN, F.col("cy") * FAN + FAN - 1)).alias("cy"), "poly"))
            sets = (flips.groupBy("cx", "cy", "poly").count().where("count % 2 = 1")
                    .groupBy("cx", "cy").agg(F.array_sort(F.collect_list("poly")).alias("inside")))
            counts = near.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
            split = (F.col("n") > self.max_edges) if level < MAX_LEVELS - 1 else F.lit(False)
            cells = (counts.join(sets, ["cx", "cy"], "full_outer")
                     .select("cx", "cy", F.col("n").isNotNull().alias("has_edges"),
                             F.coalesce(split, F.lit(False)).alias("split"), "inside")).checkpoint(eager=True)
            self.levels.append(cells)
            wanted = cells.where("has_edges").select("cx", "cy", "split")
            lists.append(near.join(wanted.where("not split").drop("split"), ["cx", "cy"])
                         .groupBy("cx", "cy").agg(F.collect_list("edge").alias("edges"))
                         .select(F.lit(level).alias("level"), "cx", "cy", "edges"))
            held = near.join(wanted.where("split").drop("split"), ["cx", "cy"]) \
                .select(F.col("cx").alias("px"), F.col("cy").alias("py"), "edge").checkpoint(eager=True)
            inside = cells.where("split").select("cx", "cy", F.explode("inside").alias("poly"))
            if held.isEmpty():
                break
        out = lists[0]
        for more in lists[1:]:
            out = out.unionByName(more)
        self.lists = out.checkpoint(eager=True)
        # Sizes for the broadcast decisions in locate(): no further job there.
        self.level_rows = [c.count() for c in self.levels]
        self.n_lists = self.lists.count()

    # -- diagnostics (for choosing cells_per_side) ----------------------------
    def summary(self) -> dict:
        """Grid parameters and index sizes; ``longest_list`` is one aggregate over the lists."""
        return {"cells_per_side": self.cells_per_side, "delta": self.delta,
                "ncols": self.ncols, "nrows": self.nrows, "levels": len(self.levels),
                "index_cells": sum(self.level_rows), "runs": self.n_lists,
                "longest_list": self.lists.agg(F.max(F.size("edges"))).first()[0] or 0}

    def edge_cell_share(self, points: DataFrame, x_col: str, y_col: str) -> DataFrame:
        """One row: how many points fall in cells with edges (they take the exact test)
        and the mean number of edges they see. A distributed
        aggregate over a broadcast join; nothing is collected per point."""
        j = self._with_cell(points.select(F.col(x_col).cast("double").alias("_x"), F.col(y_col).cast("double").alias("_y")), "_x", "_y")
        return j.agg(F.count(F.lit(1)).alias("points"),
                     F.count("_edges").alias("in_edge_cells"),
                     (F.count("_edges") / F.count(F.lit(1))).alias("share"),
                     F.avg(F.size("_edges")).alias("mean_candidate_edges"))

    # -- the join -----------------------------------------------------------
    def _hinted(self, df: DataFrame, rows: int) -> DataFrame:
        # Beyond the bound the planner shuffles (AQE splits a hot cell's partition if points are skewed).
        return F.broadcast(df) if rows <= self.max_broadcast_rows else df

    def _with_cell(self, points: DataFrame, x_col: str, y_col: str) -> DataFrame:
        """``points`` with their smallest cell's reference, inside-set and edges (_xr, _yr, _inside, _edges)."""
        d, gx0, gy0 = self.delta, self.gx0, self.gy0
        x, y = F.col(x_col), F.col(y_col)
        look = ((x >= F.lit(gx0)) & (x < F.lit(gx0 + self.ncols * d))
                & (y >= F.lit(gy0)) & (y < F.lit(gy0 + self.nrows * d)))
        j = points
        kept = ("_level", "_cx", "_cy", "_split", "_has", "_inside")
        for level, cells in enumerate(self.levels):
            here = [c + str(level) for c in kept]
            j = (j.withColumn("_kx", F.when(look, self._cell_of(x, gx0, level)))
                 .withColumn("_ky", F.when(look, self._cell_of(y, gy0, level))))
            side = cells.select(F.col("cx").alias("_kx"), F.col("cy").alias("_ky"), F.lit(level).alias(here[0]),
                                F.col("cx").alias(here[1]), F.col("cy").alias(here[2]), F.col("split").alias(here[3]),
                                F.col("has_edges").alias(here[4]), F.col("inside").alias(here[5]))
            j = j.join(self._hinted(side, self.level_rows[level]), ["_kx", "_ky"], "left").drop("_kx", "_ky")
            # A cell below replaces its parent; in a split cell without a row below there is neither edge nor polygon.
            if level:
                j = j.select(*[c for c in j.columns if c not in here and c not in kept],
                             *[F.when(F.col("_split"), F.col(h)).otherwise(F.col(c)).alias(c) for c, h in zip(kept, here)])
            else:
                j = j.withColumnsRenamed(dict(zip(here, kept)))
            look = F.col("_split")
        # References from the cell numbers, by the expressions of the build.
        ref_x, ref_y = F.lit(None).cast("double"), F.lit(None).cast("double")
        for level in range(len(self.levels)):
            at = F.col("_level") == level
            ref_x = F.when(at, self._ref_x(F.col("_cx"), level)).otherwise(ref_x)
            ref_y = F.when(at, self._ref_y(F.col("_cy"), level)).otherwise(ref_y)
        j = j.withColumn("_xr", ref_x).withColumn("_yr", ref_y).withColumn("_lx", F.when(F.col("_has"), F.col("_cx")))
        lists = self.lists.select(F.col("level").alias("_level"), F.col("cx").alias("_lx"), F.col("cy").alias("_cy"),
                                  F.col("edges").alias("_edges"))
        return j.join(self._hinted(lists, self.n_lists), ["_level", "_lx", "_cy"], "left") \
            .drop("_level", "_cx", "_cy", "_lx", "_split", "_has")

    def locate(self, points: DataFrame, x_col: str, y_col: str,
               out_col: str = "borough_name") -> DataFrame:
        """Add ``out_col`` (borough name, ``EWR`` when in no polygon) to ``points``."""
        x, y, xr, yr = F.col(x_col), F.col(y_col), F.col("_xr"), F.col("_yr")
        j = self._with_cell(points, x_col, y_col)
        # Edges crossed on the way to the reference: along the point's height up to
        # the reference's vertical, then along that; an edge crossed on both legs counts twice.
        def crossed(e):
            level = _spans(e, y) & (x < _x_at(e, y)) & ~_left_of(e, xr, y)
            upright = _spans_x(e, xr) & (_above(e, xr, y) != _above(e, xr, yr))
            return level != upright

        j = j.withColumn("_cross", F.transform(F.filter("_edges", crossed), lambda e: e["poly"]))
        # Polygons crossed an odd number of times: one pass over the sorted
        # ids, dropping a pair whenever an id repeats.
        empty = F.array().cast(T.ArrayType(POLY_TYPE))
        j = j.withColumn("_odd", F.aggregate(
            F.array_sort("_cross"), empty,
            lambda acc, p: F.when(F.try_element_at(acc, F.lit(-1)) == p,
                                  F.slice(acc, 1, F.size(acc) - 1))
            .otherwise(F.concat(acc, F.array(p)))))
        j = j.withColumn("_on", F.transform(
            F.filter("_edges", lambda e: _on_segment(e, x, y)), lambda e: e["poly"]))
        end = F.coalesce(F.col("_inside"), empty)
        flipped = F.array_union(F.array_except("_odd", end), F.array_except(end, "_odd"))
        inside = F.when(F.col("_edges").isNull(), end).otherwise(F.array_except(flipped, "_on"))
        best = F.array_min(inside)["borough_code"]
        out = (j.withColumn("_code", best)
               .drop("_xr", "_yr", "_inside", "_edges", "_cross", "_odd", "_on")
               .join(self._hinted(self.names, self.n_names), "_code", "left"))
        return (out.withColumn(out_col, F.coalesce(F.col("_name"), F.lit(OUTSIDE_BOROUGH)))
                .drop("_code", "_name"))
