"""Lines in the plane: resampling by distance, turning peaks, nearest marks.

Lengths are whole thousandths of the coordinates' unit, so that distances
along a line are sums of integers and the same in any order.

* :func:`resample` - ``marks`` points at equal distances along each line.
* :func:`with_corners` - local peaks of the turning angle, numbered along the
  line, and for every mark the corner whose stretch it belongs to.
* :func:`nearest_mark` - the nearest mark of the same line for any number of
  points: a grid join.  Marks are copied to the nine cells around their own
  and gathered by cell (at most all marks of one line), so a point meets one
  row of candidates by an equi-join and is never shuffled against all marks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators.asof import per_key_side

SCALE = 1000


def _thousandths(x: Column) -> Column:
    return F.floor(x * SCALE + 0.5).cast("bigint")


def resample(points: DataFrame, line: str, order: list[str], marks: int, x: str = "x", y: str = "y") -> DataFrame:
    """(line, mark, x, y, step): mark m of ``marks`` lies at m / marks of the
    line's length, between the two points around it; ``step`` is the distance
    between marks.  ``points`` holds one line's points per ``line`` key (a
    lap's readings, so a window per line is small); lines without length drop
    out."""
    w = Window.partitionBy(line).orderBy(*order)
    legs = points.select(line, *order, F.col(x).alias("x0"), F.col(y).alias("y0"), F.lead(x).over(w).alias("x1"), F.lead(y).over(w).alias("y1"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    legs = legs.where("x1 is not null").withColumn("_len", _thousandths(F.sqrt(dx * dx + dy * dy)))
    legs = legs.withColumn("_end", F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_total", F.sum("_len").over(Window.partitionBy(line)))
    legs = legs.where("_len > 0").withColumn("_start", F.col("_end") - F.col("_len"))
    # whole numbers: start * marks <= m * total < end * marks
    first = F.expr(f"(_start * {marks} + _total - 1) div _total")
    last = F.expr(f"(_end * {marks} + _total - 1) div _total - 1")
    at = legs.where(first <= last).withColumn("mark", F.explode(F.sequence(first, last)))
    part = (F.col("mark") * F.col("_total") - F.col("_start") * marks) / (F.col("_len") * marks).cast("double")
    return at.select(line, "mark", (F.col("x0") + (F.col("x1") - F.col("x0")) * part).alias("x"),
                     (F.col("y0") + (F.col("y1") - F.col("y0")) * part).alias("y"), (F.col("_total") / F.lit(float(SCALE * marks))).alias("step"))


def with_corners(marks: DataFrame, line: str, min_turn: float = math.pi / 6, reach: int = 5) -> DataFrame:
    """``marks`` with ``turn`` (angle between the ways to and from the mark),
    ``is_corner`` (a local peak of at least ``min_turn``), and ``corner``: the
    number of the nearest corner at most ``reach`` marks away (the earlier one
    of two as near), else NULL."""
    w = Window.partitionBy(line).orderBy("mark")
    for c in ("x", "y"):
        marks = marks.withColumn(f"_in_{c}", F.col(c) - F.lag(c).over(w)).withColumn(f"_out_{c}", F.lead(c).over(w) - F.col(c))
    cross = F.col("_in_x") * F.col("_out_y") - F.col("_in_y") * F.col("_out_x")
    dot = F.col("_in_x") * F.col("_out_x") + F.col("_in_y") * F.col("_out_y")
    turned = marks.withColumn("turn", F.abs(F.atan2(cross, dot))).drop("_in_x", "_in_y", "_out_x", "_out_y")
    before, after = F.coalesce(F.lag("turn").over(w), F.lit(-1.0)), F.coalesce(F.lead("turn").over(w), F.lit(-1.0))
    peaks = turned.withColumn("is_corner", F.coalesce((F.col("turn") >= min_turn) & (F.col("turn") > before) & (F.col("turn") >= after), F.lit(False)))
    numbered = peaks.withColumn("_no", F.sum(F.col("is_corner").cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spot = F.when(F.col("is_corner"), F.struct("mark", F.col("_no").alias("no")))
    prev = F.last(spot, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    following = F.first(spot, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    both = numbered.withColumn("_p", prev).withColumn("_f", following)
    back, ahead = F.col("mark") - F.col("_p.mark"), F.col("_f.mark") - F.col("mark")
    own = (F.when((back <= reach) & (F.coalesce(ahead, back) >= back), F.col("_p.no")).when(ahead <= reach, F.col("_f.no")))
    return both.withColumn("corner", own).drop("_no", "_p", "_f")


def nearest_mark(points: DataFrame, marks: DataFrame, line: str, payload: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """``points`` (with ``line``) that lie within two steps of a mark of their
    line, with ``mark`` and the ``payload`` columns of the nearest one (the
    first of several as near)."""
    radius = marks.groupBy(line).agg((2 * F.max("step")).alias("_cell")).where("_cell > 0")
    lines = radius.count()
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    cell = lambda c: F.floor(F.col(c) / F.col("_cell"))
    held = marks.join(per_key_side(radius, lines), line).withColumn("_a", F.explode(around))
    cells = held.select(line, (cell("x") + F.col("_a.i")).alias("_cx"), (cell("y") + F.col("_a.j")).alias("_cy"),
                        F.struct("mark", F.col("x").alias("mx"), F.col("y").alias("my"), *payload).alias("m"))
    cells = cells.groupBy(line, "_cx", "_cy").agg(F.collect_list("m").alias("_near"))
    n_cells = cells.count()
    placed = points.join(per_key_side(radius, lines), line).withColumn("_cx", cell(x)).withColumn("_cy", cell(y))
    # a cell holds at most the marks of its line within three cells: some dozen longs
    met = placed.join(per_key_side(cells, n_cells, 64), [line, "_cx", "_cy"])

    def candidate(m: Column) -> Column:
        dx, dy = F.col(x) - m["mx"], F.col(y) - m["my"]
        return F.struct((dx * dx + dy * dy).alias("d2"), m["mark"].alias("mark"), *[m[p].alias(p) for p in payload])
    best = met.withColumn("_best", F.array_min(F.transform("_near", candidate)))
    best = best.where(F.col("_best.d2") <= F.col("_cell") * F.col("_cell"))
    return best.select(*points.columns, F.col("_best.mark").alias("mark"), *[F.col(f"_best.{p}").alias(p) for p in payload])
