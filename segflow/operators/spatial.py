"""Join of points to lines within a distance, as an equi-join on grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.functions.shapes import pieces, squared_distance
from segflow.session import stored

_SLACK = 1e-9  # degrees; keeps cell bounds safe from rounding
#: Most points that are sent to every task (some ten megabytes); more are joined by shuffle.
FEW_POINTS = 100_000


def piece_cells(df: DataFrame, reach: float, cell: float) -> DataFrame:
    """Explode pieces ``x1, y1, x2, y2`` to the cells ``cx, cy`` a point within
    ``reach`` can lie in. Cells follow the line column by column, so a long
    diagonal yields cells in proportion to its length, not to its box."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    pad = reach + _SLACK

    def cell_of(value: Column) -> Column:
        return F.floor(value / cell)

    columns = F.sequence(cell_of(F.least(x1, x2) - pad), cell_of(F.greatest(x1, x2) + pad))
    wide = df.withColumn("cx", F.explode(columns))

    def along(x: Column, upright: float) -> Column:
        # share of the way at which the piece passes x; an upright piece never does
        share = F.coalesce(F.try_divide(x - x1, x2 - x1), F.lit(upright))
        return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))

    left = along(F.col("cx") * cell - pad, 0.0)
    right = along((F.col("cx") + 1) * cell + pad, 1.0)
    ya, yb = y1 + left * (y2 - y1), y1 + right * (y2 - y1)
    rows = F.sequence(cell_of(F.least(ya, yb) - pad), cell_of(F.greatest(ya, yb) + pad))
    return wide.withColumn("cy", F.explode(rows))


def blocked_join(left: DataFrame, right: DataFrame, keys: list[str], per_block: int) -> DataFrame:
    """Inner join on ``keys`` in which no task holds more than about
    ``per_block`` right rows under one key.

    Right rows of a crowded key are dealt into blocks by hash and the left rows
    of that key are repeated once per block; every pair still meets exactly
    once. A crowded left side streams past a block and is split by adaptive
    execution. The merge hint rules out a broadcast on the strength of an
    estimate that does not see exploded rows.
    """
    blocks = right.groupBy(*keys).agg(F.ceil(F.count("*") / per_block).cast("int").alias("_blocks"))
    crowded = blocks.where("_blocks > 1")
    dealt = F.pmod(F.xxhash64(*right.columns), F.coalesce("_blocks", F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))
    r = right.join(crowded, keys, "left").withColumn("_block", dealt).drop("_blocks")
    l = left.join(crowded, keys, "left").withColumn("_block", every).drop("_blocks")
    return l.hint("merge").join(r, [*keys, "_block"]).drop("_block")


def lines_near_points(
    lines: DataFrame,
    points: DataFrame,
    wkt: str,
    lon: str,
    lat: str,
    reach: float = 0.001,
    same: list[str] | None = None,
    cell: float | None = None,
    per_block: int = 2_000,
) -> DataFrame:
    """Pairs of a line and a point at most ``reach`` degrees apart, with the
    columns of both.

    ``lines`` holds the line as text in ``wkt``; ``same`` names columns both
    sides carry and that must be equal (they become join keys, so unequal rows
    never meet). A pair comes once even if several pieces of the line are near.
    Up to ``FEW_POINTS`` points are broadcast (they are counted first), beyond
    that both sides are shuffled by cell and crowded cells are split.
    Points, and pieces of lines, outside 180 and 90 degrees are near nothing.
    Only a key of the line travels with its pieces; its columns, the long text
    among them, are fetched for the pairs found, which are stored: so it is known how few
    they are, and they go to the lines instead of all lines' texts through the driver.
    """
    same = same or []
    cell = cell or 2 * reach
    keys = [*same, "cx", "cy"]
    named = lines.withColumn("_line_key", F.md5(wkt))
    located = points.where(F.abs(lon) <= 180).where(F.abs(lat) <= 90)
    located = located.withColumns({"cx": F.floor(F.col(lon) / cell), "cy": F.floor(F.col(lat) / cell)})
    # one coordinate that is none would make a piece of cells without end
    on_earth = [F.abs(c) <= most for c, most in (("x1", 180), ("x2", 180), ("y1", 90), ("y2", 90))]
    covered = pieces(named, wkt, [*same, "_line_key"])
    for good in on_earth:
        covered = covered.where(good)
    covered = piece_cells(covered, reach, cell)
    if located.limit(FEW_POINTS + 1).count() <= FEW_POINTS:
        met = covered.join(F.broadcast(located), keys)
    else:
        met = blocked_join(covered, located, keys, per_block)
    distance = squared_distance(*[F.col(c) for c in (lon, lat, "x1", "y1", "x2", "y2")])
    near = stored(met.where(distance <= reach * reach).select("_line_key", *points.columns).distinct(), "near")
    return named.join(near, [*same, "_line_key"]).drop("_line_key")
