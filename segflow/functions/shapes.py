"""Well-known text lines and planar distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOMETRY_NAMES = ["geom", "the_geom", "geometry"]


def geometry_column(columns: list[str]) -> str:
    """Name of the geometry column: ``geometry``, else the first other known name."""
    if "geometry" in columns:
        return "geometry"
    for name in GEOMETRY_NAMES:
        if name in columns:
            return name
    raise ValueError(f"no geometry column among {columns}")


def parse_lines(wkt: Column) -> Column:
    """LINESTRING or MULTILINESTRING text to ``array<array<struct<lon,lat>>>``;
    other geometry kinds give null."""
    text = F.upper(F.trim(wkt))
    body = F.regexp_extract(text, r"^(?:MULTI)?LINESTRING\s*(?:Z\s*)?\(+\s*(.*?)\s*\)+$", 1)
    lines = F.transform(F.split(body, r"\s*\)\s*,\s*\(\s*"), lambda line: F.split(line, r"\s*,\s*"))

    def vertex(text: Column) -> Column:
        parts = F.split(text, r"\s+")
        return F.struct(parts[0].cast("double").alias("lon"), parts[1].cast("double").alias("lat"))

    parsed = F.transform(lines, lambda line: F.transform(line, vertex))
    return F.when(body != "", parsed)


def vertices(df: DataFrame, wkt: str, keep: list[str]) -> DataFrame:
    """One row per vertex: ``keep`` columns, line and vertex number, lon, lat."""
    lines = df.select(*keep, F.posexplode(parse_lines(F.col(wkt))).alias("line_no", "line"))
    points = lines.select(*keep, "line_no", F.posexplode("line").alias("vertex_no", "p"))
    return points.select(*keep, "line_no", "vertex_no", "p.lon", "p.lat")


def pieces(df: DataFrame, wkt: str, keep: list[str]) -> DataFrame:
    """One row per straight piece of each line, as ``x1, y1, x2, y2`` next to
    the ``keep`` columns. A line of one vertex is a piece of length zero."""
    lines = df.select(*keep, F.explode(parse_lines(F.col(wkt))).alias("_line"))
    last = F.greatest(F.size("_line") - 1, F.lit(1))
    pairs = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(
            F.col("_line")[i - 1].alias("a"),
            F.col("_line")[F.least(i, F.size("_line") - 1)].alias("b"),
        ),
    )
    split = lines.select(*keep, F.explode(pairs).alias("_piece"))
    return split.select(
        *keep,
        F.col("_piece.a.lon").alias("x1"),
        F.col("_piece.a.lat").alias("y1"),
        F.col("_piece.b.lon").alias("x2"),
        F.col("_piece.b.lat").alias("y2"),
    )


def squared_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared planar distance from a point to a piece, in squared degrees."""
    dx, dy = x2 - x1, y2 - y1
    along = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey
