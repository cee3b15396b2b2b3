from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segflow import schema
from segflow.functions import codes, shapes, times
from segflow.operators.tables import coerce_numeric, drop_blank, metric_rows, union_all


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_segment_variant_and_number(spark):
    values = ["104P00001", "104N00001", "104+00001", "104-00001", "104x", "10400001", "104+p1"]
    rows = column(spark, values).select(codes.segment_variant(F.col("v"))).collect()
    assert [r[0] for r in rows] == [0, 1, 3, 2, -1, -1, 0]
    rows = column(spark, values[:4] + ["10400001"]).select(codes.segment_number(F.col("v"))).collect()
    assert {r[0] for r in rows} == {10400001}
    with pytest.raises(PySparkException):
        column(spark, ["104x"]).select(codes.segment_number(F.col("v"))).collect()


def test_directions(spark):
    rows = column(spark, ["EASTBOUND", "CLOCKWISE", None, "WESTBOUND"]).select(codes.direction_code(F.col("v"))).collect()
    assert [r[0] for r in rows] == [3, None, None, 7]
    letters = column(spark, ["S", "X"]).select(codes.direction_code(F.col("v"), schema.DIRECTION_LETTERS)).collect()
    assert [r[0] for r in letters] == [5, None]


@pytest.mark.parametrize("limit", [1000, 0])
def test_categories_keep_missing_and_unknown(spark, monkeypatch, limit):
    monkeypatch.setattr(codes, "MAP_LIMIT", limit)
    known = spark.createDataFrame([("B", "x"), ("A", "x"), (None, "y")], "a string, b string")
    index = codes.category_index(known, ["a", "b"])
    rows = spark.createDataFrame([(1, "A", "x"), (2, "B", "y"), (3, None, None), (4, "Z", "z")], "i int, a string, b string")
    out = {r.i: (r.a, r.b) for r in codes.encode_categories(rows, ["a", "b"], index).collect()}
    assert out == {1: (0, 0), 2: (1, 1), 3: (2, 2), 4: (2, 2)}


def test_calendar(spark):
    rows = column(spark, [datetime(2024, 1, 1, 5), datetime(2024, 1, 7, 23), None], "timestamp")
    out = times.with_calendar(rows, "v").orderBy("v").collect()
    assert [(r.dayofweek, r.hour, r.v) for r in out] == [(0, 5, 1704085200), (6, 23, 1704668400)]


def test_count_time_and_zoned_epoch(spark):
    row = spark.range(1).select(
        times.count_timestamp(F.lit(22), F.lit(3), F.lit(13), F.lit(2)).alias("t"),
        times.epoch_seconds(F.lit("2023-01-15 00:00:00-05:00")).alias("e"),
        times.epoch_seconds(F.lit("soon")).alias("bad"),
    ).first()
    assert (row.t, row.e, row.bad) == (datetime(2022, 3, 13, 2), 1673758800, None)


def test_feature_list():
    columns = schema.feature_columns()
    assert len(columns) == len(set(columns)) == 48
    assert columns[20:28] == ["TMC_Value", "year", "month", "day", "hour", "dayofweek", "measurement_tstamp_before", "measurement_tstamp_after"]
    assert columns[28:36] == [
        "speed_All_before", "speed_All_after", "travel_time_seconds_All_before", "travel_time_seconds_All_after",
        "data_density_All_before", "data_density_All_after", "data_density_Pass_before", "data_density_Pass_after",
    ]


def test_lines_of_text(spark):
    df = column(spark, [
        "LINESTRING (1 2, 3 4)", "linestring(1 2,3 4,5 6)", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 4))",
        "LINESTRING Z (1 2 9, 3 4 9)", "POINT (1 2)", None,
    ])
    out = [[len(line) for line in r[0]] if r[0] else None for r in df.select(shapes.parse_lines(F.col("v"))).collect()]
    assert out == [[2], [3], [2, 3], [2], None, None]
    assert shapes.pieces(df, "v", []).count() == 1 + 2 + 1 + 2 + 1
    assert shapes.geometry_column(["a", "the_geom"]) == "the_geom"
    with pytest.raises(ValueError):
        shapes.geometry_column(["a"])


def test_distance_to_zero_length_piece(spark):
    d = spark.range(1).select(shapes.squared_distance(*[F.lit(float(x)) for x in (3, 4, 0, 0, 0, 0)])).first()[0]
    assert d == 25


def test_blank_numeric_union_metric(spark):
    states = drop_blank(column(spark, ["", " ", None, "MA"]), "v").collect()
    assert [r.v for r in states] == [None, "MA"]
    assert [r.v for r in coerce_numeric(column(spark, ["1.5", "x", None])).collect()] == [1.5, None, None]
    both = union_all([spark.range(1).toDF("a"), spark.range(2).toDF("b")])
    assert both.columns == ["a", "b"] and both.count() == 3
    shown = metric_rows(spark.range(1), {"n": F.col("id"), "share": F.format_string("%.2f%%", F.lit(2.5))}).collect()
    assert [(r.Metric, r.Value) for r in shown] == [("n", "0"), ("share", "2.50%")]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        schema.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"])
