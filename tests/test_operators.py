import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from segflow.operators import histograms, rank, spatial
from segflow.operators.neighbours import with_hour_neighbours, with_neighbours
from segflow.operators.substring import first_containing
from segflow.standins import StandIns


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [100, 3])
def test_neighbours_are_rows_and_names_are_inverted(spark, hot):
    hours = [("a", 1), ("a", 2), ("a", 5), ("b", 1), ("a", 30), ("a", 31), ("a", 400)]
    df = spark.createDataFrame([(k, h * 3600, float(h)) for k, h in hours], "k string, t long, v double")
    out = {(r.k, r.t // 3600): (r.v_before, r.v_after) for r in with_neighbours(df, ["k"], "t", ["v"], hot=hot).collect()}
    assert out == {
        ("a", 1): (2.0, None), ("a", 2): (5.0, 1.0), ("a", 5): (30.0, 2.0), ("a", 30): (31.0, 5.0),
        ("a", 31): (400.0, 30.0), ("a", 400): (None, 31.0), ("b", 1): (None, None),
    }


def test_neighbours_keep_null_values_and_match_plain_windows(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"s{i % 7}", i * 1800 + rng.randrange(600), rng.choice([None, 1.0, 2.0]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t long, v double, i long")
    df = df.withColumn("k", F.when(F.col("k") != "s1", F.col("k")))  # a null key is no series
    got = with_neighbours(df, ["k"], "t", ["v", "t"], hot=500)
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy("t")
    near = {"v_before": F.lead("v"), "v_after": F.lag("v"), "t_before": F.lead("t"), "t_after": F.lag("t")}
    want = df.select("*", *[F.when(F.col("k").isNotNull(), x.over(w)).alias(name) for name, x in near.items()])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == len(rows)


def test_crowded_spans_count_copies(spark):
    rows = [("hot", 3600, 1.0)] * 40 + [("hot", 7200, 2.0)] * 3 + [("hot", 90000, 3.0), ("cold", 3600, 9.0), ("cold", 7200, 8.0)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    plain = with_neighbours(df, ["k"], "t", ["v"])
    counted = with_neighbours(df, ["k"], "t", ["v"], hot=10)
    assert counted.columns == plain.columns
    assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))


def test_copies_are_expanded_in_blocks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 3)], "k string, n long")
    out = rank.expand_copies(df, "n", "i", block=3).collect()
    assert sorted((r.k, r.i) for r in out) == [("a", i) for i in range(7)] + [("b", 0)] + [("c", i) for i in range(3)]


def test_row_numbers_of_copies(spark):
    df = spark.createDataFrame([("x",)] * 50 + [(str(i),) for i in range(20)], "v string").withColumn("h", F.md5("v"))
    rows = rank.with_row_number(df, "h").collect()
    assert sorted(r.row_no for r in rows) == list(range(70))
    order = [r.h for r in sorted(rows, key=lambda r: r.row_no)]
    assert order == sorted(order)


def test_row_numbers_are_dense_and_ordered(spark):
    df = spark.range(5000).withColumn("h", F.md5(F.col("id").cast("string")))
    rows = rank.with_row_number(df, "h").orderBy("h").collect()
    assert [r.row_no for r in rows] == list(range(5000))


@pytest.mark.parametrize("spread", ["ints", "wide", "one", "negative"])
def test_percentiles_equal_numpy(spark, spread):
    rng = np.random.default_rng(3)
    values = {
        "ints": rng.integers(0, 50, 999).astype(float),
        "wide": 10 ** rng.uniform(-8, 12, 1000),
        "one": np.array([7.0]),
        "negative": rng.normal(0, 100, 501),
    }[spread]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = [0.0, 0.2, 0.5, 0.77, 1.0]
    out = {r.prob: r.value for r in rank.exact_percentiles(df, "v", probs).collect()}
    np.testing.assert_allclose([out[p] for p in probs], np.percentile(values, [100 * p for p in probs]), rtol=1e-12)


def test_percentiles_by_group_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", None)], "g string, v double")
    out = {r.g: r.value for r in rank.exact_percentiles(df, "v", [0.5], ["g"]).collect()}
    assert out == {"a": 1.5, "b": 5.0}
    assert rank.exact_percentiles(df.where("false"), "v", [0.5]).count() == 0


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    first = rank.first_per_key(df, ["k"], ["o"])
    assert {(r.k, r.v) for r in first.collect()} == {("a", "y"), ("b", "z")}
    assert "WindowGroupLimit" in plan_of(first).split("Exchange")[-1]


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    a = {r.k for r in rank.sample_by_hash(df, 50, ["k"]).collect()}
    b = {r.k for r in rank.sample_by_hash(df.repartition(13), 50, ["k"]).collect()}
    assert a == b and len(a) == 50
    assert {r.k for r in rank.sample_by_hash(df, 50, ["k"], seed=7).collect()} != a
    assert rank.sample_by_hash(df.limit(3), 50, ["k"]).count() == 3


def test_split_share(spark):
    df = spark.range(20000).withColumn("t", rank.in_test_share("id"))
    assert abs(df.where("t").count() / 20000 - 0.1) < 0.01


def test_equal_width_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]] + [(None,)], "v double")
    out = histograms.equal_width_histogram(df, "v", 5).orderBy("bin").collect()
    assert [r.n for r in out] == list(np.histogram(range(11), 5)[0])
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r.n for r in histograms.equal_width_histogram(same, "v", 2).orderBy("bin").collect()] == [0, 2]
    assert histograms.equal_width_histogram(df.where("false"), "v", 5).count() == 0


def test_fixed_width_histogram_drops_what_is_outside(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 9.9, 10.0, 30.0, 30.1, -1.0, float("nan"), None]], "v double")
    out = histograms.fixed_width_histogram(df, "v", 10, 30).orderBy("lower").collect()
    assert [(r.lower, r.n) for r in out] == [(0.0, 2), (10.0, 1), (20.0, 1)]


def _text(points):
    return "LINESTRING (" + ", ".join(f"{x!r} {y!r}" for x, y in points) + ")"


def _distance(p, line):
    best = 1e9
    for (x1, y1), (x2, y2) in zip(line, line[1:] or line):
        dx, dy = x2 - x1, y2 - y1
        size = dx * dx + dy * dy
        t = min(1, max(0, ((p[0] - x1) * dx + (p[1] - y1) * dy) / size)) if size else 0
        best = min(best, (p[0] - x1 - t * dx) ** 2 + (p[1] - y1 - t * dy) ** 2)
    return best**0.5


@pytest.mark.parametrize("few,per_block", [(100_000, 2000), (0, 2000), (0, 3)])
def test_spatial_join_equals_brute_force(spark, monkeypatch, few, per_block):
    monkeypatch.setattr(spatial, "FEW_POINTS", few)
    rng = random.Random(5)
    reach = 0.001
    lines = []
    for _ in range(60):
        x, y = rng.uniform(-100.02, -100), rng.uniform(40, 40.02)
        line = [(x, y)]
        for _ in range(rng.randrange(0, 5)):
            x, y = (v + rng.choice([0, rng.uniform(-0.006, 0.006), 1e-15]) for v in (x, y))
            line.append((x, y))
        lines.append(line)
    points = [(rng.uniform(-100.03, -99.99), rng.uniform(39.99, 40.03)) for _ in range(300)]
    points += [(-100.01 + rng.uniform(0, 1e-4), 40.01) for _ in range(60)]  # a crowded cell
    left = spark.createDataFrame([(i, _text(l)) for i, l in enumerate(lines)], "line int, wkt string")
    right = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "point int, lon double, lat double")
    got = spatial.lines_near_points(left, right, "wkt", "lon", "lat", reach, per_block=per_block)
    pairs = [(r.line, r.point) for r in got.collect()]
    want = {(i, j) for i, l in enumerate(lines) for j, p in enumerate(points) if _distance(p, l) <= reach}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 100
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_spatial_edges(spark):
    lines = spark.createDataFrame(
        [("flat", "LINESTRING (0 0, 1 0)"), ("dot", "LINESTRING (5 5, 5 5)"),
         ("multi", "MULTILINESTRING ((0 3, 1 3), (1 3, 1 4))")], "id string, wkt string")
    points = spark.createDataFrame(
        [("on", 0.5, 0.0), ("end", 1.0, 0.0), ("off", 0.5, 0.25), ("beyond", 0.5, 0.2500001), ("dot", 5.0, 5.2),
         ("bend", 1.0, 3.0), ("none", None, 1.0)], "p string, lon double, lat double")
    got = spatial.lines_near_points(lines, points, "wkt", "lon", "lat", 0.25).collect()
    assert sorted((r.id, r.p) for r in got) == [
        ("dot", "dot"), ("flat", "end"), ("flat", "off"), ("flat", "on"), ("multi", "bend")]


def test_copies_of_a_line_all_match(spark):
    lines = spark.createDataFrame([("a", "LINESTRING (0 0, 1 0)")] * 2, "id string, wkt string")
    points = spark.createDataFrame([("p", 0.5, 0.0)], "p string, lon double, lat double")
    assert spatial.lines_near_points(lines, points, "wkt", "lon", "lat", 0.25).count() == 2


def test_long_diagonal_stays_near_its_cells(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], "x1 double, y1 double, x2 double, y2 double")
    cells = spatial.piece_cells(df, 0.001, 0.002).count()
    assert 500 < cells < 5000  # its box would be 250,000 cells


def test_narrow_ranges_of_values_use_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(rank, "CROWD", 500)
    rng = random.Random(4)
    near_zero = [(rng.random() * 0.002,) for _ in range(6000)]
    seconds = [(1.7e9 + rng.random() * 1e6,) for _ in range(6000)]
    for rows in (near_zero, seconds, near_zero + seconds):
        df = spark.createDataFrame(rows, "v double")
        found = {r.prob: r.value for r in rank.exact_percentiles(df, "v", [0.1, 0.5, 0.77]).collect()}
        for p, value in found.items():
            assert value == pytest.approx(float(np.quantile([x for x, in rows], p)), rel=1e-12)
        counted = df.groupBy(F.col("v").alias("_v")).count().withColumn("_b", rank._value_bucket(F.col("_v")))
        sizes = [r["count"] for r in rank._refined(counted.drop("count"), []).groupBy("_b", "_s").count().collect()]
        assert max(sizes) < 1200 and len(sizes) >= 10


def test_hour_neighbours_stop_at_gaps(spark):
    rng = random.Random(4)
    hours = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0), ("a", 4, 3.0), ("a", 5, None), ("a", 23, 23.0), ("a", 24, 24.0), ("a", -1, 9.0), ("a", 0, 0.0), (None, 1, 5.0), (None, 2, 5.0), ("a", None, 5.0)]
    hours += [("b", rng.randrange(400), float(i)) for i in range(300)] + [("c", 7, 1.0)] * 20 + [("c", 8, 2.0)]
    df = spark.createDataFrame([(k, None if h is None else h * 3600, v, i) for i, (k, h, v) in enumerate(hours)], "k string, t long, v double, i int")
    got = with_hour_neighbours(df, ["k"], "t", ["v", "i"], span=86_400)
    assert got.columns == ["k", "t", "v", "i", "v_before", "v_after", "i_before", "i_after"]
    at = {}
    for i, (k, h, v) in enumerate(hours):
        at.setdefault((k, h), []).append((v is not None, v, i))
    near = lambda k, h: min(at.get((k, h), [(None, None, None)]))[1:] if k is not None else (None, None)
    rows = sorted(got.collect(), key=lambda r: r.i)
    assert [r.i for r in rows] == list(range(len(hours)))
    for r, (k, h, _) in zip(rows, hours):
        none = (None, None)
        assert (r.v_before, r.i_before) == (near(k, h + 1) if h is not None else none)
        assert (r.v_after, r.i_after) == (near(k, h - 1) if h is not None else none)


def test_first_containing_equals_a_plain_search(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abÄ %_. ") for _ in range(n))
    places = [(word(rng.randrange(12)), i) for i in range(80)] + [(None, 1), ("", 2), ("", 1), ("Norfolk County, MA", 6), ("Norfolk City", 7)]
    texts = [word(rng.randrange(6)) for _ in range(150)] + [None, "", "NORFOLK", "folk co", "zz", "norfolk city and more", "a" * 40] + ["ab"] * 30
    table = spark.createDataFrame(places, "name string, population int")
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = first_containing(rows, "t", table, "name", "found_")
    assert found.columns == ["id", "t", "found_name", "found_population"]
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = sorted(found.collect(), key=lambda r: r.id)
    assert [r.id for r in got] == list(range(len(texts)))
    for r in got:
        hits = sorted((n, p) for n, p in places if n is not None and r.t is not None and r.t.lower() in n.lower())
        assert (r.found_name, r.found_population) == (hits[0] if hits else (None, None))
    assert first_containing(rows, "t", table.limit(0), "name", "found_").where("found_name is not null").count() == 0


def test_an_outlier_does_not_crowd_a_bucket(spark):
    tiny = spark.range(400_000).select((F.col("id") * 1e-15).alias("v")).unionByName(spark.createDataFrame([(0.0025,)], "v double"))
    high = tiny.select((0.0025 - F.col("v")).alias("v"))
    for df in (tiny, high):
        counted = df.select(F.col("v").alias("_v"), F.lit(1).alias("_c")).withColumn("_b", rank._value_bucket(F.col("_v")))
        sizes = [r["count"] for r in rank._refined(counted, []).groupBy("_b", "_s").count().collect()]
        assert max(sizes) <= 400_000 / 8
        values = np.sort(np.array([r.v for r in df.collect()]))
        got = {r.prob: r.value for r in rank.exact_percentiles(df, "v", [0.0, 0.3, 0.5, 1.0]).collect()}
        assert all(got[p] == pytest.approx(np.percentile(values, 100 * p), rel=1e-12, abs=1e-20) for p in got)


def test_lines_fetch_the_pairs_found_from_their_files(spark):
    lines = spark.createDataFrame([("a", "LINESTRING (0 0, 1 1)")], "name string, wkt string")
    points = spark.createDataFrame([(0.5, 0.5)], "lon double, lat double")
    got = spatial.lines_near_points(lines, points, "wkt", "lon", "lat", 0.01)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 1 and "Generate" not in text and "FileScan parquet" in text


def test_segments_are_dealt_to_all_tasks(spark, tmp_path):
    spark.range(20).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    t = StandIns(spark, str(tmp_path))
    assert t.shape.count() == 20
    assert t.shape.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
