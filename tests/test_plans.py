from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from segflow.plans import conflate as join
from segflow.plans import evaluate, features, report
from segflow.sources.readers import as_counts, as_matches, as_segments

H = [datetime(2022, 5, 2, h) for h in range(24)]


def rows(spark, data, kind):
    return spark.createDataFrame(data, kind)


# ---- joins ------------------------------------------------------------------


def probe(spark, codes, hours, density="A"):
    return rows(spark, [(c, H[h], 50.0 + h, 10.0, density) for c in codes for h in hours],
                "tmc_code string, measurement_tstamp timestamp, speed double, travel_time_seconds double, data_density string")


def test_probe_suffixes(spark):
    a, b = probe(spark, ["x"], [1, 2]), probe(spark, ["x"], [2, 3])
    out = join.combine_probe(a, b, a)
    assert out.count() == 1
    assert out.columns[2:6] == ["speed_All", "travel_time_seconds_All", "data_density_All", "speed_Pass"]
    extra = b.drop("speed").withColumn("only", F.lit(1))
    legacy = join.combine_probe_legacy(a, extra, a).columns
    assert {"speed", "only", "data_density_All", "data_density_Pass", "speed_Truck"} <= set(legacy)


def segments(spark):
    raw = rows(spark, [("s1", "NORTHBOUND", "MA"), ("s2", "CLOCKWISE", "MA"), ("s3", "WESTBOUND", "RI")],
               "tmc string, direction string, state string")
    return as_segments(raw)


def counts(spark, data):
    return as_counts(rows(spark, data, "STATION_ID string, STATE_NAME string, COUNTY_NAME string, DIR double, YEAR int, "
                                       "MONTH int, DAY int, HOUR int, VOL double, F_SYSTEM double"))


def matches(spark, data):
    kind = "Tmc string, STATION_ID string, DIR int, County string, State string, LAT double, LONG double, tier int"
    return as_matches(rows(spark, [(t, s, 1, "c", "MA", 1.0, 2.0, 1) for t, s in data], kind))


def test_conflation_matches_all_four_keys(spark):
    p = probe(spark, ["s1", "s2", "s3"], [1, 2])
    m = matches(spark, [("s1", "007"), ("s1", "008"), ("s2", "007"), ("s3", "007"), ("s1", None)])
    c = counts(spark, [
        ("007", "MA", "Middlesex County", 1.0, 22, 5, 2, 1, 11.0, 3.0),
        ("007", "MA", "Middlesex County", 5.0, 22, 5, 2, 1, 99.0, 3.0),   # other direction
        ("007", "RI", "x", 1.0, 22, 5, 2, 2, 98.0, 3.0),                   # other state
        ("008", "MA", "x", 1.0, 22, 5, 2, 2, 12.0, 3.0),
        ("007", "MA", "x", None, 22, 5, 2, 1, 97.0, 3.0),                  # no direction: s2 has none either
        (None, "MA", "x", 1.0, 22, 5, 2, 1, 96.0, 3.0),
    ])
    out = join.conflate(p, p, p, segments(spark), m, c)
    assert sorted((r.tmc_code, r.STATION_ID, r.measurement_tstamp.hour, r.VOL) for r in out.collect()) == [
        ("s1", "007", 1, 11.0), ("s1", "008", 2, 12.0)]
    assert out.columns.count("DIR") == 1 and "station_f_system" in out.columns
    assert join.conflate(p, p, p, segments(spark)).count() == 6
    legacy = join.attach_counts_legacy(join.attach_stations(join.combine_probe(p, p, p), m, segments(spark)), c,
                                       "MA", "Middlesex County")
    assert legacy.count() == 6  # station and hour only: two counts at three segments


def test_conflation_never_adds_rows_for_unique_counts(spark):
    p = probe(spark, ["s1", "s3"], range(24))
    m = matches(spark, [("s1", "007"), ("s3", "008")])
    located = join.attach_stations(p, m, segments(spark))
    c = counts(spark, [(s, st, "x", d, 22, 5, 2, h, 1.0, 1.0) for s, st, d in (("007", "MA", 1.0), ("008", "RI", 7.0)) for h in range(24)])
    assert join.attach_counts(located, c).count() == located.count() == 48


def stations(spark):
    return rows(spark, [("001", "MA", 1, 3, 40.0, -70.0), ("001", "MA", 5, 3, 40.0, -70.0), ("001", "MA", 5, 3, 40.0, -70.0),
                        ("002", "MA", 3, 2, 40.0, -70.0), ("003", "MA", 1, 3, 40.01, -70.0)],
                "STATION_ID string, STATE_NAME string, DIR int, F_SYSTEM int, LAT double, LONG double")


def test_station_choice_and_match(spark):
    s = stations(spark)
    assert join.pick_stations(s).count() == 4
    only = join.pick_stations(s, parity=True)
    assert sorted((r.STATION_ID, r.DIR) for r in only.collect()) == [("001", 1), ("002", 3), ("003", 1)]
    line = "LINESTRING (-70.0005 40, -70 40, -69.9 40)"
    shapes = rows(spark, [("n", "NORTHBOUND", 3, "c", "MA", line), ("s", "SOUTHBOUND", 3, "c", None, line),
                          ("blank", "NORTHBOUND", 3, "c", " ", line), ("class", "EASTBOUND", 9, "c", "MA", line),
                          ("odd", "CLOCKWISE", 3, "c", "MA", line)],
                  "Tmc string, DIR string, F_System int, County string, State string, geometry string")
    out = join.match_stations(shapes, join.pick_stations(s))
    assert sorted((r.Tmc, r.STATION_ID, r.DIR, r.tier) for r in out.collect()) == [("n", "001", 1, 1), ("s", "001", 5, 1)]
    assert out.columns == ["Tmc", "STATION_ID", "DIR", "geometry", "County", "State", "LAT", "LONG", "tier"]
    assert join.match_stations(shapes, only).count() == 1
    assert join.near_stations(shapes, join.pick_stations(s)).count() == 15


def test_hold_out(spark):
    kept, removed = join.hold_out(matches(spark, [("a", "007"), ("b", "007"), ("c", "008")]),
                                  rows(spark, [("007",), ("009",), (None,)], "STATION_ID string"))
    assert [r.STATION_ID for r in kept.collect()] == ["008"] and [r.STATION_ID for r in removed.collect()] == ["007"]


def test_merge_predictions_with_and_without_variant(spark):
    raw = rows(spark, [("104P00001", H[3], 1, 7.0, 3), ("104+00001", H[3], 1, 8.0, 3)],
               "tmc_code string, measurement_tstamp timestamp, DIR int, VOL double, HOUR int")
    norm = rows(spark, [(10400001, v, 1, 2022, 5, 2, 3, 0, p) for v, p in ((0, 70), (3, 80))],
                "tmc_code long, TMC_Value int, DIR int, year int, month int, day int, hour int, measurement_tstamp long, Predicted_VOL int")
    out = join.merge_predictions(raw, norm).collect()
    assert sorted((r.tmc_code_raw, r.VOL, r.Predicted_VOL) for r in out) == [("104+00001", 8.0, 80), ("104P00001", 7.0, 70)]
    assert {"HOUR_raw", "hour_norm"} <= set(join.merge_predictions(raw, norm).columns)
    assert join.merge_predictions(raw, norm, parity=True).count() == 4


def test_county_lookup(spark):
    table = rows(spark, [("Worth County, MA", 5), ("Norfolk County, MA", 6), ("Norfolk City", 7)], "name string, population int")
    assert join.county_population(table, "norfolk").first().population == 7
    assert join.county_population(table, "nowhere").count() == 0


# ---- evaluation -------------------------------------------------------------

PRED = "tmc_code string, measurement_tstamp timestamp, VOL double, Predicted_VOL double, DIR int"


def predictions(spark, data):
    return rows(spark, [(f"t{i}", H[h], v, p, 1) for i, (h, v, p) in enumerate(data)], PRED)


def test_accuracy_treats_null_as_no_zero(spark):
    df = predictions(spark, [(8, 0.0, 5.0), (8, 5.0, 0.0), (8, 0.0, 0.0), (8, None, 3.0), (8, 100.0, 110.0), (2, 100.0, 80.0)])
    r = evaluate.accuracy(df).first()
    assert (r.zeros_vol, r.zeros_predicted, r.rows_with_zeros, r.rows_compared) == (2, 2, 3, 3)
    assert (r.mean_abs_diff_zeros, r.median_abs_diff_zeros) == (pytest.approx(10 / 3), 5.0)
    assert (r.percent_diff, r.percent_diff_day, r.percent_diff_night) == (15.0, 10.0, 20.0)
    within = {x.threshold: x.pct_within for x in evaluate.within_thresholds(df).collect()}
    assert within[5] == 0 and within[10] == pytest.approx(100 / 3) and within[20] == pytest.approx(200 / 3)


def test_threshold_is_closed_and_share_is_open(spark):
    df = predictions(spark, [(1, 100.0, 105.0), (1, 100000.0, 105000.1), (1, 100.0, 115.0)])
    within = {x.threshold: x.pct_within for x in evaluate.within_thresholds(df, [5, 15]).collect()}
    assert within[5] == pytest.approx(100 / 3) and within[15] == 100
    assert evaluate.fit_quality(df).first().pct_within == pytest.approx(200 / 3)


def test_quality_and_loss(spark):
    df = predictions(spark, [(1, 0.0, 1.0), (1, 10.0, 10.0), (1, 20.0, 1020.0)])
    r = evaluate.fit_quality(df).first()
    assert r.r2 == pytest.approx(1 - (1 + 0 + 1e6) / 200) and r.pct_within == pytest.approx(100 / 3)
    assert evaluate.huber_loss(df).first()[0] == pytest.approx((0.5 + 0 + 500 * 750) / 3)


def test_zero_share(spark):
    df = rows(spark, [("a", H[1], 0.0, 1.0, 1), ("a", H[2], 2.0, 1.0, 1), ("b", H[1], 0.0, 1.0, 1), ("c", H[1], 1.0, 1.0, 1),
                      ("d", H[1], 0.0, 1.0, 1)], PRED)
    r = evaluate.zero_share_summary(df, "VOL").first()
    assert (r.segments, r.avg_pct, r.min_pct, r.max_pct, r.max_tmc) == (3, pytest.approx(250 / 3), 50.0, 100.0, "b")
    none = evaluate.zero_share_summary(df, "Predicted_VOL").first()
    assert (none.segments, none.avg_pct, none.max_tmc) == (0, None, None)


def test_peaks_have_inclusive_ends(spark):
    hours = [(5, 100), (6, 1), (9, 3), (10, 200), (16, 7), (20, 300)]
    r = evaluate.peaks(predictions(spark, [(h, None, float(p)) for h, p in hours])).first()
    assert (r.avg_morning, r.median_morning, r.std_morning) == (2.0, 2.0, pytest.approx(2**0.5))
    assert (r.avg_evening, r.median_evening, r.std_evening) == (7.0, 7.0, None)
    assert (r.max_volume, r.max_volume_time) == (300.0, H[20])
    shown = {x.Metric: x.Value for x in evaluate.peak_table(predictions(spark, [(6, None, 2.0)])).collect()}
    assert shown["Average Morning Peak (6 AM - 9 AM)"] == "2.00"
    assert evaluate.peaks(predictions(spark, [(12, None, 2.0)])).first().median_evening is None


def test_largest_error_breaks_ties_by_key(spark):
    df = predictions(spark, [(3, 1.0, 9.0), (2, 9.0, 1.0), (1, None, 50.0)])
    r = evaluate.largest_error(df).first()
    assert (r.tmc_code, r.abs_error) == ("t0", 8.0)
    assert evaluate.largest_error(df.where("VOL is null")).count() == 0
    shown = {x.Metric: x.Value for x in evaluate.accuracy_table(df).collect()}
    assert shown["TMC Code of Maximum Difference"] == "t0" and shown["Time of Maximum Difference"] == "2022-05-02 03:00:00"


def test_profile_and_quintile(spark):
    df = predictions(spark, [(1, float(v), 0.0) for v in (1, 2, 3, 4, 5, 6)])
    assert evaluate.hour_profile(df, ["VOL"]).first().VOL == 3.5
    out = {r.VOL: r.quintile for r in evaluate.volume_quintile(df).collect()}
    assert out == {1.0: 1, 2.0: 2, 3.0: 3, 4.0: 4, 5.0: 5, 6.0: 5}


# ---- reports ----------------------------------------------------------------


def test_dataset_year(spark):
    one = rows(spark, [(datetime(2022, 1, 1),), (datetime(2022, 9, 1),)], "measurement_tstamp timestamp")
    assert report.dataset_year(one).first()[0] == "2022"
    two = one.union(rows(spark, [(datetime(2021, 1, 1),)], "measurement_tstamp timestamp"))
    assert report.dataset_year(two).first()[0] == "20212022"


def test_availability_and_months(spark):
    c = counts(spark, [("1", "MA", "x", 1.0, 22, m, 2, h, 1.0, 1.0) for m, h in ((1, 0), (1, 5), (3, 5))] + [
        (None, "MA", "x", 1.0, 22, 1, 2, 3, 1.0, 1.0)])
    months = report.months_present(c)
    assert months == [(22, 1), (22, 3)]
    assert [tuple(r) for r in report.availability_by_month(c, months).collect()] == [("1", 2, 1)]
    assert sorted(tuple(r) for r in report.availability_long(c).collect()) == [("1", 22, 1, 2), ("1", 22, 3, 1)]
    hours = report.availability_by_hour(c).first()
    assert (hours.h0, hours.h5, hours.h7) == (1, 2, 0)


def test_selections(spark):
    df = rows(spark, [("a", H[1], "MA"), ("a", H[2], "MA"), ("b", H[2], "RI"), ("b", H[3], "RI")],
              "tmc_code string, measurement_tstamp timestamp, State string")
    assert report.segments_where(df, "State", "MA").collect()[0].measurement_tstamp == H[1]
    between = report.segments_between(df, H[2], H[3]).collect()
    assert sorted((r.tmc_code, r.measurement_tstamp.hour) for r in between) == [("a", 2), ("b", 2)]
    assert report.segment_day(df, "a", date(2022, 5, 2)).count() == 2
    assert report.in_states(df, "State", []).count() == 4
    assert [r.day for r in report.segment_dates(df).collect()] == [date(2022, 5, 2)]
    assert report.map_columns(["start_latitude", "start_longitude"]) == ("start_latitude", "start_longitude")
    assert report.map_columns(["x"]) is None


def test_top_stations_keep_ties_at_the_maximum(spark):
    df = rows(spark, [("1", 5.0, H[1], "b"), ("1", 5.0, H[2], "a"), ("1", 5.0, H[1], "a"), ("1", 4.0, H[3], "a"), ("2", 9.0, H[1], "z"), (None, 99.0, H[1], "a")],
              "STATION_ID string, VOL double, measurement_tstamp timestamp, tmc_code string")
    assert [(r.STATION_ID, r.VOL) for r in report.top_stations(df, 2).collect()] == [("2", 9.0), ("1", 5.0)]
    # among equals the earlier hour comes first, then the smaller segment
    assert [(r.measurement_tstamp, r.tmc_code) for r in report.top_stations(df).collect()] == [(H[1], "z"), (H[1], "a"), (H[1], "b"), (H[2], "a")]


def test_sanity(spark):
    df = rows(spark, [(1.0, "a"), (1.0, "a"), (float("inf"), "b"), (None, "c"), (None, "c")], "x double, y string")
    r = report.sanity(df, ["x", "y"]).first()
    assert tuple(r) == (5, 2, 1, 2)


def test_importance_log(spark):
    log = rows(spark, [(1, 5.0, 1.0, 9.0, None), (2, 3.0, 4.0, 8.0, None)], "epoch int, a double, b double, b_before double, feature1 double")
    long = report.importance_long(log)
    assert long.count() == 8
    assert [r.feature for r in report.importance_ranked(long).collect()] == ["b", "a"]
    assert sorted((r.epoch, r.feature) for r in report.importance_top(long, 1).collect()) == [(1, "b"), (2, "b")]
    assert [r.feature for r in report.importance_mean(long, 2).collect()] == ["b_before", "a"]


# ---- features ---------------------------------------------------------------


def dataset(spark, hours, with_target=True):
    from segflow.schema import BASE_FEATURES

    base = rows(spark, [("104P00001", H[h], 1, float(h), None if h == 2 else "AB"[h % 2], i) for i, h in enumerate(hours)],
                "tmc_code string, measurement_tstamp timestamp, DIR int, speed_All double, data_density_All string, v int")
    out = base.withColumns({c: F.lit("A") if "density" in c else F.lit(1.0) for c in BASE_FEATURES if c not in base.columns})
    return out.withColumn("VOL", F.col("v").cast("double")) if with_target else out


def test_feature_chain_drops_series_ends_and_keeps_missing_density(spark):
    table = features.feature_table(dataset(spark, [1, 2, 5, 7]))
    out = {r.hour: r for r in table.collect()}
    assert sorted(out) == [2, 5] and len(table.columns) == 49
    assert (out[2].speed_All_before, out[2].speed_All_after) == (5.0, 1.0)
    assert (out[2].data_density_All, out[5].data_density_All, out[2].tmc_code, out[2].TMC_Value) == (1, 0, 10400001, 0)
    assert features.feature_table(dataset(spark, [1])).count() == 0
    assert "VOL" not in features.feature_table(dataset(spark, [1, 2, 3], False)).columns


def test_feature_steps_can_be_swapped(spark):
    steps = features.default_steps()
    steps["calendar"], last = (lambda df, old=steps["calendar"]: old(df).withColumn("noon", F.lit(12))), steps.pop("neighbours")
    steps["neighbours"] = last
    assert "noon" in features.feature_table(dataset(spark, [1, 2, 3]), steps).columns
