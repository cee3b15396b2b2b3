"""What the plans of the main operators look like when nothing is small."""

from datetime import date

import pytest

from segflow.plans import conflate as join
from segflow.plans import features, report
from segflow.registry import _dataset, _segments, _tier1
from segflow.session import stored
from segflow.sources import readers, writers
from segflow.standins import StandIns


@pytest.fixture(scope="module")
def tables(spark):
    t = StandIns(spark, "/root/testdata/sf0.001")
    names = {n: stored(getattr(t, n), n) for n in ("probe_all", "probe_pass", "probe_truck", "count_hourly")}
    names |= {"segments": stored(_segments(t), "segments"), "tier1": stored(_tier1(t), "tier1")}
    names["dataset"] = stored(_dataset(t), "dataset")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, -1)
    yield names
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return text.count("Exchange hashpartitioning")


def test_probe_tables_are_shuffled_once_each(tables):
    text = plan(join.combine_probe(tables["probe_all"], tables["probe_pass"], tables["probe_truck"]))
    assert shuffles(text) == 3 and text.count("SortMergeJoin") == 2


def test_probe_tables_are_cut_down_before_their_join(tables):
    out = join.conflate(tables["probe_all"], tables["probe_pass"], tables["probe_truck"], tables["segments"],
                        readers.as_matches(tables["tier1"]), readers.as_counts(tables["count_hourly"]))
    assert plan(out).count("LeftSemi") == 3 and out.count() == 230


def test_neighbours_take_one_shuffle(tables):
    rows = features.with_calendar(features.code_step(tables["dataset"]))
    text = plan(features.neighbour_step(rows))
    assert shuffles(text) == 1 and text.count("Window [") == 1


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(report.segment_day(tables["probe_all"], "104P00003", date(2024, 1, 10)).select("speed"))
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "EqualTo(tmc_code,104P00003)" in pushed and "GreaterThanOrEq" in pushed  # long lists are cut
    assert "travel_time" not in text.split("ReadSchema")[1]


def test_station_folders_are_pruned(spark, tables, tmp_path):
    writers.write_by_station(tables["dataset"], str(tmp_path / "d"), "2024")
    text = plan(readers.dataset_folder(spark, str(tmp_path / "d")).where("STATION_ID = '000003' and year = '2024'"))
    assert "STATION_ID" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_global_numbers_come_from_partial_aggregates(tables):
    text = plan(report.hourly_by_weekday(tables["dataset"]))
    assert "partial_avg" in text.split("Exchange")[-1]


def test_a_hot_segment_is_split_in_the_join(spark, tables):
    from pyspark.sql import functions as F

    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        code = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string"))
        probe = spark.range(0, 300_000, 1, 8).select(code.alias("tmc_code"), F.xxhash64("id").alias("v"))
        segments = spark.range(500).select(F.col("id").cast("string").alias("tmc_code"), F.lit("MA").alias("state"))
        segments = segments.unionByName(spark.sql("select 'hot' as tmc_code, 'RI' as state"))
        out = join.attach_segments(probe, segments).agg(F.count("state").alias("n"), F.count("v").alias("m"))
        assert out.first().n == 300_000
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
