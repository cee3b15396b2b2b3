"""From CSV files to results, with the smallest test tables as sources."""

import json

import pytest
from pyspark.sql import functions as F

from segflow.model.network import NetworkScorer, Settings
from segflow.model.regress import LinearScorer, fit_linear
from segflow.model.store import load_model
from segflow.plans import flows
from segflow.plans.conflate import merge_predictions
from segflow.plans.evaluate import hold_out_table
from segflow.plans.features import feature_table
from segflow.sources import readers, writers
from segflow.standins import StandIns


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    t = StandIns(spark, "/root/testdata/sf0.001")
    for name in ("probe_all", "probe_pass", "probe_truck", "segment_id", "station", "count_file", "shape"):
        writers.write_table(getattr(t, name), f"{root}/{name}.csv")
    return str(root)


def sources(files, **more):
    return flows.Sources(*[f"{files}/{n}.csv" for n in ("probe_all", "probe_pass", "probe_truck", "segment_id")], **more)


def test_sources_are_checked(spark, files):
    with pytest.raises(ValueError, match="matches, counts"):
        flows.generate(spark, sources(files), "unused", training=True)
    sources(files).require(training=False)


def test_whole_way(spark, files):
    found = flows.match_files(spark, f"{files}/shape.csv", f"{files}/station.csv", f"{files}/match")
    assert found.count() == spark.read.text(f"{files}/match_pure").count() == 7
    assert flows.match_files(spark, f"{files}/shape.csv", f"{files}/station.csv", f"{files}/few", n=2).count() <= 2

    full = sources(files, matches=f"{files}/match.csv", counts=f"{files}/count_file.csv")
    dataset = flows.generate(spark, full, f"{files}/train.parquet", training=True)
    assert dataset.count() == 230 and "VOL" in dataset.columns
    by_station = readers.dataset_folder(spark, f"{files}/train.parquet_stations")
    assert by_station.count() == 230 and {r.year for r in by_station.select("year").distinct().collect()} == {"2024"}

    kept, removed = flows.hold_out_matches(spark, f"{files}/match.csv", [f"{files}/train.parquet_stations"], f"{files}/match_2.csv")
    trained = {r.STATION_ID for r in dataset.select("STATION_ID").distinct().collect()}
    assert {r.STATION_ID for r in removed.collect()} == trained and kept == found.where(~found.STATION_ID.isin(trained)).count()

    best, measures = flows.train(spark, by_station, f"{files}/m1", learners=[fit_linear])
    assert measures.count() == 1 and isinstance(best.model, LinearScorer)
    assert writers.list_models(spark, files)[0].endswith("m1.model")
    assert len(json.loads(spark.read.text(f"{files}/m1_params").first()[0])["features"]) == 48
    assert spark.read.parquet(f"{files}/m1_featureimportance").count() == 48

    trained = load_model(spark, f"{files}/m1.model")
    assert isinstance(trained.model, LinearScorer) and trained.index.count() == 8
    with_counts = flows.predict(dataset, trained)
    assert {"VOL", "Predicted_VOL", "tmc_code_raw"} <= set(with_counts.columns)
    assert flows.results(with_counts).count() == 10
    assert hold_out_table(with_counts).count() == 29
    # on one station a segment and hour the join finds the same rows, on two it multiplies
    def merged(rows):
        return merge_predictions(rows, trained.model.predict(feature_table(rows, index=trained.index)))

    joined = merged(dataset)
    assert sorted(joined.columns) == sorted(with_counts.columns) and joined.count() == with_counts.count()
    twice = dataset.unionByName(dataset.withColumns({"STATION_ID": F.lit("other"), "VOL": F.col("VOL") + 1}))
    complete = feature_table(twice, index=trained.index).count()
    assert flows.predict(twice, trained).count() == complete and merged(twice).count() == 2 * complete
    # a dataset that lacks a category keeps the codes of the others
    lacking = flows.predict(dataset.where("coalesce(data_density_All, '') != 'A'"), trained)
    code = "data_density_All_norm"
    assert lacking.select(code).distinct().count() < with_counts.select(code).distinct().count()
    pairs = lambda df: {tuple(r) for r in df.select("data_density_All_raw", code).distinct().collect()}
    assert pairs(lacking) < pairs(with_counts)

    settings = Settings(width=8, epochs=2, test_interval=1)
    network, losses = flows.train_network(spark, dataset, f"{files}/n1", settings)
    stored_network = load_model(spark, f"{files}/n1.model").model
    assert len(losses) == 2 and isinstance(stored_network, NetworkScorer) and stored_network.scaler == network.model.scaler
    assert spark.read.parquet(f"{files}/n1_featureimportance").groupBy("epoch").count().count() == 2
    assert json.loads(spark.read.text(f"{files}/n1_params").first()[0])["width"] == 8

    flows.generate(spark, sources(files), f"{files}/infer.parquet", training=False)
    written = flows.predict_files(spark, f"{files}/infer.parquet", f"{files}/m1.model", files, "infer")
    assert written.count() > 230 and "VOL" not in written.columns
    assert flows.results(written).count() == 2
    assert spark.read.option("header", True).csv(f"{files}/infer_predictions.csv").count() == written.count()
