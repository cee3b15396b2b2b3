import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from segflow import schema
from segflow.session import scratch_path, shared_folder, size_shuffle, stored
from segflow.sources import parts, readers, writers


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_counts_keep_text_ids_and_types(spark, tmp_path):
    names = schema.COUNT.names
    values = {"STATION_ID": "000123", "YEAR": "22", "MONTH": "5", "DAY": "2", "HOUR": "3", "VOL": "7", "DIR": "1", "STATE_NAME": "MA"}
    path = put(tmp_path / "c.csv", ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    raw = readers.raw_counts(spark, path)
    assert raw.schema == schema.COUNT and raw.first().STATION_ID == "000123"
    row = readers.counts(spark, path).first()
    assert (str(row.measurement_tstamp), row.state, row.DIR, row.count_state_code) == ("2022-05-02 03:00:00", "MA", 1, None)


def test_probe_and_segments(spark, tmp_path):
    path = put(tmp_path / "p.csv", "tmc_code,measurement_tstamp,speed,travel_time_seconds,data_density\n"
                                   "104+04680,2022-03-13 02:00:00,55,12.5,\n")
    row = readers.probe(spark, path).first()
    assert (row.speed, row.average_speed, row.data_density, row.measurement_tstamp.hour) == (55.0, None, None, 2)
    path = put(tmp_path / "s.csv", "tmc,direction,state,zip,extra\n104P1,EASTBOUND,MA,2139,z\n")
    row = readers.segments(spark, path).first()
    assert (row.tmc_code, row.DIR, row.zip) == ("104P1", 3, 2139) and "extra" not in row


def test_bad_values_are_errors(spark, tmp_path):
    path = put(tmp_path / "p.csv", "tmc_code,speed\nx,fast\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.probe(spark, path).collect()


def test_shapes_align_by_name(spark, tmp_path):
    put(tmp_path / "shp/a.csv", 'Tmc,DIR,F_System,County,State,geometry\na,NORTHBOUND,1,c,MA,"LINESTRING (0 1, 2 3)"\n')
    put(tmp_path / "shp/deep/b.csv", 'geometry,State,Tmc,DIR,F_System,County,more\n"LINESTRING (4 5, 6 7)",RI,b,SOUTHBOUND,2,d,1\n')
    put(tmp_path / "shp/deep/c.csv", 'the_geom,State,Tmc\n"LINESTRING (4 5, 6 7)",,c\n')
    put(tmp_path / "shp/note.txt", "not a table")
    out = {r.Tmc: (r.State, r.F_System, r.geometry) for r in readers.shapes(spark, str(tmp_path / "shp")).collect()}
    assert out == {"a": ("MA", 1, "LINESTRING (0 1, 2 3)"), "b": ("RI", 2, "LINESTRING (4 5, 6 7)"),
                   "c": (None, None, "LINESTRING (4 5, 6 7)")}
    put(tmp_path / "bare/a.csv", "Tmc,DIR\na,NORTHBOUND\n")
    with pytest.raises(ValueError, match="geometry"):
        readers.shapes(spark, str(tmp_path / "bare"))
    os.makedirs(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        readers.shapes(spark, str(tmp_path / "empty"))


def test_one_header_is_enforced(spark, tmp_path):
    put(tmp_path / "m/a.csv", "tmc_code,speed\nx,1\n")
    put(tmp_path / "m/b.csv", "speed,tmc_code\n2,y\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.probe(spark, str(tmp_path / "m")).collect()


def located(spark):
    return spark.createDataFrame(
        [("007", "MA", "104P1", 1.0), ("007", "MA", "104P2", 2.0), ("010", "RI", "104P1", 3.0)],
        "STATION_ID string, state string, tmc_code string, VOL double")


def test_station_folders_keep_leading_zeros(spark, tmp_path):
    writers.write_by_station(located(spark), str(tmp_path / "d"), "2022")
    assert os.path.isdir(tmp_path / "d/year=2022/STATION_ID=007/state=MA")
    back = readers.dataset_folder(spark, str(tmp_path / "d"))
    assert sorted(r.STATION_ID for r in back.collect()) == ["007", "007", "010"]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    keys = ["tmc_code", "hour"]
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("tmc_code"), (F.col("id") % 20).alias("hour"), "id")
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a, b = (writers.write_bucketed(df, f"probe_{n}", keys, 4, str(tmp_path / n)) for n in "ab")
        joined = a.join(b.withColumnRenamed("id", "other"), keys)
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == df.join(df.withColumnRenamed("id", "other"), keys).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        for n in "ab":
            spark.sql(f"drop table if exists probe_{n}")


def test_shuffle_follows_the_input(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr("segflow.session.TASK_BYTES", 10)
    path = put(tmp_path / "x/f.csv", "a" * 1000)
    try:
        assert size_shuffle(spark, [path, str(tmp_path / "x")]) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dataset_by_suffix_and_rebuild(spark, tmp_path):
    for name in ("d.parquet", "d.csv"):
        path = str(tmp_path / name)
        made = []

        def build():
            made.append(1)
            return located(spark)

        for _ in range(2):
            assert readers.dataset(spark, path, build).count() == 3
        assert len(made) == 1
        assert readers.dataset(spark, path, build, refresh=True).first().STATION_ID in ("007", "010")
        assert len(made) == 2
    with pytest.raises(PySparkException):
        readers.dataset(spark, str(tmp_path / "none"))


def test_ids(spark, tmp_path):
    found = spark.createDataFrame([(f"t{i}", str(i)) for i in range(25)], "Tmc string, STATION_ID string")
    writers.write_ids(found, str(tmp_path / "pure"))
    assert spark.read.text(str(tmp_path / "pure")).count() == 25
    lines = writers.joined_ids(found, "Tmc", ["Tmc", "STATION_ID"], 10).orderBy("line").collect()
    assert [len(r.ids.split(",")) for r in lines] == [10, 10, 5]
    assert {i for r in lines for i in r.ids.split(",")} == {f"t{i}" for i in range(25)}


def test_predictions_run_settings_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 2, "a", "b")], "VOL double, Predicted_VOL int, measurement_tstamp string, tmc_code string")
    writers.write_predictions(rows, str(tmp_path), "set")
    assert readers.predictions(spark, str(tmp_path / "set_predictions.parquet")).count() == 1
    writers.write_table(rows.drop("VOL"), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="VOL"):
        readers.predictions(spark, str(tmp_path / "bad"))
    writers.write_run(spark, {"features": ["a"], "model": object, "r2": 0.5}, str(tmp_path / "run"))
    run = json.loads(spark.read.text(str(tmp_path / "run")).first()[0])
    assert run["features"] == ["a"] and run["model"].startswith("<class") and run["r2"] == 0.5
    for epoch in (1, 2):
        writers.append_importance(spark.range(2).select(F.lit(epoch).alias("epoch"), "id"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    writers.write_report(spark.createDataFrame([("a", "1")], "Metric string, Value string"), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report.csv")).first().Metric == "a"


def test_model_list(spark, tmp_path):
    for name in ("a.model", "x/b.model", "c.other"):
        os.makedirs(tmp_path / name)
    assert [p.split("/")[-1] for p in writers.list_models(spark, str(tmp_path))] == ["a.model", "b.model"]


def test_station_of_file(spark):
    names = ["007_MA_2022.pkl", "007_NEW_YORK_2022.pkl", "007_MA_2022.csv", "x.pkl"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(readers.station_of_file(F.col("n")))
    assert [r[0] for r in df.collect()] == ["007", None, None, None]


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named
    assert stored(spark.range(3)).count() == 3
    assert spark.sparkContext.applicationId in scratch_path(spark, "x")


# ---- parts that are replaced --------------------------------------------------


def count_rows(spark, folder, name, rows, extra=""):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["STATION_ID,HOUR,VOL" + (",note" if extra else ""), *[",".join(map(str, r)) + extra for r in rows]]) + "\n")


def test_cached_scan_parses_only_what_changed(spark, tmp_path):
    folder, cache = tmp_path / "in", str(tmp_path / "cache")
    scan = lambda: sorted((r.STATION_ID, r.HOUR, r.VOL) for r in parts.cached_scan(spark, str(folder), cache).collect())
    changed = lambda: sorted(r.path.rpartition("/")[2] for r in parts.changed_files(spark, str(folder), cache).collect())
    count_rows(spark, folder, "a.csv", [("007", 1, 5.0)])
    count_rows(spark, folder, "x/b.csv", [("008", 2, 6.5), ("008", 2, 6.5)], ",n")
    count_rows(spark, folder, "none.csv", [])
    assert changed() == ["a.csv", "b.csv", "none.csv"]
    assert scan() == [("007", 1, 5.0), ("008", 2, 6.5), ("008", 2, 6.5)]
    assert changed() == [] and scan()[0] == ("007", 1, 5.0)
    before = {r.file_id: r.run for r in parts.parts(spark, cache).collect()}
    # a changed file is replaced, a new one added, a vanished one dropped
    count_rows(spark, folder, "a.csv", [("007", 1, 50.0), ("007", 3, 1.0)])
    count_rows(spark, folder, "c.csv", [("009", 4, 7.0)])
    (folder / "none.csv").unlink()
    assert changed() == ["a.csv", "c.csv"]
    assert scan() == [("007", 1, 50.0), ("007", 3, 1.0), ("008", 2, 6.5), ("008", 2, 6.5), ("009", 4, 7.0)]
    after = {r.file_id: r.run for r in parts.parts(spark, cache).collect()}
    assert len(set(before.items()) & set(after.items())) == 1
    (folder / "x/b.csv").unlink()
    assert [r[0] for r in scan()] == ["007", "007", "009"]
    # a bad value changes nothing
    count_rows(spark, folder, "bad.csv", [("010", "noon", 1.0)])
    with pytest.raises(Exception):
        parts.cached_scan(spark, str(folder), cache).collect()
    (folder / "bad.csv").unlink()
    assert changed() == [] and [r[0] for r in scan()] == ["007", "007", "009"]
    assert parts.drop_unused(spark, cache) >= 1 and [r[0] for r in scan()] == ["007", "007", "009"]


def test_a_rerun_replaces_only_its_stations(spark, tmp_path):
    folder = str(tmp_path / "d")
    parts.write_stations(located(spark), folder, "2022")
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "d").rglob("*.parquet") if "STATION_ID=010" in str(p)}
    one = located(spark).where("STATION_ID = '007'").limit(1).withColumn("new", F.lit(1))
    parts.write_stations(one, folder, "2022")
    back = readers.dataset_folder(spark, folder)
    assert sorted((r.STATION_ID, r.new) for r in back.collect()) == [("007", 1), ("010", None)]
    assert all((tmp_path / f).stat().st_mtime_ns == t for f, t in files.items()) and files
    parts.write_stations(located(spark), folder, "2023")
    assert sorted(r.STATION_ID for r in readers.dataset_folder(spark, folder).collect()) == ["007", "007", "007", "010", "010"]
    assert readers.stations_of_folders(spark, [folder]).count() == 2


def test_a_write_that_stops_is_not_seen(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "d")
    row = lambda v: spark.createDataFrame([(1, None, v), (2, "a/b=c", v)], "epoch int, name string, v int")
    parts.replace_parts(row(1), folder, ["epoch", "name"])
    with monkeypatch.context() as m:
        m.setattr(parts, "_put_in_force", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            parts.replace_parts(row(2), folder, ["epoch", "name"])
    read = lambda: sorted((r.epoch, r.name, r.v) for r in parts.read_parts(spark, folder, ["epoch", "name"]).collect())
    assert read() == [(1, None, 1), (2, "a/b=c", 1)]
    parts.replace_parts(row(3), folder, ["epoch", "name"])
    assert read() == [(1, None, 3), (2, "a/b=c", 3)]
    # a second writer that began before the first was done
    with monkeypatch.context() as m:
        names, first = parts._names, iter([parts._names(spark, folder)[:-1]])
        m.setattr(parts, "_names", lambda s, f: next(first, None) or names(s, f))
        with pytest.raises(parts.WriteConflict):
            parts.replace_parts(row(4), folder, ["epoch", "name"])
    assert read() == [(1, None, 3), (2, "a/b=c", 3)]
    assert parts.drop_unused(spark, folder) == 3 and read() == [(1, None, 3), (2, "a/b=c", 3)]


def test_importance_log_has_each_epoch_once(spark, tmp_path):
    log = str(tmp_path / "log")
    for epoch, value in ((1, 1.0), (2, 2.0), (2, 2.5), (3, 3.0)):
        parts.write_importance(spark.createDataFrame([(epoch, "a", value)], "epoch int, feature string, importance double"), log)
    assert sorted((r.epoch, r.importance) for r in parts.read_importance(spark, log).collect()) == [(1, 1.0), (2, 2.5), (3, 3.0)]


def test_many_stations_share_files(spark, tmp_path):
    folder, n = str(tmp_path / "d"), parts.FOLDERS + 1
    rows = spark.range(n).select(F.col("id").cast("string").alias("STATION_ID"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("S"), F.col("id") % 3)).alias("state"), F.lit(1).alias("VOL"))
    parts.write_stations(rows, folder, "2022")
    files = lambda: [p for p in (tmp_path / "d").glob("run=*/**/*.parquet")]
    assert len(files()) < 50
    # a later run with folders, with another column and without a text
    some = rows.where("VOL = 1 and cast(STATION_ID as int) < 4").withColumns({"VOL": F.lit(2), "new": F.lit("x")})
    parts.write_stations(some.union(spark.createDataFrame([("", "S1", 3, "y")], some.schema)), folder, "2022")
    assert len(files()) < 60
    back = readers.dataset_folder(spark, folder)
    assert back.columns == ["VOL", "new", "year", "STATION_ID", "state"]
    got = sorted((r.STATION_ID or "", r.state, r.VOL, r.new, r.year) for r in back.collect())
    state = lambda i: f"S{i % 3}" if i % 3 else None
    want = [(str(i), state(i), 2 if i < 4 else 1, "x" if i < 4 else None, "2022") for i in range(n)]
    assert got == sorted([*want, ("", "S1", 3, "y", "2022")])
    assert parts.drop_unused(spark, folder) == 0
    parts.write_stations(rows, folder, "2022")
    assert parts.drop_unused(spark, folder) == 1 and readers.dataset_folder(spark, folder).count() == n + 1
