"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings. Spark broadcasts a side only when its (estimated, then measured)
#: size is under these thresholds and falls back to a shuffled join with skew splitting
#: beyond them. Outside the optional part the library hints a broadcast in one place,
#: behind a count (spatial join).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # columnar files grow in memory; keep plan-time size estimates on the high side
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME` to a live session. Timestamps need the UTC zone:
    a zone with daylight saving would skip or repeat an hour of counts."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of a batch of rows that is sent to Python at a time.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most :data:`BATCH_BYTES`, unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


#: Shuffled bytes a task should get; adaptive execution merges smaller ones.
TASK_BYTES = 128 * 1024 * 1024


def size_shuffle(spark: SparkSession, paths: list[str]) -> int:
    """Raise the number of shuffle partitions to fit the input files. Adaptive
    execution can merge partitions but makes no more than it is told to."""
    sc = spark.sparkContext
    total = 0
    for path in paths:
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(sc._jsc.hadoopConfiguration())
        total += fs.getContentSummary(place).getLength()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


def local_session(cores: int = 8, app: str = "segflow", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so that
    functions of it run there even where it is not installed."""
    sc = spark.sparkContext
    if getattr(sc, "_segflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="segflow-ship-"), "segflow.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                packed.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._segflow_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; set here only when the
    session names none and everything runs on one machine."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="segflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/segflow-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder of this application, which lies in
    :func:`shared_folder`."""
    return f"{_scratch_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, once no result that was
    read from them is needed any more."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """The table written to the shared folder and read back. Use it for a small
    table that several branches of a plan need, or to cut a long lineage: later
    jobs and lost executors start from the files, not from the sources."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
