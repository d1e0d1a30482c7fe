"""Session settings, and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on: one time zone, and adaptive plans that split skewed
# join partitions even where that costs an extra exchange.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Tasks of a bounded size, for the logs of narrow rows: larger input gives more of them, not larger
# ones, and what a task sorts or hashes stays within its memory.
SMALL_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
}


# where the tables that `cut` wrote lie, for as long as their DataFrames are in use
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def tune_for_logs(spark: SparkSession) -> SparkSession:
    for key, value in SMALL_TASKS.items():
        spark.conf.set(key, value)
    return tune(spark)


def build_session(master: str = "local[*]", app: str = "adoptrend", **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **RUNTIME,
        **conf,
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local master, where driver and executors are one process, gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="adoptrend-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/adoptrend/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name for an intermediate table of this application."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results read lazily from them are gone too."""
    _delete(spark, _scratch(spark))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and read it back.

    Survives the loss of any executor, ends the lineage, and gives the next plan true sizes, so
    the optimizer broadcasts a small result and sorts a large one by itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def held(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` as a table of ``cut``, and whether it had to be written for that."""
    return (df, False) if df in _written else (cut(df), True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that nothing will read again, such as those of the round before."""
    for table in tables:
        if path := _written.pop(table, None):
            _delete(table.sparkSession, path)
