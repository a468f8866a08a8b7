"""Session construction and shared-storage helpers.

Cluster jobs read their settings from the session they are given; the
builder below is only for tests, benches and local runs.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every wingspan job relies on.  AQE re-plans joins and coalesces
# shuffle partitions from runtime statistics; the broadcast threshold is the
# size check Spark applies before it broadcasts a join side (kept at the
# 10 MB default: file-size estimates of compressed parquet understate the
# in-memory size of a table several times).  Shuffled rows of a join or an
# aggregate take some 20 times their compressed size in a task's memory, so a
# task after a shuffle reads 16 MB of them (Spark's default is 64 MB).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "wingspan") -> SparkSession:
    """Local session for tests and benches (UI off, UTC, AQE on)."""
    master = master or os.environ.get("WINGSPAN_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("WINGSPAN_DRIVER_MEM", "8g")))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the SQL settings wingspan needs; a value the caller has set stays."""
    explicit = spark.conf.getAll
    for k, v in JOB_CONF.items():
        if k not in explicit:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` of the session names it on a cluster and is
    always respected.  Where it is unset a folder in the session's
    warehouse is taken (also storage that all executors see); nothing is
    ever put in a machine-local temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = f"{warehouse.rstrip('/')}/_wingspan_scratch"
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, removed when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)
    fs.deleteOnExit(hpath)
    return path


def file_listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file under ``path``; empty if there is none."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def remove_folder(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint dir and read it back.

    Used for intermediate tables read several times (a search index, a
    feature table): later jobs and retried tasks read the files instead of
    recomputing the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
