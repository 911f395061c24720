"""Spark session defaults and the shared checkpoint folder.

The library never sets cluster-wide knobs behind the user's back: ``get_session``
only fills in settings that are unset, so a cluster's ``spark-defaults.conf``
(shuffle partitions, checkpoint dir, AQE thresholds) always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on. AQE re-plans joins from runtime
# sizes (broadcast only when the shuffle stats prove a side small), coalesces
# tiny partitions and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of collected DataFrames are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "mercato",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform (a shared, fault-tolerant path);
    it is read from the session and used as is. Only when it is unset -- local
    runs and tests -- a private scratch folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() or None
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; set it to a shared folder on the cluster")
        current = tempfile.mkdtemp(prefix="mercato-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable checkpoint).

    Used where a long plan feeds several later stages: the written copy
    survives executor loss, unlike a cache or a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` plus the row count, observed during the same job."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation()
    written = cut_lineage(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return written, int(obs.get["rows"])


_open: list[list[str]] = []  # folders written inside the open written_tables() blocks


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, under ``{spark.checkpoint.dir}/tables/``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    for block in _open:
        block.append(path)
    return path


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet under ``{spark.checkpoint.dir}/tables/`` and read it back.

    For a wide intermediate that several later jobs read: columnar and
    compressed, so each reader scans only its columns (with filter pushdown),
    and the copy survives executor loss. Returns (table, path).
    """
    path = table_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path), path


@contextmanager
def written_tables(spark: SparkSession):
    """Remove the intermediate tables written inside the block when it ends; results must be out by then."""
    _open.append(block := [])
    try:
        yield block
    finally:
        _open.remove(block)
        for path in block:
            drop_table_files(spark, path)


def drop_table_files(spark: SparkSession, path: str) -> None:
    """Remove a folder written by ``write_table`` (through the Hadoop file system of the path)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def publish(spark: SparkSession, staged: dict[str, str]) -> None:
    """Move each written folder ``staged[final]`` to its ``final`` path, replacing what is there.

    Called when everything is written: a job that stops before leaves the old outputs as they were. The
    old folder is set aside first and deleted only when the new one is in place.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for final, path in staged.items():
        new, target, aside = hadoop(path), hadoop(final), hadoop(f"{path}-replaced")
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        had = fs.exists(target)
        if had and not fs.rename(target, aside):
            raise OSError(f"cannot replace {final}")
        try:
            if not fs.rename(new, target):
                raise OSError(f"cannot move {path} to {final}")
        except Exception:
            if had:
                fs.rename(aside, target)
            raise
        if had:
            fs.delete(aside, True)
