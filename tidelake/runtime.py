"""Session-level helpers: the shared folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidelake", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings that every operator here assumes (UTC, AQE, Arrow)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or what was set as the checkpoint folder. Only a
    session of one machine may do without: it gets a folder of this machine, removed at the end. A cluster without
    one is an error, as every executor would write to a disk of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="tidelake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        at = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_SCRATCH: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses. What is left there is removed when this process ends."""
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clean, spark)
    _SCRATCH.add(at)
    return at


def _clean(spark: SparkSession) -> None:
    for at in list(_SCRATCH):
        try:
            remove_path(spark, at)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is the cluster's then
            return


def write_cut(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """df as a written table in the shared folder: cuts the lineage and survives the loss of executors."""
    spark = spark or df.sparkSession
    at = scratch(spark, name)
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._tidelake_path = at  # lets drop_cut remove it
    return out


def drop_cut(df: DataFrame) -> None:
    """Removes what write_cut wrote; df can't be read any more."""
    at = getattr(df, "_tidelake_path", None)
    if at:
        remove_path(df.sparkSession, at)


def _hadoop(spark: SparkSession, at: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, at: str) -> None:
    path, fs = _hadoop(spark, at)
    fs.delete(path, True)
    _SCRATCH.discard(at)


def path_exists(spark: SparkSession, at: str) -> bool:
    path, fs = _hadoop(spark, at)
    return fs.exists(path)


def list_dirs(spark: SparkSession, at: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    path, fs = _hadoop(spark, at)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def make_dir(spark: SparkSession, at: str) -> None:
    path, fs = _hadoop(spark, at)
    fs.mkdirs(path)


def spread(df: DataFrame, by: str) -> DataFrame:
    """df over many tasks, for small rows that each stand for much work (paths, hours to fetch). A fixed number of
    partitions, as adaptive execution would join such rows into one task by their size."""
    sc = df.sparkSession.sparkContext
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * sc.defaultParallelism)
    return df.repartition(n, by)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
