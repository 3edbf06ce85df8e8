"""Session helpers: a tuned local session, the shared folder, and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tallyspan") -> SparkSession:
    """A session for tests and the bench. On a cluster, pass the cluster's own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TALLYSPAN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is absent and the master is local is a temporary
    folder made; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tallyspan-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    sc.setCheckpointDir(f"file://{made}")
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as parquet into the shared folder and read it back.

    The written table is replicated storage, so a lost executor costs no
    recomputation, and later readers prune its columns. It is deleted when the
    driver ends, or by drop_written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_drop_at_exit)
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[tuple[SparkSession, str]] = []


def drop_written() -> None:
    """Delete the tables that lineage cuts have left in the shared folder. Frames that read them can't be used any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _drop_at_exit() -> None:
    try:
        drop_written()
    except Exception:  # noqa: BLE001 - the session may have ended; a cluster's own cleaner takes the folder then
        _WRITTEN.clear()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers: a zip of its sources is added once per session."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyspan_shipped", False):
        return
    import zipfile

    folder = tempfile.mkdtemp(prefix="tallyspan-zip-")  # the driver serves the file from here while it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    at = os.path.join(folder, "tallyspan.zip")
    package = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for inside, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(inside, f)
                    z.write(full, os.path.relpath(full, _PACKAGE_ROOT))
    sc.addPyFile(at)
    sc._tallyspan_shipped = True
