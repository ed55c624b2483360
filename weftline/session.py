"""Session helpers: the shared folder for cut lineage, table loading, partition sizing."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "weftline", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Where a session on one machine has no such setting (tests) a temporary folder is made once and set; on a cluster a
    missing setting raises, since a folder of one machine would be lost with it.
    """
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        set_to = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is already gone; the folder's owner cleans up
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/weftline/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of a ``materialize`` that nothing will read again; other frames are left alone."""
    path = getattr(df, "_scratch", None)
    if path:
        _delete(df.sparkSession, path)


#: Tables with texts, whose rows cost far more to work on than to move.
TEXTS = {"raw_telegram_posts", "candidates", "documents"}


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its files make fewer partitions than there are cores; else as it is.

    Parquet is split at row groups only, so a small table in one row group would be worked on by one task whatever the
    size of a split. A table that has row groups for every core, as any large one, is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Partition count that keeps partitions at a given number of rows, never below the session's parallelism."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition))


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per context (a zip of a few hundred KB)."""
    sc = spark.sparkContext
    if getattr(sc, "_weftline_shipped", False):
        return
    import os
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="weftline-"), "weftline.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._weftline_shipped = True
