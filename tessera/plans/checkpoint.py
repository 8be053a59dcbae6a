"""Lineage cuts that survive executor loss.

Both cuts write to the shared folder named by the cluster in
``spark.checkpoint.dir``.  The setting is read from the session; only when it
is unset *and* the master is local (tests, laptops) do we pick a folder of our
own.  On a cluster without the setting we refuse rather than write to a
machine-local folder that other executors cannot read.

``write_through`` is the usual cut: the rows are computed once, written as
Parquet and read back, so a later stage re-reads files instead of re-running
their lineage.  ``release`` deletes such a table when its reader is done with
it; what is left is deleted when the driver process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_A_FILE = 100_000
_written: dict[str, SparkSession] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(HDFS/S3/ABFS) before running jobs that cut lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, deleted when the driver ends."""
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_release_all)
    _written[path] = spark
    return path


def write_through(df: DataFrame, label: str = "cut", rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it as read back.

    ``rows``: about how many it has, if that is known.  A table that is small for the number of shuffle partitions
    is written by fewer tasks, as many as run at once at least: a task and its file cost more than its few rows."""
    spark = df.sparkSession
    if rows is not None:
        tasks = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE))
        if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.coalesce(tasks)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a ``write_through`` result that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        for path in [p for p in _written if p.rpartition("/")[2] in file]:
            _delete(path)


def _delete(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _release_all() -> None:
    for path in list(_written):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001 - the JVM may have gone before us
            return


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` and return the DataFrame that reads the result."""
    return write_through(df)
