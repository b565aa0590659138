"""Spark session helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_ROOTS: set[str] = set()   # scratch folders of this driver's sessions
_TABLES: list[str] = []    # scratch tables in them

# Settings a cluster job wants regardless of size: adaptive execution re-plans
# joins and partition counts from runtime statistics, splits skewed join
# partitions, and UTC keeps date arithmetic identical to the SQL oracle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "dealcast") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server port)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in CLUSTER_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a folder that all executors
    share and is used as is. Without it, a local session (tests) gets a fresh
    local folder; any other master is an error, since executors would write to
    disks that nobody else reads.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="dealcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for this session's
    intermediate tables. The session's folder goes when the driver ends."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"dealcast-{spark.sparkContext.applicationId}")
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_drop_at_exit, spark, root)
    return os.path.join(root, name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _drop_at_exit(spark: SparkSession, root: str) -> None:
    try:
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            delete_path(spark, root)
    except Exception:  # noqa: BLE001 - the JVM may be gone; nothing is left to do
        pass


def stop(spark: SparkSession) -> None:
    """Delete the session's scratch tables and stop it."""
    for root in list(_ROOTS):
        _drop_at_exit(spark, root)
        _ROOTS.discard(root)
    spark.stop()


def scratch_tables() -> list[str]:
    """Paths of the tables that ``materialize`` has written and nobody released."""
    return list(_TABLES)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables whose readers are done."""
    for path in paths:
        if path in _TABLES:
            _TABLES.remove(path)
            delete_path(spark, path)


def materialize(df):
    """Cut the lineage of a DataFrame that several later branches read.

    The rows are written once as a Parquet table under the shared
    ``spark.checkpoint.dir`` and read back: later branches (and a retried task
    after a lost executor) read the files instead of replaying the upstream
    plan, the columnar re-read prunes columns and pushes filters, and AQE sees
    the table's real size. (``DataFrame.checkpoint(eager=True)`` would run the
    upstream twice: once to count and once to write.) The table is written with
    the session's output committer, so a retried or repeated task adds nothing
    twice. The schema is known, so the read-back infers nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    _TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)
