"""Session settings and the shared folder for tables that outlive one job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Where a cluster's shuffles start; AQE merges small partitions, it splits none but
# skewed joins, so the start has to be high.
CLUSTER_PARTITIONS = 20_000


def build_session(app: str = "studytrail", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``a__b`` in a name stands for ``a.b``.

    On a cluster ``master`` stays None (spark-submit sets it) and shuffles start with
    ``CLUSTER_PARTITIONS``, which AQE coalesces to partitions of the advisory size.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Call sites of every column cost more than planning does on small inputs.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    else:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(CLUSTER_PARTITIONS)
        ).config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the place every executor sees.

    Only a local session may go without that setting; it then gets a temporary
    folder. On a cluster a missing setting is an error, not a silent local path.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "studytrail")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``shared_folder``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_temporary: list[tuple[SparkSession, str]] = []


def temporary_folder(spark: SparkSession, name: str) -> str:
    """As ``shared_folder``, removed when the driver ends."""
    path = shared_folder(spark, name)
    _temporary.append((spark, path))
    return path


@atexit.register
def _drop_temporary() -> None:
    for spark, path in _temporary:
        try:
            drop_folder(spark, path)
        except Exception:  # the session has ended before
            if "://" not in path:
                shutil.rmtree(path, ignore_errors=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, for as long as the driver runs. Operators that
    look at their input more than once (ranks, row filters) should get a table, not a long
    derivation."""
    spark = df.sparkSession
    path = temporary_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
