"""Written intermediate tables: lineage ends in a folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's spark.checkpoint.dir, or a temporary one where that is unset and all tasks run in this process.

    RuntimeError if it is unset on a cluster, as its machines share no folder of this one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="harvestry-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def _app_dir(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/harvestry/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete the tables that this application has written; for when no result that is yet to be computed needs them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_app_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete a table that `written` gave; for when no result that is yet to be computed needs it."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0])).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, sparse: bool = False) -> DataFrame:
    """Write df as Parquet to the working folder and read it back: lineage ends here, and a lost executor costs nothing done before.

    Sizes of what was written are known to the planner, so a later join broadcasts it only if it is under spark.sql.autoBroadcastJoinThreshold.
    sparse: df keeps few rows of what it read, so it is rebalanced first, which saves a tiny file for each task of a large scan.
    """
    spark = df.sparkSession
    path = f"{_app_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if sparse else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
