"""Shared scratch folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_RUN = f"greenlake-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where that setting is unset, a folder of this machine serves a local master, and others are an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "root" not in _LOCAL:
            _LOCAL["root"] = tempfile.mkdtemp(prefix="spark-greenlake-")
            atexit.register(shutil.rmtree, _LOCAL["root"], ignore_errors=True)
        root = _LOCAL["root"]
    return f"{root.rstrip('/')}/{_RUN}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that this session has written, once their results have been stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x").rpartition("/")[0])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
