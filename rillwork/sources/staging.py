"""Intermediate tables in a folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where that is unset on a single machine (tests) a temporary folder is made once, used for the session and
    removed at its end; on a cluster that would be lost data, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="rillwork-"))
        atexit.register(shutil.rmtree, _LOCAL_ROOT[0], ignore_errors=True)
    return _LOCAL_ROOT[0]


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: what uses it twice computes it once, and a lost executor costs only a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rillwork/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
