"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: list[str] = []
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    It is what ``spark.checkpoint.dir`` names. Where that is unset on a single machine (tests) a
    temporary folder is made once, used for the session and removed at its end; on a cluster
    that would be lost data, so it is an error.
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


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    This cuts lineage: a lost executor costs only a reread, and what is read
    later does not depend on recomputing nondeterministic partitions.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rillwork/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Delete what ``materialize`` has written since ``mark``, but for the files that ``keep`` reads."""
    read = keep.inputFiles()
    for path in _WRITTEN[since:]:
        if not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
            _WRITTEN.remove(path)


def mark() -> int:
    return len(_WRITTEN)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores at its end as no column of ``df`` has its name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def rows_of(docs: DataFrame, chosen: DataFrame, how: str, once: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, whose id and text hash are (``left_semi``) or are not (``left_anti``) in ``chosen(doc_id, __th)``.

    once: of rows that repeat an id and its text one stays; rows without an id all stay.
    """
    own, th, row = unused(docs, "__own", "__th", "__row")
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keys = chosen.select(named.alias(own), F.col("__th").alias(th)).distinct()
    keyed = docs.withColumns({own: named, th: F.xxhash64("text")})
    if not once:
        return keyed.join(keys, [own, th], how).drop(own, th)
    keyed = keyed.withColumn(row, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return keyed.join(keys, [own, th], how).dropDuplicates([own, th, row]).drop(own, th, row)


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions that the session deals a shuffle out to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_key(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, text, __th)``: with the hash of its text, a row's id names
    it even where ids repeat; rows that agree in both have equal results."""
    return docs.select("doc_id", F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("__th"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
