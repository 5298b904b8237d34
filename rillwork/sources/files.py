"""Tab-separated, Parquet and JSON files, in any store that Spark reaches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillwork.sources.schemas import GROUND_TRUTH, MISSING, SOURCE, SchemaMismatch

SPLIT_BYTES = 128 << 20


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def file_sizes(spark: SparkSession, *paths: str) -> dict[str, int]:
    """Bytes of each file or folder; a missing one is an error, and so is one without any bytes."""
    sizes = {}
    for path in paths:
        if not path_exists(spark, path):
            raise FileNotFoundError(path)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        sizes[path] = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
        if not sizes[path]:
            raise ValueError(f"{path} is empty")
    return sizes


def spread(df: DataFrame) -> DataFrame:
    """``df``, a table read from files, dealt out over all cores where its files are fewer and too small to be split over them.

    Large tables come as they are; what is shuffled here is under ``SPLIT_BYTES`` a core.
    """
    spark = df.sparkSession
    files, cores = df.inputFiles(), spark.sparkContext.defaultParallelism
    if not 0 < len(files) < cores or sum(file_sizes(spark, *files).values()) >= cores * SPLIT_BYTES:
        return df
    return df.repartition(4 * cores)


def read_tsv(spark: SparkSession, path: str, schema: StructType, columns: list[str] | None = None, keep_missing: bool = False, multi_line: bool = False) -> DataFrame:
    """A tab-separated file with a header of exactly the schema's names in order.

    Strings that stand for a missing value become null unless ``keep_missing``;
    with ``columns`` only those are parsed. With ``multi_line`` quoted fields may hold line ends, but
    then a file can't be split and is read by one task.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    header = spark.read.option("sep", "\t").option("escape", '"').option("header", True).csv(path).columns
    if header != schema.fieldNames():
        raise SchemaMismatch(f"expected columns {schema.fieldNames()}, found {header} in {path}")
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').option("encoding", "UTF-8").option("multiLine", multi_line).csv(path)
    df = df.select(*(columns or df.columns))
    if keep_missing:
        return df
    return df.select(*(F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in df.columns))


def read_source(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_tsv(spark, path, SOURCE, columns)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, GROUND_TRUTH)


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """One or several Parquet datasets as one table."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", level: int | None = None) -> None:
    """Replaces what is there; an empty table still gives a dataset with its schema."""
    writer = df.write.mode("overwrite").option("compression", compression)
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.parquet(path)


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """With a header; null is written as nothing and the empty string as ``""``."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("sep", "\t").option("header", True).option("escape", '"').csv(path)


def write_json(spark: SparkSession, report: dict, path: str) -> None:
    """A small report as one indented JSON file, written through Hadoop's file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    try:
        stream.write(bytearray(json.dumps(report, indent=2, ensure_ascii=False, default=str).encode()))
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))
