"""Audit and profile of source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.text import is_blank, stripped


def column_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, rows, nulls, blanks, distinct_values, max_length)`` of each column, all in one pass but the distinct values.

    blanks: null, empty or white space.
    """
    columns = columns or df.columns
    flag = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    parts = []
    for c in columns:
        # Counting a column's values once each keeps distinct counts off one wide Expand.
        values = df.groupBy(F.col(c).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n")
        parts.append(
            values.agg(
                F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), n)), F.lit(0)).alias("nulls"),
                F.coalesce(F.sum(F.when(is_blank(F.col("v")), n)), F.lit(0)).alias("blanks"),
                F.count("v").alias("distinct_values"),
                F.max(F.length("v")).cast("long").alias("max_length"),
            ).select(F.lit(c).alias("column_name"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def id_profile(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """One row: rows, distinct ids, extra copies of ids, rows whose id is shared, null ids."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(
        total("n").alias("rows"),
        F.count(key).alias("distinct_ids"),
        total(F.col("n") - 1).alias("extra_copies"),
        total(F.when(F.col("n") > 1, F.col("n"))).alias("rows_with_shared_id"),
        total(F.when(F.col(key).isNull(), F.col("n"))).alias("null_ids"),
    )


def length_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: least, greatest, mean, median and quartiles of the lengths; null has length 0."""
    n = F.length(F.coalesce(F.col(column), F.lit("")))
    # Exact percentiles from counts of lengths: the aggregate holds a length once, not a row.
    sizes = df.groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("times"))
    at = lambda p: F.round(F.expr(f"percentile(n, {p}, times)"), 6)
    return sizes.agg(
        F.min("n").cast("long").alias("min_length"),
        F.max("n").cast("long").alias("max_length"),
        F.round(F.sum(F.col("n") * F.col("times")) / F.sum("times"), 6).alias("mean_length"),
        at(0.5).alias("median_length"),
        at(0.25).alias("p25_length"),
        at(0.75).alias("p75_length"),
    ).select(F.lit(column).alias("column_name"), "*")


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """``(value, rows)``, most frequent first, ties by value; null as ``<NULL>``. ``limit``: a top-k report."""
    value = F.coalesce(stripped(F.col(column)), F.lit("<NULL>"))
    out = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return out.orderBy(F.desc("rows"), "value").limit(limit) if limit else out


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows, and rows beyond the first of their kind."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(total.alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), (total - F.count(F.lit(1))).alias("duplicate_rows"))


def sample_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The first n distinct values in order: a top-k report."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)
