"""Table schemas, and checks of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

#: What the tab-separated sources call a missing value, quoted or not.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


SOURCE = _strings("entity_id", "business_name", "business_address", "country")
GROUND_TRUTH = _strings("source1_entity_id", "matched_entity_ids")
CANDIDATE_PAIRS = _strings("source1_entity_id", "candidate_entity_id", "candidate_source")
MATCHING_RESULTS = _strings("source1_entity_id", "matched_entity_ids")


class SchemaMismatch(ValueError):
    """A table lacks columns that an operator needs, or has them in another order."""


def require_exact(df: DataFrame, schema: StructType) -> DataFrame:
    """``df``, if its column names and their order are those of ``schema``."""
    if df.columns != schema.fieldNames():
        raise SchemaMismatch(f"expected columns {schema.fieldNames()}, found {df.columns}")
    return df


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df``, if it has the columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns {missing} among {df.columns}")
    return df
