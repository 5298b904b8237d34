"""Normalised forms of names, addresses and countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions import text as T
from rillwork.sources.schemas import require_columns

NAME_FORMS = ["norm", "compact", "alnum", "tokens", "sorted_tokens", "numeric_tokens"]
ADDRESS_FORMS = ["norm", "compact", "alnum", "tokens", "sorted_tokens", "alpha_tokens", "numeric_tokens", "house_number", "postal_tokens"]


def _forms(folded: Column, norm: Column, compact: Column) -> dict[str, Column]:
    return {
        "norm": norm,
        "compact": compact,
        "alnum": compact,
        "tokens": norm,
        "sorted_tokens": T.sorted_token_string(norm),
        "alpha_tokens": T.alpha_token_string(norm),
        "numeric_tokens": T.number_string(folded),
        "house_number": T.house_number(folded),
        "postal_tokens": T.postal_token_string(folded),
    }


def _with_forms(df: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    folded, norm, compact = (f"__{column}_{k}" for k in ("folded", "norm", "compact"))
    df = df.withColumn(folded, T.casefolded(F.col(column)))
    df = df.withColumns({norm: T.punctuation_free(F.col(folded)), compact: T.compact(F.col(folded))})
    forms = _forms(F.col(folded), F.col(norm), F.col(compact))
    return df.withColumns({f"{column}_{k}": forms[k] for k in wanted}).drop(folded, norm, compact)


def normalize_name(df: DataFrame) -> DataFrame:
    return _with_forms(df, "business_name", NAME_FORMS)


def normalize_address(df: DataFrame) -> DataFrame:
    return _with_forms(df, "business_address", ADDRESS_FORMS)


def normalize_country(df: DataFrame) -> DataFrame:
    """Single-spaced, nothing else."""
    return df.withColumn("country_norm", T.single_spaced(F.coalesce(F.col("country"), F.lit(""))))


def normalize_source(df: DataFrame) -> DataFrame:
    """The four source columns and 16 derived ones, none of which is ever null."""
    require_columns(df, "entity_id", "business_name", "business_address", "country")
    return normalize_country(normalize_address(normalize_name(df)))
