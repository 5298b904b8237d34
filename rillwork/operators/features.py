"""The 21 features of a candidate pair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions.text import token_overlap
from rillwork.operators.blocking import PAIR

#: Feature, and the normalised column whose equality it is.
EQUAL = {
    "name_exact": "business_name_norm",
    "name_compact_exact": "business_name_compact",
    "name_alnum_exact": "business_name_alnum",
    "name_sorted_exact": "business_name_sorted_tokens",
    "address_exact": "business_address_norm",
    "address_compact_exact": "business_address_compact",
    "address_alnum_exact": "business_address_alnum",
    "address_sorted_exact": "business_address_sorted_tokens",
    "country_exact": "country_norm",
    "house_number_exact": "business_address_house_number",
}
#: Feature, and the column whose distinct tokens both sides share.
OVERLAP = {
    "postal_overlap": "business_address_postal_tokens",
    "address_numeric_overlap": "business_address_numeric_tokens",
    "name_token_overlap": "business_name_tokens",
    "address_token_overlap": "business_address_tokens",
}
FEATURES = [
    *EQUAL,
    *OVERLAP,
    "block_support_count_feature",
    "s1_name_len",
    "s2_name_len",
    "s1_address_len",
    "s2_address_len",
    "name_length_diff",
    "address_length_diff",
]
_USED = sorted({*EQUAL.values(), *OVERLAP.values()})


def side(normalized: DataFrame, prefix: str, id_column: str) -> DataFrame:
    """A source's id and its feature columns, prefixed."""
    return normalized.select(F.col("entity_id").alias(id_column), *(F.col(c).alias(f"{prefix}_{c}") for c in _USED))


def feature_columns(null_as_empty: bool) -> list[Column]:
    """All features as integers, in order. A null never equals unless it counts as the empty string."""
    value = (lambda c: F.coalesce(F.col(c), F.lit(""))) if null_as_empty else F.col
    length = lambda c: F.coalesce(F.length(c), F.lit(0))
    n1, n2, a1, a2 = (length(f"{p}_business_{w}_norm") for w in ("name", "address") for p in ("s1", "s2"))
    found = {f: (value(f"s1_{c}") == value(f"s2_{c}")).cast("int") for f, c in EQUAL.items()}
    found |= {f: token_overlap(F.col(f"s1_{c}"), F.col(f"s2_{c}")) for f, c in OVERLAP.items()}
    found |= {"block_support_count_feature": F.col("block_support_count"), "s1_name_len": n1, "s2_name_len": n2, "s1_address_len": a1, "s2_address_len": a2}
    found |= {"name_length_diff": F.abs(n1 - n2), "address_length_diff": F.abs(a1 - a2)}
    return [F.coalesce(found[f], F.lit(0)).cast("int").alias(f) for f in FEATURES]


def pair_features(pairs: DataFrame, s1: DataFrame, target: DataFrame, how: str = "inner") -> DataFrame:
    """``pairs`` with the 21 features.

    how ``left`` keeps pairs whose entities are unknown, whose features are 0
    where a null decides (training); ``inner`` drops them and takes nulls for empty strings (scoring).
    """
    joined = pairs.join(side(s1, "s1", PAIR[0]), PAIR[0], how).join(side(target, "s2", PAIR[1]), PAIR[1], how)
    kept = [c for c in pairs.columns if c != "block_support_count"]
    return joined.select(*kept, *feature_columns(null_as_empty=how == "inner"))


_LENGTH = {"name_len": "business_name_norm", "address_len": "business_address_norm"}


def facts(wanted: list[str]) -> list[Column]:
    """What of a normalised row the ``wanted`` features need: 64 bits of hash for a text, for each token of a set, and lengths. Nulls count as empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    hashed = [F.xxhash64(text(c)).alias(f) for f, c in EQUAL.items() if f in wanted]
    sets = [F.array_distinct(F.transform(F.split(F.trim(text(c)), " "), lambda t: F.xxhash64(t))).alias(f) for f, c in OVERLAP.items() if f in wanted]
    lengths = [F.length(text(c)).alias(f) for f, c in _LENGTH.items() if any(f[:-4] in w and "len" in w for w in wanted)]
    return [*hashed, *sets, *lengths]


def of_facts(wanted: list[str]) -> list[Column]:
    """The ``wanted`` features, in order, from the facts of both sides (``s1_``, ``s2_``) and ``block_support_count``."""
    return [c.alias(f) for f, c in by_name(wanted, *(lambda f, p=p: F.col(f"{p}_{f}") for p in ("s1", "s2"))).items()]


def by_name(wanted: list[str], s1: Callable[[str], Column], s2: Callable[[str], Column]) -> dict[str, Column]:
    """The ``wanted`` features, in order, from what gives a side's fact by its name, and ``block_support_count``."""
    sides = {"s1": s1, "s2": s2}
    found = {f: lambda f=f: s1(f) == s2(f) for f in EQUAL} | {f: lambda f=f: F.size(F.array_intersect(s1(f), s2(f))) for f in OVERLAP}
    found |= {"block_support_count_feature": lambda: F.col("block_support_count")} | {f"{p}_{f}": lambda p=p, f=f: sides[p](f) for p in sides for f in _LENGTH}
    found |= {f"{f[:-4]}_length_diff": lambda f=f: F.abs(s1(f) - s2(f)) for f in _LENGTH}
    return {f: found[f]().cast("int") for f in FEATURES if f in wanted}
