"""Integrity rules over the final tables: a row per rule with its violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.text import is_blank
from rillwork.operators.blocking import PAIR

ALLOWED_SOURCES = ("s2", "s3")


class ValidationError(ValueError):
    """Final tables break a rule."""


def validation_rules(pairs: DataFrame, results: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """``(rule, violations)``. pairs and results as written; s1, s2, s3 have entity_id."""
    one, other = PAIR
    ids = {n: d.select(F.col("entity_id").alias("id")) for n, d in (("s1", s1), ("s2", s2), ("s3", s3))}
    count = F.count(F.lit(1))
    extra = lambda df, *cols: df.groupBy(*cols).agg(count.alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    rows = lambda df: df.agg(count.alias("violations"))
    matched = results.where(~is_blank(F.col("matched_entity_ids"))).select(one, F.explode(F.split("matched_entity_ids", ",")).alias(other))
    unknown = lambda df, key, known: rows(df.select(F.col(key).alias("id")).distinct().join(known, "id", "left_anti"))
    rules = {
        "s1_null_ids": rows(s1.where("entity_id is null")),
        "s1_duplicate_ids": extra(s1, "entity_id"),
        "s2_duplicate_ids": extra(s2, "entity_id"),
        "s3_duplicate_ids": extra(s3, "entity_id"),
        "s2_s3_shared_ids": rows(ids["s2"].intersect(ids["s3"])),
        "pair_null_values": rows(pairs.where(" or ".join(f"{c} is null" for c in (*PAIR, "candidate_source")))),
        "pair_unknown_source": rows(pairs.where(~F.col("candidate_source").isin(*ALLOWED_SOURCES))),
        "pair_unknown_s1": unknown(pairs, one, ids["s1"]),
        "pair_unknown_s2": unknown(pairs.where("candidate_source = 's2'"), other, ids["s2"]),
        "pair_unknown_s3": unknown(pairs.where("candidate_source = 's3'"), other, ids["s3"]),
        "pair_duplicates": extra(pairs, *PAIR),
        "result_missing_s1": rows(ids["s1"].distinct().join(results.select(F.col(one).alias("id")), "id", "left_anti")),
        "result_extra_s1": unknown(results, one, ids["s1"]),
        "result_duplicate_s1": extra(results, one),
        "matched_unknown_ids": unknown(matched, other, ids["s2"].unionByName(ids["s3"]).distinct()),
        "matched_duplicate_ids": extra(matched, *PAIR),
        "matched_not_in_pairs": rows(matched.distinct().join(pairs.select(*PAIR), PAIR, "left_anti")),
        "zero_match_mismatch": rows(results.where(is_blank(F.col("matched_entity_ids"))).join(pairs.select(one), one, "left_semi")),
    }
    return reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("rule"), F.col("violations").cast("long").alias("violations")) for name, df in rules.items()))


def require_valid(rules: DataFrame) -> DataFrame:
    """``rules``, if nothing is violated."""
    broken = {r["rule"]: r["violations"] for r in rules.where("violations > 0").collect()}
    if broken:
        raise ValidationError(str(broken))
    return rules
