"""Evaluation of matches by entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.metrics import count_scores, f_beta, ratio
from rillwork.operators.blocking import PAIR


def _sets(pairs: DataFrame, name: str) -> DataFrame:
    return pairs.groupBy(PAIR[0]).agg(F.array_sort(F.collect_set(PAIR[1])).alias(name))


def entity_f05(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """``(source1_entity_id, tp, fp, fn, precision, recall, f05)`` of each entity; sets that are missing are empty."""
    ids = entities.select(PAIR[0]).distinct()
    empty = F.array().cast("array<string>")
    rows = ids.join(_sets(predicted, "predicted"), PAIR[0], "left").join(_sets(truth, "actual"), PAIR[0], "left")
    rows = rows.select(PAIR[0], F.coalesce("predicted", empty).alias("predicted"), F.coalesce("actual", empty).alias("actual"))
    tp = F.size(F.array_intersect("predicted", "actual"))
    return entity_f05_of_counts(rows.select(PAIR[0], tp.alias("tp"), F.size("predicted").alias("n_predicted"), F.size("actual").alias("n_actual")))


def entity_f05_of_counts(counts: DataFrame) -> DataFrame:
    """``entity_f05`` from a row per entity with ``tp``, ``n_predicted`` and ``n_actual``; nulls count as 0. No pair has to travel for them."""
    n = {c: F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("tp", "n_predicted", "n_actual")}
    s = count_scores(*n.values())
    return counts.select(
        PAIR[0],
        *(s[c].alias(c) for c in ("tp", "fp", "fn")),
        *(F.round(s[c], 6).alias(c) for c in ("precision", "recall", "f05")),
        *(n[c].alias(c) for c in ("n_predicted", "n_actual")),
    )


def entity_metrics(by_entity: DataFrame) -> DataFrame:
    """One row: macro F0.5, micro precision, recall and F0.5, totals, and entities with and without matches."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    one = by_entity.agg(
        F.count(F.lit(1)).alias("entities"),
        F.round(F.avg("f05"), 6).alias("macro_f05"),
        total("tp").alias("tp"),
        total("fp").alias("fp"),
        total("fn").alias("fn"),
        count(F.col("n_actual") > 0).alias("actual_nonzero"),
        count(F.col("n_predicted") > 0).alias("predicted_nonzero"),
        count((F.col("n_actual") == 0) & (F.col("n_predicted") == 0)).alias("correct_zero_match"),
    )
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "fn")}
    precision, recall = ratio(d["tp"], d["tp"] + d["fp"]), ratio(d["tp"], d["tp"] + d["fn"])
    return one.select("*", F.round(precision, 6).alias("micro_precision"), F.round(recall, 6).alias("micro_recall"), F.round(f_beta(precision, recall), 6).alias("micro_f05"))
