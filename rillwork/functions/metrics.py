"""Precision, recall and F-measures as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    """0 where both are 0."""
    square = beta * beta
    return ratio((1 + square) * precision * recall, square * precision + recall)


def count_scores(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    """tp, fp, fn and precision, recall, f05 of two sets of ids, from their sizes and that of what they share, ``tp``.

    Both empty: all 1. Nothing predicted where something is true: all 0.
    Something predicted where nothing is true: recall 1, precision and f05 0.
    """
    none = (predicted == 0) & (actual == 0)
    precision = F.when(none, 1.0).otherwise(ratio(tp.cast("double"), predicted.cast("double")))
    recall = F.when(actual == 0, 1.0).otherwise(ratio(tp.cast("double"), actual.cast("double")))
    f05 = F.when(none, 1.0).otherwise(f_beta(precision, recall))
    return {"tp": tp, "fp": predicted - tp, "fn": actual - tp, "precision": precision, "recall": recall, "f05": f05}
