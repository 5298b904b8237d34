"""Scores of pairs, thresholds, and the boosted-tree classifier."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillwork.functions.metrics import f_beta, ratio
from rillwork.operators.features import FEATURES
from rillwork.sources.schemas import require_columns

#: Weights, in hundredths, of the deterministic linear score.
LINEAR = {
    "name_exact": 20, "name_compact_exact": 10, "name_sorted_exact": 10, "address_exact": 25, "address_compact_exact": 10, "address_sorted_exact": 5,
    "country_exact": 5, "house_number_exact": 5, "postal_overlap": 3, "address_numeric_overlap": 2, "name_token_overlap": 2, "block_support_count_feature": 3,
}
THRESHOLD = 0.80
FIRST_PERCENT, LAST_PERCENT = 5, 95


def linear_score(features: DataFrame, weights: dict[str, int] = LINEAR) -> DataFrame:
    """``features`` with ``match_probability``, the weighted sum in hundredths, held between 0 and 1."""
    return features.withColumn("match_probability", linear({f: F.col(f) for f in weights}, weights))


def linear(feature: dict[str, Column], weights: dict[str, int] = LINEAR) -> Column:
    total = sum((feature[f] * w for f, w in weights.items()), F.lit(0))
    return F.least(F.lit(100), F.greatest(F.lit(0), total)) / 100.0


def accepted(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return scored.where(F.col("match_probability") >= threshold)


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """``(threshold, tp, fp, fn, precision, recall, f05)`` for 0.05 to 0.95 by hundredths.

    Scores go to a histogram of 101 bins by label first, so one pass and a few hundred
    rows serve all thresholds. Needs match_probability and label.
    """
    require_columns(scored, "match_probability", "label")
    # The bin of a score is the last hundredth that it reaches; the small term only undoes rounding in the product.
    bins = scored.select(F.floor(F.col("match_probability") * 100 + 1e-9).cast("int").alias("bin"), F.col("label").cast("int").alias("label"))
    histogram = bins.groupBy("bin", "label").agg(F.count(F.lit(1)).alias("n"))
    # Beside the thresholds that it reaches, every bin counts for one below all of them, where all positives meet.
    reached = F.when(F.col("bin") >= FIRST_PERCENT, F.sequence(F.lit(FIRST_PERCENT), F.least("bin", F.lit(LAST_PERCENT)))).otherwise(F.array().cast("array<int>"))
    reached = histogram.select(F.explode(F.concat(F.array(F.lit(FIRST_PERCENT - 1)), reached)).alias("percent"), "label", "n")
    count = lambda label: F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0))
    sums = reached.groupBy("percent").agg(count(1).alias("tp"), count(0).alias("fp"))
    thresholds = scored.sparkSession.range(FIRST_PERCENT - 1, LAST_PERCENT + 1).select(F.col("id").cast("int").alias("percent"))
    rows = thresholds.join(sums, "percent", "left").withColumn("positives", F.coalesce(F.max(F.when(F.col("percent") < FIRST_PERCENT, F.col("tp"))).over(W.partitionBy(F.lit(0))), F.lit(0)))  # 92 rows
    rows = rows.where(F.col("percent") >= FIRST_PERCENT)
    tp, fp = (F.coalesce(c, F.lit(0)) for c in ("tp", "fp"))
    rows = rows.select((F.col("percent") / 100.0).alias("threshold"), tp.alias("tp"), fp.alias("fp"), (F.col("positives") - tp).alias("fn"))
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "fn")}
    precision, recall = ratio(d["tp"], d["tp"] + d["fp"]), ratio(d["tp"], d["tp"] + d["fn"])
    return rows.select("*", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f_beta(precision, recall), 6).alias("f05"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the highest f05, of equal ones that of the lowest threshold."""
    return sweep.orderBy(F.desc("f05"), F.asc("threshold")).limit(1)


def confusion(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    predicted = (F.col("match_probability") >= threshold).cast("int")
    return scored.groupBy(F.col("label").cast("int").alias("label"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(class, precision, recall, f1, support)`` of both classes, their accuracy and their averages."""
    cells = confusion(scored, threshold)
    pick = lambda *cs: F.coalesce(F.sum(F.when(sum(((F.col("label") == a) & (F.col("predicted") == b)).cast("int") for a, b in cs) > 0, F.col("n"))), F.lit(0)).cast("double")
    one = cells.agg(pick((0, 0)).alias("tn"), pick((0, 1)).alias("fp"), pick((1, 0)).alias("fn"), pick((1, 1)).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p0, r0, p1, r1 = ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(tp, tp + fp), ratio(tp, tp + fn)
    f0, f1 = f_beta(p0, r0, 1.0), f_beta(p1, r1, 1.0)
    s0, s1 = tn + fp, tp + fn
    weighted = lambda a, b: ratio(a * s0 + b * s1, n)
    accuracy = ratio(tn + tp, n)
    rows = [
        ("0", p0, r0, f0, s0),
        ("1", p1, r1, f1, s1),
        ("accuracy", accuracy, accuracy, accuracy, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n),
    ]
    structs = [F.struct(F.lit(c).alias("class"), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1"), s.cast("long").alias("support")) for c, p, r, f, s in rows]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _vectors(features: DataFrame) -> DataFrame:
    require_columns(features, *FEATURES)
    return VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(features)


def train_gbt(labelled: DataFrame, split: DataFrame | None = None, rounds: int = 40, **options) -> GBTClassificationModel:
    """Boosted trees on the 21 features; with ``split``, boosting stops when its validation entities no longer gain."""
    require_columns(labelled, "label")
    settings = {"maxIter": rounds, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 100, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.9", "seed": 42} | options
    rows = labelled.withColumn("label", F.col("label").cast("double"))
    if split is not None:
        rows = rows.join(split.select("source1_entity_id", (F.col("split") == "validation").alias("__validation")), "source1_entity_id")
        if not rows.where("__validation").isEmpty():  # of fewer than five entities, none is held out
            settings |= {"validationIndicatorCol": "__validation"}
    return GBTClassifier(featuresCol="__features", labelCol="label", **settings).fit(_vectors(rows))


def gbt_score(features: DataFrame, model: GBTClassificationModel) -> DataFrame:
    scored = model.transform(_vectors(features))
    return scored.withColumn("match_probability", vector_to_array("probability")[1].cast("float")).drop("__features", "rawPrediction", "probability", "prediction")


def save_model(model: GBTClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)
