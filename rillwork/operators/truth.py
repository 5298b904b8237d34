"""Ground truth: its pairs, its statistics, and the recall of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.metrics import ratio
from rillwork.functions.text import is_blank, stripped
from rillwork.operators.blocking import PAIR


def truth_pairs(truth: DataFrame) -> DataFrame:
    """Distinct ``(source1_entity_id, candidate_entity_id)`` of the comma-separated lists."""
    some = truth.where(~is_blank(F.col("matched_entity_ids")))
    each = some.select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("id"))
    return each.select("source1_entity_id", stripped(F.col("id")).alias("candidate_entity_id")).where("candidate_entity_id <> ''").distinct()


def zero_match(truth: DataFrame) -> DataFrame:
    """The ids whose list is null or blank."""
    return truth.where(is_blank(F.col("matched_entity_ids"))).select("source1_entity_id")


def split_by_source(pairs: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The pairs whose candidate is in a source, with its name as ``candidate_source``."""
    parts = [pairs.join(ids.select(F.col("entity_id").alias(PAIR[1])), PAIR[1], "left_semi").select(*PAIR, F.lit(name).alias("candidate_source")) for name, ids in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconciliation(pairs: DataFrame, by_source: DataFrame) -> DataFrame:
    """One row: all true pairs, those that a source holds, those in several, and those in none, which ``split_by_source`` leaves out."""
    held = by_source.groupBy(*PAIR).agg(F.count_distinct("candidate_source").alias("__n"))
    marked = pairs.distinct().join(held, PAIR, "left")
    n = F.coalesce(F.col("__n"), F.lit(0))
    return marked.agg(F.count(F.lit(1)).alias("true_pairs"), F.count_if(n > 0).alias("held_pairs"), F.count_if(n > 1).alias("shared_pairs"), F.count_if(n == 0).alias("lost_pairs"))


def match_stats(truth: DataFrame) -> DataFrame:
    """One row: entities, those with none, one or more matches, the most and the mean."""
    ids = F.filter(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: stripped(x) != "")
    n = F.size(ids)
    rows = truth.select(n.alias("n"))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).alias("entities"),
        count(F.col("n") == 0).alias("zero_match"),
        count(F.col("n") == 1).alias("single_match"),
        count(F.col("n") > 1).alias("multi_match"),
        F.max("n").cast("long").alias("max_matches"),
        F.round(F.avg("n"), 6).alias("mean_matches"),
    )


def recall(by_source: DataFrame, found: DataFrame) -> DataFrame:
    """``(candidate_source, true_pairs, retrieved_pairs, missed_pairs, recall)`` of each source and of ``overall``.

    by_source: true pairs with candidate_source. found: candidate pairs.
    """
    marked = by_source.join(found.select(*PAIR).distinct().withColumn("__found", F.lit(1)), PAIR, "left")
    totals = [F.count(F.lit(1)).alias("true_pairs"), F.coalesce(F.sum("__found"), F.lit(0)).cast("long").alias("retrieved_pairs")]
    each = marked.groupBy("candidate_source").agg(*totals)
    overall = each.agg(F.coalesce(F.sum("true_pairs"), F.lit(0)).cast("long").alias("true_pairs"), F.coalesce(F.sum("retrieved_pairs"), F.lit(0)).cast("long").alias("retrieved_pairs"))
    both = each.unionByName(overall.select(F.lit("overall").alias("candidate_source"), "*"))
    share = F.round(ratio(F.col("retrieved_pairs").cast("double"), F.col("true_pairs").cast("double")), 6)
    return both.select("*", (F.col("true_pairs") - F.col("retrieved_pairs")).alias("missed_pairs"), share.alias("recall"))


def missed_pairs(by_source: DataFrame, found: DataFrame, limit: int | None = None) -> DataFrame:
    """The true pairs that are no candidates; with ``limit``, the first ones by id."""
    missed = by_source.join(found.select(*PAIR), PAIR, "left_anti")
    return missed.orderBy(*PAIR).limit(limit) if limit is not None else missed


def true_counts(true: DataFrame) -> DataFrame:
    """``(source1_entity_id, n_actual)``, a row per entity of source 1: how many entities of the others share a hash with it.

    true: ``(entity_id, n, truth)``, a row per entity, truth an array of hashes. Hashes are counted; only entities of several meet theirs one by one.
    """
    each = true.select("entity_id", "n", "truth", F.explode("truth").alias("h"))
    others, ones = each.where("n <> 1 and entity_id is not null").select("h", F.col("entity_id").alias("__id")), each.where("n = 1")
    by_hash = others.groupBy("h").agg(F.count(F.lit(1)).alias("n_actual"))
    single = ones.where(F.size("truth") == 1).join(by_hash, "h").select("entity_id", "n_actual")
    several = ones.where(F.size("truth") > 1).join(others, "h").groupBy("entity_id").agg(F.count_distinct("__id").alias("n_actual"))
    counts = true.where("n = 1").select("entity_id").join(single.unionByName(several), "entity_id", "left")
    return counts.select(F.col("entity_id").alias(PAIR[0]), F.coalesce("n_actual", F.lit(0)).alias("n_actual"))


def id_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many ids two sources share."""
    ids = a.select("entity_id").intersect(b.select("entity_id"))
    return ids.agg(F.count(F.lit(1)).alias("shared_ids"))
