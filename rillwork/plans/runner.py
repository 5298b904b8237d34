"""The linkage flow from files to files, stage by stage, with a report of each.

``python -m rillwork.plans.runner --input DIR --output DIR [--stage NAME ...]``. DIR of
the input holds ``train/`` and ``test/`` with ``source1.tsv``, ``source2.tsv``, ``source3.tsv``,
and ``train/ground_truth.tsv``. Each stage reads what earlier ones wrote, so any may be run by itself.
"""

from __future__ import annotations

import argparse
import platform
import time
from collections.abc import Callable
from dataclasses import dataclass

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.operators import blocking, evaluate, features, profile, results, sampling, scoring, truth, validate
from rillwork.operators.normalize import normalize_source
from rillwork.sources import files
from rillwork.sources.schemas import CANDIDATE_PAIRS, MATCHING_RESULTS


@dataclass(frozen=True)
class Config:
    """Paths and parameters, passed explicitly; nothing depends on the working directory."""

    input: str
    output: str
    negative_ratio: float = 1.0
    most_negatives: int = 8_000_000
    validation_share: float = 0.2
    threshold: float = scoring.THRESHOLD
    rounds: int = 40
    min_leaf: int = 100
    missed_limit: int = 100_000

    def raw(self, split: str, name: str) -> str:
        return f"{self.input}/{split}/{name}.tsv"

    def out(self, *parts: str) -> str:
        return "/".join((self.output, *parts))


SPLITS, TARGETS = ("train", "test"), (2, 3)


def environment(spark: SparkSession, c: Config) -> dict:
    return {"python": platform.python_version(), "pyspark": pyspark.__version__, "master": spark.sparkContext.master, "parallelism": spark.sparkContext.defaultParallelism}


def _source(spark: SparkSession, c: Config, split: str, n: int) -> DataFrame:
    return files.read_source(spark, c.raw(split, f"source{n}"))


def _normalized(spark: SparkSession, c: Config, split: str, n: int) -> DataFrame:
    return files.read_parquet(spark, c.out("normalized", split, f"source{n}"))


def _candidates(spark: SparkSession, c: Config, split: str) -> DataFrame:
    return files.read_parquet(spark, *(c.out("candidates", split, f"s{n}") for n in TARGETS))


def _true(spark: SparkSession, c: Config) -> DataFrame:
    return truth.truth_pairs(files.read_ground_truth(spark, c.raw("train", "ground_truth")))


def _rows(df: DataFrame) -> list[dict]:
    """A report's rows; only for results of a few rows."""
    return [r.asDict() for r in df.collect()]


def audit(spark: SparkSession, c: Config) -> dict:
    report = {}
    for split in SPLITS:
        for n in (1, 2, 3):
            df = _source(spark, c, split, n)
            report[f"{split}_source{n}"] = {"columns": _rows(profile.column_audit(df)), "ids": _rows(profile.id_profile(df)), "duplicates": _rows(profile.duplicate_rows(df)), "countries": _rows(profile.value_counts(df, "country", 50)), "samples": [r[0] for r in profile.sample_values(df, "entity_id").collect()]}
    report["ground_truth"] = _rows(truth.match_stats(files.read_ground_truth(spark, c.raw("train", "ground_truth"))))
    return report


def profiles(spark: SparkSession, c: Config) -> dict:
    return {f"{split}_source{n}": [r for col in ("business_name", "business_address") for r in _rows(profile.length_profile(_source(spark, c, split, n), col))] for split in SPLITS for n in (1, 2, 3)}


def normalize(spark: SparkSession, c: Config) -> dict:
    for split in SPLITS:
        for n in (1, 2, 3):
            files.write_parquet(normalize_source(_source(spark, c, split, n)), c.out("normalized", split, f"source{n}"))
    return {"written": 6}


def candidates(spark: SparkSession, c: Config) -> dict:
    report = {}
    for split in SPLITS:
        one = _normalized(spark, c, split, 1)
        for n in TARGETS:
            target = _normalized(spark, c, split, n)
            files.write_parquet(blocking.candidates(one, target, f"s{n}"), c.out("candidates", split, f"s{n}"))
            report[f"{split}_s{n}"] = _rows(blocking.candidate_stats(one, target, f"s{n}"))
    return report


def recall(spark: SparkSession, c: Config) -> dict:
    by = truth.split_by_source(_true(spark, c), {f"s{n}": _normalized(spark, c, "train", n) for n in TARGETS})
    found = _candidates(spark, c, "train")
    files.write_parquet(truth.missed_pairs(by, found, c.missed_limit), c.out("recall", "missed"))
    return {"recall": _rows(truth.recall(by, found)), "shared_ids": _rows(truth.id_overlap(*(_normalized(spark, c, "train", n) for n in TARGETS)))}


def train_features(spark: SparkSession, c: Config) -> dict:
    pairs = sampling.labelled_pairs(_true(spark, c), _candidates(spark, c, "train"), c.negative_ratio, c.most_negatives)
    targets = _normalized(spark, c, "train", 2).unionByName(_normalized(spark, c, "train", 3))
    rows = sampling.shuffled(features.pair_features(pairs, _normalized(spark, c, "train", 1), targets, how="left"))
    files.write_parquet(rows, c.out("features", "train"), level=3)
    return {"labels": _rows(files.read_parquet(spark, c.out("features", "train")).groupBy("label").count().orderBy("label"))}


def train(spark: SparkSession, c: Config) -> dict:
    labelled = files.read_parquet(spark, c.out("features", "train"))
    split = sampling.entity_split(labelled, c.validation_share)
    model = scoring.train_gbt(labelled, split, c.rounds, minInstancesPerNode=c.min_leaf)
    scoring.save_model(model, c.out("model"))
    files.write_parquet(split, c.out("split"))
    held = labelled.join(split.where("split = 'validation'").select("source1_entity_id"), "source1_entity_id", "left_semi")
    scored = scoring.gbt_score(held, model)
    sweep = scoring.threshold_sweep(scored)
    return {"trees": model.getNumTrees, "entities": _rows(split.groupBy("split").count()), "sweep": _rows(sweep.orderBy("threshold")), "best": _rows(scoring.best_threshold(sweep)), "report": _rows(scoring.classification_report(scored, c.threshold))}


def entity_decision(spark: SparkSession, c: Config) -> dict:
    held = files.read_parquet(spark, c.out("split")).where("split = 'validation'").select("source1_entity_id")
    rows = files.read_parquet(spark, c.out("features", "train")).join(held, "source1_entity_id", "left_semi")
    predicted = scoring.accepted(scoring.gbt_score(rows, scoring.load_model(c.out("model"))), c.threshold)
    return {"metrics": _rows(evaluate.entity_metrics(evaluate.entity_f05(held, predicted, _true(spark, c))))}


def inference(spark: SparkSession, c: Config) -> dict:
    model, one, report = scoring.load_model(c.out("model")), _normalized(spark, c, "test", 1), {}
    for n in TARGETS:
        pairs = files.read_parquet(spark, c.out("candidates", "test", f"s{n}")).drop("blocks")
        scored = scoring.gbt_score(features.pair_features(pairs, one, _normalized(spark, c, "test", n)), model)
        accepted = scoring.accepted(scored, c.threshold).select(*blocking.PAIR, "candidate_source", "match_probability")
        files.write_parquet(accepted, c.out("scored", f"s{n}"))
        report[f"s{n}"] = {"candidates": pairs.count(), "accepted": files.read_parquet(spark, c.out("scored", f"s{n}")).count()}
    return report


def results_out(spark: SparkSession, c: Config) -> dict:
    pairs = results.candidate_pairs_out(*(files.read_parquet(spark, c.out("scored", f"s{n}")) for n in TARGETS))
    found = results.matching_results(_source(spark, c, "test", 1), pairs)
    files.write_tsv(results.ordered_pairs(pairs), c.out("final", "candidate_pairs.tsv"), single_file=True)
    files.write_tsv(found.orderBy("source1_entity_id"), c.out("final", "matching_results.tsv"), single_file=True)
    return {"by_source": _rows(pairs.groupBy("candidate_source").count().orderBy("candidate_source")), "distribution": _rows(results.match_distribution(found).orderBy("n_matches"))}


def validation(spark: SparkSession, c: Config) -> dict:
    pairs = files.read_tsv(spark, c.out("final", "candidate_pairs.tsv"), CANDIDATE_PAIRS, keep_missing=True)
    found = files.read_tsv(spark, c.out("final", "matching_results.tsv"), MATCHING_RESULTS, keep_missing=True)
    rules = validate.validation_rules(pairs, found, *(files.read_source(spark, c.raw("test", f"source{n}"), ["entity_id"]) for n in (1, 2, 3)))
    rules = rules.cache()
    report = {"rules": _rows(rules), "zero_match": found.where(F.coalesce(F.trim("matched_entity_ids"), F.lit("")) == "").count()}
    validate.require_valid(rules)
    return report


STAGES: dict[str, Callable[[SparkSession, Config], dict]] = {
    f.__name__: f for f in (environment, audit, profiles, normalize, candidates, recall, train_features, train, entity_decision, inference, results_out, validation)
}


def run(spark: SparkSession, config: Config, stages: list[str] | None = None) -> dict[str, dict]:
    """Run stages in order; each writes ``reports/<stage>.json``. The first failure ends the run."""
    reports = {}
    for name in stages or list(STAGES):
        began = time.time()
        reports[name] = STAGES[name](spark, config) | {"seconds": round(time.time() - began, 3)}
        files.write_json(spark, reports[name], config.out("reports", f"{name}.json"))
    return reports


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--threshold", type=float, default=scoring.THRESHOLD)
    parser.add_argument("--stage", action="append", choices=list(STAGES))
    args = parser.parse_args()
    spark = SparkSession.builder.appName("rillwork").getOrCreate()
    run(spark, Config(args.input, args.output, threshold=args.threshold), args.stage)


if __name__ == "__main__":
    main()
