"""Blocking, truth, features, sampling, evaluation, results, validation and profiles on small tables."""

import pytest
from pyspark.sql import functions as F

from rillwork.operators import blocking, evaluate, features, profile, results, sampling, scoring, truth, validate
from rillwork.operators.normalize import normalize_source
from rillwork.plans import queries
from rillwork.sources.schemas import GROUND_TRUTH, SOURCE

PAIRS = "source1_entity_id string, candidate_entity_id string"


def source(spark, *rows):
    return normalize_source(spark.createDataFrame(list(rows), SOURCE))


@pytest.fixture(scope="module")
def sides(spark):
    s1 = source(spark, ("S1-1", "Acme Corp", "1 Main St", "US"), ("S1-2", "", "2 Oak", "US"), ("S1-3", None, None, "FR"), ("S1-4", "Beta", "1 Main St", "US"))
    s2 = source(spark, ("S2-1", "ACME corp.", "1 main st", "US"), ("S2-2", "corp acme", "9 Elm", "US"), ("S2-3", "", "", "US"), ("S2-4", "Betamax", "7 Oak", "US"))
    return s1, s2


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_candidates_carry_their_blocks(sides):
    found = blocking.candidates(*sides, "s2")
    got = {(r[0], r[1]): (r["block_support_count"], r["blocks"]) for r in found.collect()}
    assert got["S1-1", "S2-1"] == (6, sorted(b.name for b in blocking.BLOCKS))
    assert got["S1-1", "S2-2"] == (1, ["sorted_name"])
    assert got["S1-4", "S2-4"] == (1, ["name_prefix4"])
    assert all(n == len(b) for n, b in got.values())
    assert not any("S1-3" in k or "S2-3" in k for k in got)  # empty keys pair with nothing


def test_cap_is_inclusive_and_by_side(spark):
    keys = spark.createDataFrame([("a", "k"), ("b", "k"), ("c", "k"), ("d", "m"), ("e", ""), ("f", None)], "entity_id string, exact_name string")
    assert rows(blocking.size_filter(keys, "exact_name", 3), "entity_id") == [("a",), ("b",), ("c",), ("d",)]
    assert rows(blocking.size_filter(keys, "exact_name", 2), "entity_id") == [("d",)]
    other = spark.createDataFrame([("x", "k"), ("a", "k")], "entity_id string, exact_name string")
    assert blocking.block_pairs(keys, other, "exact_name", 2).count() == 0
    assert ("a", "a") not in rows(blocking.block_pairs(keys, other, "exact_name", 3), "source1_entity_id", "candidate_entity_id")


def test_keys_over_the_cap_go_whether_they_travel_or_not(spark, monkeypatch):
    keys = [(f"{k}-{i}", k) for k, n in (("hot", 9), ("warm", 6), ("fits", 3), ("one", 1)) for i in range(n)]
    df = spark.createDataFrame(keys, "entity_id string, exact_name string")
    for most in (1, 10_000):
        monkeypatch.setattr(blocking, "MAX_HOT", most)
        assert [r[0][:4] for r in rows(blocking.size_filter(df, "exact_name", 3), "entity_id")] == ["fits"] * 3 + ["one-"]


def test_no_rows_keep_the_schema(sides):
    none = blocking.candidates(sides[0].limit(0), sides[1], "s2")
    assert none.count() == 0 and none.columns == [*blocking.PAIR, "candidate_source", "block_support_count", "blocks"]


def test_stats_reconcile(sides):
    stats = {r["block_name"]: r for r in blocking.candidate_stats(*sides, "s2").collect()}
    assert stats["total"]["raw_pairs"] == sum(r["raw_pairs"] for n, r in stats.items() if n != "total")
    assert stats["total"]["distinct_pairs"] == blocking.candidates(*sides, "s2").count()


def test_truth_pairs_and_stats(spark):
    gt = spark.createDataFrame([("a", None), ("b", "  "), ("c", "x, y"), ("d", "x,,y"), ("e", "x,x"), ("f", " x ")], GROUND_TRUTH)
    pairs = truth.truth_pairs(gt)
    assert rows(pairs, *blocking.PAIR) == [("c", "x"), ("c", "y"), ("d", "x"), ("d", "y"), ("e", "x"), ("f", "x")]
    assert rows(truth.zero_match(gt), "source1_entity_id") == [("a",), ("b",)]
    s = truth.match_stats(gt).first()
    assert (s["entities"], s["zero_match"], s["single_match"], s["multi_match"], s["max_matches"]) == (6, 2, 1, 3, 2)


def test_recall_and_missed(spark):
    by = spark.createDataFrame([("a", "x", "s2"), ("a", "y", "s3"), ("b", "x", "s2")], PAIRS + ", candidate_source string")
    found = spark.createDataFrame([("a", "x"), ("a", "x"), ("z", "z")], PAIRS)
    got = {r["candidate_source"]: (r["true_pairs"], r["retrieved_pairs"], r["missed_pairs"], r["recall"]) for r in truth.recall(by, found).collect()}
    assert got == {"s2": (2, 1, 1, 0.5), "s3": (1, 0, 1, 0.0), "overall": (3, 1, 2, 0.333333)}
    assert rows(truth.missed_pairs(by, found), *blocking.PAIR) == [("a", "y"), ("b", "x")]
    assert truth.missed_pairs(by, found, limit=1).count() == 1
    assert truth.recall(by.limit(0), found).first()["recall"] == 0.0


def test_features_of_empty_and_unknown_sides(spark, sides):
    pairs = spark.createDataFrame([("S1-2", "S2-3", 1), ("S1-1", "S2-1", 6), ("S1-3", "gone", 2)], PAIRS + ", block_support_count int")
    score = {r[0]: r for r in features.pair_features(pairs, *sides).collect()}
    assert set(score) == {"S1-1", "S1-2"} and list(score["S1-1"].asDict())[2:] == features.FEATURES
    assert len(features.FEATURES) == 21
    assert (score["S1-2"]["name_exact"], score["S1-2"]["name_token_overlap"], score["S1-2"]["s1_name_len"]) == (1, 1, 0)
    assert score["S1-1"]["address_exact"] == 1 and score["S1-1"]["house_number_exact"] == 1
    train = {r[0]: r for r in features.pair_features(pairs, *sides, how="left").collect()}
    assert train["S1-3"]["name_exact"] == 0 and train["S1-3"]["block_support_count_feature"] == 2


def test_repeated_tokens_overlap_once(spark):
    s1, s2 = source(spark, ("1", "a b a", "", "")), source(spark, ("2", "a a b", "", ""))
    pairs = spark.createDataFrame([("1", "2", 1)], PAIRS + ", block_support_count int")
    assert features.pair_features(pairs, s1, s2).first()["name_token_overlap"] == 2


def test_samples_are_disjoint_and_exact(spark):
    candidates = spark.createDataFrame([(f"a{i}", f"x{i}", 1) for i in range(200)], PAIRS + ", block_support_count int")
    true = spark.createDataFrame([(f"a{i}", f"x{i}") for i in range(0, 200, 5)] + [("q", "q")], PAIRS)
    positive, negative = sampling.positive_pairs(true, candidates), sampling.negative_sample(true, candidates)
    assert positive.count() == negative.count() == 40
    assert positive.join(negative, blocking.PAIR).count() == 0
    assert sampling.negative_sample(true, candidates, ratio=0.5).count() == 20
    assert sampling.negative_sample(true, candidates, most=7).count() == 7
    first = negative.withColumn("h", sampling.pair_hash()).agg(F.max("h")).first()[0]
    rest = candidates.select(*blocking.PAIR).join(true, blocking.PAIR, "left_anti").join(negative, blocking.PAIR, "left_anti")
    assert rest.where(sampling.pair_hash() <= first).count() == 0


def test_split_holds_out_an_exact_share_of_entities(spark):
    ids = spark.createDataFrame([(f"S1-{i % 33}",) for i in range(99)], "source1_entity_id string")
    split = {r[0]: r[1] for r in sampling.entity_split(ids).collect()}
    assert len(split) == 33 and sum(v == "validation" for v in split.values()) == 6


def test_entity_scores(spark):
    ids = spark.createDataFrame([(c,) for c in "abcdef"], "source1_entity_id string")
    predicted = spark.createDataFrame([("c", "x"), ("d", "x"), ("e", "x"), ("e", "y"), ("f", "x")], PAIRS)
    actual = spark.createDataFrame([("b", "x"), ("d", "x"), ("e", "x"), ("f", "x"), ("f", "y")], PAIRS)
    by = evaluate.entity_f05(ids, predicted, actual)
    assert {r[0]: r["f05"] for r in by.collect()} == {"a": 1.0, "b": 0.0, "c": 0.0, "d": 1.0, "e": 0.555556, "f": 0.833333}
    m = evaluate.entity_metrics(by).first()
    assert (m["tp"], m["fp"], m["fn"], m["correct_zero_match"], m["actual_nonzero"]) == (3, 2, 2, 1, 4)


def test_sweep_agrees_with_a_plain_count(spark):
    data = [(k / 100.0, int(k % 3 == 0)) for k in range(0, 101, 3)] + [(0.05, 0), (0.95, 1), (1.0, 0), (0.0, 1)]
    sweep = scoring.threshold_sweep(spark.createDataFrame(data, "match_probability double, label int"))
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in sweep.collect()}
    assert len(got) == 91
    for n in range(5, 96):
        tp = sum(y for p, y in data if p >= n / 100)
        assert got[n / 100] == (tp, sum(1 - y for p, y in data if p >= n / 100), sum(y for _, y in data) - tp)


def test_best_threshold_takes_the_lowest_of_equals(spark):
    sweep = spark.createDataFrame([(0.3, 0.5), (0.2, 0.9), (0.1, 0.9)], "threshold double, f05 double")
    assert scoring.best_threshold(sweep).first()["threshold"] == 0.1


def test_results_and_rules(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    scored = spark.createDataFrame([("S1-1", "S2-9", "s2"), ("S1-1", "S2-10", "s2"), ("S1-1", "S2-9", "s3")], PAIRS + ", candidate_source string")
    pairs = results.candidate_pairs_out(scored)
    assert rows(pairs, "candidate_entity_id", "candidate_source") == [("S2-10", "s2"), ("S2-9", "s2")]
    out = results.matching_results(ids("S1-1", "S1-2"), pairs)
    assert rows(out, *out.columns) == [("S1-1", "S2-10,S2-9"), ("S1-2", "")]
    assert rows(results.match_distribution(out), "n_matches", "entities") == [(0, 1), (2, 1)]
    good = validate.validation_rules(pairs, out, ids("S1-1", "S1-2"), ids("S2-9", "S2-10"), ids("S3-1"))
    assert validate.require_valid(good).count() == 18
    bad = validate.validation_rules(scored, out, ids("S1-1"), ids("S2-9"), ids("S2-9"))
    broken = {r[0]: r[1] for r in bad.collect() if r[1]}
    assert broken == {"s2_s3_shared_ids": 1, "pair_duplicates": 1, "pair_unknown_s2": 1, "result_extra_s1": 1, "matched_unknown_ids": 1}
    with pytest.raises(validate.ValidationError):
        validate.require_valid(bad)


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", " "), (None, None)], "entity_id string, name string")
    r = profile.id_profile(df).first()
    assert (r["rows"], r["distinct_ids"], r["extra_copies"], r["rows_with_shared_id"], r["null_ids"]) == (4, 2, 1, 2, 1)
    a = {r[0]: r for r in profile.column_audit(df).collect()}
    assert (a["name"]["nulls"], a["name"]["blanks"], a["name"]["distinct_values"], a["name"]["max_length"]) == (1, 2, 2, 1)
    d = profile.duplicate_rows(df).first()
    assert (d["rows"], d["distinct_rows"], d["duplicate_rows"]) == (4, 3, 1)
    n = profile.length_profile(spark.createDataFrame([("x" * k,) for k in (1, 2, 3, 10)], "s string"), "s").first()
    assert (n["p25_length"], n["median_length"], n["mean_length"]) == (1.75, 2.5, 4.0)
    assert rows(profile.value_counts(df, "name"), "value", "rows") == [("", 1), ("<NULL>", 1), ("x", 2)]


def test_boosted_trees_train_score_and_reload(spark, tmp_path):
    data = [(f"S1-{i}", f"S2-{i}", i % 2, *[(i % 2) if k < 5 else i % 7 for k in range(21)]) for i in range(300)]
    labelled = spark.createDataFrame(data, PAIRS + ", label int, " + ", ".join(f"{f} int" for f in features.FEATURES))
    split = sampling.entity_split(labelled)
    model = scoring.train_gbt(labelled, split, rounds=5, minInstancesPerNode=1)
    scoring.save_model(model, str(tmp_path / "m"))
    scored = scoring.gbt_score(labelled, scoring.load_model(str(tmp_path / "m")))
    assert scored.where("(match_probability >= 0.5) <> (label = 1)").count() == 0
    report = {r[0]: r for r in scoring.classification_report(scored, 0.5).collect()}
    assert report["accuracy"]["f1"] == 1.0 and report["1"]["support"] == 150


def test_the_registered_trees_are_the_production_ones(spark, monkeypatch):
    data = [(f"S1-{i}", f"S2-{i}", i % 2, *[i % 7] * 21) for i in range(4)]
    labelled = spark.createDataFrame(data, PAIRS + ", label int, " + ", ".join(f"{f} int" for f in features.FEATURES))
    assert scoring.train_gbt(labelled, sampling.entity_split(labelled), rounds=2).getNumTrees == 2  # nothing is held out of four
    asked = {}

    def train(rows, split=None, rounds=40, **options):
        asked.update(split=split, rounds=rounds, options=options)
        raise InterruptedError

    monkeypatch.setattr(queries.sampling, "labelled_pairs", lambda *_: labelled)
    monkeypatch.setattr(queries.features, "pair_features", lambda *_, **__: labelled)
    monkeypatch.setattr(queries.scoring, "train_gbt", train)
    with pytest.raises(InterruptedError):
        queries.gbt_scored_pairs(spark, "/root/testdata/sf0.001")
    assert asked["split"] is not None and asked["rounds"] == 700 and not asked["options"]


def test_features_are_worked_out_where_pairs_are_found(spark):
    """Nested blocks of which only some are under their caps, repeated ids with other rows, short and empty keys: as candidates joined with their rows."""
    names = ["abcdefgh", "abcdefgh", "abcdef zz", "abcd", "ab", "", None, "zz abcdef", "Ä bcd 7", "abcdxx"]
    rows = [(f"S{n}-{k % 17}", names[(k * n + k // 5) % len(names)], f"{k % 4} Road {1000 + k % 3}", "de" if k % 2 else None, n) for n in (1, 2, 3) for k in range(20)]
    every = normalize_source(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, n int")).cache()
    side = {n: every.where(F.col("n") == n).drop("n") for n in (1, 2, 3)}
    keyed = blocking.keyed(every, "n", *features.facts(features.FEATURES))
    carried = [c for c in keyed.columns if c not in ("entity_id", "n", "keys")]
    for caps in ({"name_prefix4": 6, "name_prefix6": 2, "numeric_address": 1}, {"name_prefix4": 0, "name_prefix6": 4, "exact_address": 0}):
        linked = blocking.linked_pairs(keyed, {2: "s2", 3: "s3"}, carried, caps)
        got = linked.select(*blocking.PAIR, "candidate_source", *features.of_facts(features.FEATURES))
        want = [features.pair_features(blocking.candidates(side[1], side[n], f"s{n}", caps).drop("blocks"), side[1], side[n]) for n in (2, 3)]
        want = want[0].unionByName(want[1])
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_candidate_pairs_do_not_travel(spark):
    """Where pairs are scored, no exchange stands above the join that makes them, and nothing but hashes and lengths is carried."""
    from rillwork.plans.queries import QUERIES

    for name in ("scored_pairs", "pair_features_score"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not {"business_address_norm", "business_address_tokens"} & set(plan.replace("#", " ").split())
        physical = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        join = next(k for k, x in enumerate(physical) if "Join" in x)
        assert not any("Aggregate" in x or "Exchange" in x for x in physical[:join])


def _repeated(spark, path):
    """Documents of which some repeat an id with other texts, and some copy a text under another feed."""
    texts = ["Acme corp abc. Main street 12, 10115", "Acme corp abc. Main street 12, 10115", "Acme corp abc. Oak road 7", "Acme corp xyz. Main street 12, 10115", "Beta. 1", "", None, "Acme corp abc"]
    rows = [(k % 19, texts[(k * k + k // 7) % len(texts)], "en" if k % 3 else None, f"feed-{k % 3}", k % 2) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return str(path)


ACCEPTED = ("candidate_pairs_out", "ordered_pairs_out", "entity_f05", "entity_metrics", "validation_metrics", "matching_results", "match_distribution", "threshold_sweep", "classification_report", "best_threshold")


def test_accepted_pairs_of_repeated_ids(spark, tmp_path):
    import duckdb

    from rillwork.plans.oracle import ORACLE

    d = _repeated(spark, tmp_path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet/*.parquet'")
    plain = lambda rs: sorted([tuple(f"{v:.9g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rs])
    for name in ACCEPTED:
        df = queries.QUERIES[name](spark, d)
        cols = sorted(df.columns)
        assert plain(df.select(*cols).collect()) == plain(duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()) != [], name


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted_and_true_pairs_are_neither_staged_nor_grouped_by_pair(spark, monkeypatch, name):
    """Of pairs, only the lists of the ordered file and of the results travel, once each."""
    from rillwork.plans import entities

    labels, kept = [], entities.staged
    monkeypatch.setattr(entities, "staged", lambda df, label: labels.append(label) or kept(df, label))
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not {"predicted", "true"} & set(labels) and ("pairs" in labels) == (name == "ordered_pairs_out")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate [source1_entity_id" in x and "candidate_entity_id" in x.split("],")[0]]
    if name == "candidate_pairs_out":
        physical = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        join = next(k for k, x in enumerate(physical) if "Join" in x)
        assert not any("Aggregate" in x or "Exchange" in x for x in physical[:join])


def test_pairs_of_a_hot_key_are_dealt_out_over_cells(spark, monkeypatch):
    """One key of 12 by 9 entities: no task gets all its pairs, and they are the same ones, also from links at hand."""
    data = [(f"S{n}-{k}", "Acme", None, "de", n) for n, most in ((1, 12), (2, 6), (3, 3)) for k in range(most)]
    every = normalize_source(spark.createDataFrame(data, "entity_id string, business_name string, business_address string, country string, n int"))
    keyed = blocking.keyed(every, "n")
    monkeypatch.setattr(blocking, "CELL", 4)
    linked = blocking.links(keyed, {2: "s2", 3: "s3"})
    assert {k["g"] for r in linked.collect() for k in r["ks"]} == {6}  # the square root of 108 / 4, rounded up
    want = sorted((f"S1-{a}", f"S{n}-{b}") for a in range(12) for n, most in ((2, 6), (3, 3)) for b in range(most))
    for at_hand in (None, linked):
        pairs = blocking.linked_pairs(keyed, {2: "s2", 3: "s3"}, [], linked=at_hand)
        assert rows(pairs, *blocking.PAIR) == want and {r["block_support_count"] for r in pairs.collect()} == {4}


def test_labelled_pairs_of_candidates_with_labels(spark):
    candidates = spark.createDataFrame([(f"a{i}", f"x{i}", i % 6 + 1) for i in range(200)], PAIRS + ", block_support_count int")
    for step in (5, 2, 1, 1000):  # of the last, no positive: no negative either
        true = spark.createDataFrame([(f"a{i}", f"x{i}") for i in range(3 if step < 1000 else 200, 201, step)], PAIRS)
        labelled = candidates.join(true.withColumn("label", F.lit(1)), blocking.PAIR, "left").fillna(0, ["label"])
        for most in (7, 8_000_000):
            got, want = sampling.labelled_of(labelled, most=most), sampling.labelled_pairs(true, candidates, most=most)
            assert sorted(rows(got, *want.columns)) == sorted(rows(want, *want.columns)), (step, most)


def test_pairs_are_linked_once_for_training_and_scoring(spark, monkeypatch):
    """Keys are counted once; of the pairs, only the labelled ones are kept, before wide facts are met."""
    from rillwork.plans import entities

    labels, kept = [], entities.staged
    note = lambda df, label: labels.append((label, df.columns)) or kept(df, label)
    monkeypatch.setattr(entities, "staged", note)
    monkeypatch.setattr(sampling, "staged", note)

    def train(*_, **__):
        raise InterruptedError

    monkeypatch.setattr(queries.scoring, "train_gbt", train)
    with pytest.raises(InterruptedError):
        queries.gbt_scored_pairs(spark, "/root/testdata/sf0.001")
    assert [x for x, _ in labels].count("links") == 1 and [x for x, _ in labels].count("labelled") == 1
    assert not [f for f in features.FEATURES if f in dict(labels)["labelled"]]
