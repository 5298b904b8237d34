import random

import numpy as np
import pytest

from rillwork.llm import langid, toxicity
from rillwork.llm.common import table
from rillwork.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_through_time_agree_with_differences():
    rng = np.random.default_rng(0)
    net = langid.ByteBiGRU(["a", "b", "c"], hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = rng.integers(0, 257, (6, 5)).astype(np.int16), np.array([0, 1, 2, 1, 0])
    _, g = net.gradients(x, y)
    for name, w in net.w.items():
        flat = w.reshape(-1)
        for k in rng.integers(0, flat.size, 6) if name[0] != "x" else (np.flatnonzero(g[name])[:6]):
            was = flat[k]
            flat[k] = was + 1e-3
            up = net.gradients(x, y)[0]
            flat[k] = was - 1e-3
            down = net.gradients(x, y)[0]
            flat[k] = was
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[k]) < 2e-3


def test_language_of_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: r for r in QUERIES["op3_langid"](spark, SF).collect()}
    want = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert len(got) == docs.count() and len(held) > 200
    assert np.mean([got[i]["lang_pred"] == want[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_the_sample_holds_the_smallest_draws_of_each_language(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "a", "b"]), rng.getrandbits(64) - 2**63) for _ in range(5000)] + [("c", 5), ("c", -(2**63)), ("d", 2**63 - 1)]
    got = [tuple(r) for r in langid._smallest(spark.createDataFrame(rows, "lang string, draw long"), 30).collect()]
    assert sorted(got) == [r for lang in "abcd" for r in sorted(x for x in rows if x[0] == lang)[:30]]


def test_texts_without_letters_and_without_labels(spark, docs):
    df = docs([(1, None), (2, ""), (3, "12 !!"), (4, "été"), (None, "the"), (4, "été")])
    net = langid.ByteBiGRU(["x", "y"])
    got = sorted([tuple(r) for r in langid.identify(df, net).collect()], key=str)
    assert [r[1] for r in got if r[0] in (1, 2, 3)] == ["und"] * 3
    assert all(r[1] in ("x", "y") for r in got if r[0] in (4, None)) and got[-2 if got[-1][0] is None else -1] is not None
    assert all(r[1:] == ("und", 0.0) for r in langid.identify(df, langid.train(df.where("lang is null"))).collect())
    assert langid.identify(df.limit(0), net).collect() == []


def test_windows_cover_whole_texts():
    net = langid.ByteBiGRU(["x", "y"])
    long = b"abc def " * 50
    whole = net.pooled([long, b"", b"a"])
    parts = net.pooled([long[k : k + langid.WINDOW] for k in range(0, len(long), langid.WINDOW)])
    sizes = np.array([len(long[k : k + langid.WINDOW]) for k in range(0, len(long), langid.WINDOW)])
    assert np.allclose(whole[0], (parts * sizes[:, None]).sum(axis=0) / len(long), atol=1e-5)
    assert whole[1].tolist() == [0, 0]


def test_kneser_ney_probabilities_sum_to_one():
    from collections import Counter

    pair = toxicity.KneserNeyPair((Counter({b"ab": 3, b"ac": 1}), Counter({b"bad": 2, b"ab": 1})), order=3)
    for n, (grams, logs, contexts, weights) in enumerate(pair.tables, 1):
        assert np.isfinite(logs).all() and (logs < 0).all()
        assert (weights <= 0).all()
    # The next byte after the start, over all 256, under each class.
    total = np.zeros(2)
    for b in range(256):
        if b in (2,):
            continue
        laid_words = bytes([b])
        p = np.full(2, -np.log(256.0))
        text = toxicity._START * 2 + laid_words
        from rillwork.llm.suffix_dedup import HashedText

        h = HashedText(np.frombuffer(text, np.uint8))
        at = np.array([2])
        for n, (grams, logs, contexts, weights) in enumerate(pair.tables, 1):
            g, c = h.hash(at - n + 1, n)[0], h.hash(at - n + 1, n - 1)[0]
            k = np.flatnonzero(grams == g)
            if n == 1:
                p = p + weights[0]
            else:
                j = np.flatnonzero(contexts == c)
                p = p + (weights[j[0]] if len(j) else 0)
            if len(k):
                p = logs[k[0]].astype(float)
        total += np.exp(p)
    assert np.all(total < 1.0 + 1e-6) and np.all(total > 0.98)


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    plain = ["house", "river", "green", "walks", "table", "window", "paper", "sings"]
    bad = ["grubling", "grubster", "grubbed", "vexolant", "vexoling"]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        for _ in range(2 + len(words) // 20 if y else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), y))
    return rows


def test_toxic_texts_are_told_apart_with_unseen_variants():
    rows = toxic_corpus(400, 1)
    m = toxicity.ToxicityModel([t for _, t, _ in rows], [y for _, _, y in rows], 0.3)
    held = toxic_corpus(200, 2)
    assert np.mean([(m.score(t) >= 0.5) == y for _, t, y in held]) > 0.98
    assert m.score("river grubbian table vexolist green house") > 0.5 > m.score("river table green house")
    assert m.score(None) == m.score("") == m.score("1 2 !") == 0.3


@pytest.mark.parametrize("labels, want", [([], 0.0), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_too_few_classes(spark, docs, labels, want):
    df = docs([(1, "a b"), (2, None), (None, "x")])
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r["score"] for r in toxicity.score_toxicity(df, model).collect()] == [want] * 3
    assert toxicity.score_toxicity(df.limit(0), model).collect() == []


def test_toxicity_query(spark):
    got = QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(got) == table(spark, SF, "documents").count()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_all_labelled_rows_are_counted_whole(spark, docs):
    rng = random.Random(5)
    rare = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(80)]
    rows = [(i, "house river green " * 700 + w + " paper" * 10) for i, w in enumerate(rare)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.train(docs(rows), labels, per_class=8)
    known = set(model.pair.tables[-1][0].tolist())
    laid = toxicity._Laid([w.encode() for w in rare], toxicity.ORDER)
    assert all(g in known for g in laid.grams(toxicity.ORDER).tolist())
    in_memory = toxicity.ToxicityModel([t for _, t in rows], [i % 2 for i in range(80)], 0.5)
    for a, b in zip(model.pair.tables, in_memory.pair.tables):
        assert all(np.array_equal(x, y) for x, y in zip(a, b))
