import random
import re

import numpy as np

from rillwork.llm.decontaminate import Phrases, PositionalIndex, Postings, benchmark_matches, contamination, drop_contaminated, index_matches, positional_index

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def tokens(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, window=13):
    out = []
    for i, t in rows:
        w, hit, found = tokens(t), set(), set()
        for item, text in items:
            q = tokens(text)
            size = min(window, len(q))
            phrases = {tuple(q[k : k + size]) for k in range(len(q) - size + 1)} if size else set()
            for p in range(len(w) - size + 1) if size else ():
                if tuple(w[p : p + size]) in phrases:
                    hit.update(range(p, p + size))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(spark, docs, seed=7):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "e5", "é", "The"]
    text = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(f"i{k}", text(rng.randint(1, 30))) for k in range(12)] + [("empty", "..."), ("none", None), ("i3", "zz yy"), ("same", "q q q q")]
    rows = [(i, " ".join(rng.choice([text(20), rng.choice(items)[1] or "", "q q q q q"]) for _ in range(4))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "..."), (103, "zz"), (104, "ZZ yy"), (None, "zz yy"), rows[0], (0, "other zz yy")]
    return rows, docs(rows), items, spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "1 as doc_id")


def test_against_brute_force_whole_and_in_blocks(spark, docs):
    rows, df, items, benchmark = tables(spark, docs)
    want = brute(rows, items)
    for size, chars in ((1 << 20, 1 << 20), (60, 1 << 20), (1 << 20, 200), (60, 200)):
        got = sorted([tuple(r) for r in contamination(df, benchmark, block_bytes=size, shard_chars=chars).collect()], key=str)
        assert got == want


def test_drop_leaves_clean_rows_whole(spark, docs):
    rows, df, items, benchmark = tables(spark, docs)
    kept = drop_contaminated(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(r["n_chars"] for r in kept.collect()) == sorted(len(t or "") for i, t in rows if not brute([(i, t)], items)[0][5])


def test_no_documents_and_no_items(spark, docs):
    _, df, _, benchmark = tables(spark, docs)
    assert contamination(df.limit(0), benchmark).collect() == []
    assert not any(r["contaminated"] or r["n_hit"] for r in contamination(df, benchmark.limit(0)).collect())


def test_proximity_stays_in_the_document(spark, docs):
    df = docs([(1, "alpha x beta"), (2, "alpha"), (3, "beta alpha"), (4, "alpha x x x x beta")])
    benchmark = spark.createDataFrame([("i", "alpha beta")], "item_id string, text string")
    got = {r["doc_id"]: (r["items"], r["near_items"]) for r in benchmark_matches(df, benchmark, span=3).collect()}
    assert got == {1: ([], ["i"]), 2: ([], []), 3: ([], ["i"]), 4: ([], [])}


def test_postings_and_phrases():
    test = Phrases([("i", "a b"), ("j", "b a b")], window=3)
    index = PositionalIndex(["a b a b", "b a"], test.terms)
    assert index.postings(test.terms[b"a"]).tolist() == [0, 2, 6]
    assert index.phrase((test.terms[b"a"], test.terms[b"b"])).tolist() == [0, 2]
    assert index.doc_of(np.array([0, 3, 5, 6])).tolist() == [0, 0, 1, 1]


def test_packed_postings_come_back():
    for texts in (["a b a é", None, "", "b " * 1000], [None], []):
        shard = Postings.of(texts)
        back = Postings.unpacked(shard.n_words, shard.packed())
        assert back.terms == shard.terms and back.counts.tolist() == shard.counts.tolist() and back.positions.tolist() == shard.positions.tolist()


def test_one_index_serves_other_benchmarks_and_spans(spark, docs):
    index = positional_index(docs([(1, "alpha x beta gamma"), (2, "gamma delta")]))
    ask = lambda text, **options: {r["doc_id"]: (r["items"], r["near_items"]) for r in index_matches(index, spark.createDataFrame([("i", text)], "item_id string, text string"), **options).collect()}
    assert ask("gamma delta") == {1: ([], []), 2: (["i"], [])}
    assert ask("beta alpha", span=2) == {1: ([], ["i"]), 2: ([], [])}


def test_a_very_long_text(docs, spark):
    df = docs([(1, "w " * 300_000 + "needle in hay"), (2, "needle in hay")])
    benchmark = spark.createDataFrame([("i", "needle in hay")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in contamination(df, benchmark, shard_chars=1000).collect()}
    assert got == {1: (300_003, 3, False), 2: (3, 3, True)}
