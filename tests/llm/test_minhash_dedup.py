import random

import numpy as np

from rillwork.llm import minhash_dedup as M
from rillwork.llm.components import connected_components


def brute(rows, size, percent=80):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))}


def near_copies(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 120))] for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    return rows


def test_against_brute_force(docs):
    rows = near_copies(3) + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "é è"), (2007, "É è")]
    for size in (2, 5):
        want = brute(rows, size)
        got = M.near_duplicates(docs(rows), shingle_words=size).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_a_chain_is_one_component_without_a_common_leader(docs):
    words = [f"w{k}" for k in range(160)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 60])) for k in range(20)]  # neighbours share most, ends nothing
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs(rows), shingle_words=2).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 2).items()} and set(got.values()) == {0}


def test_repeated_rows_null_ids_and_empty_table(docs):
    t = "a b c d e f g h"
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in M.near_duplicates(docs([(5, t), (5, t), (None, t), (7, t), (None, None)])).collect()]
    assert sorted(got, key=str) == sorted([(5, 5, True), (5, 5, True), (None, None, True), (7, 5, False), (None, None, True)], key=str)
    assert M.near_duplicates(docs([])).collect() == []


def test_drop_keeps_one_of_each_group_and_all_columns(docs):
    df = docs(near_copies(4))
    kept = M.drop_near_copies(df, shingle_words=5)
    assert kept.columns == df.columns
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()], 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_signatures_estimate_similarity():
    m = M.CirculantMinHash(512)
    a, b = np.arange(1, 2001, dtype=np.uint64), np.arange(401, 2401, dtype=np.uint64)
    share = (m.signature(M._mixed(a)) == m.signature(M._mixed(b))).mean()
    assert abs(share - 1600 / 2400) < 0.1


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = {r[0]: r[1] for r in connected_components(links).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 90, 90: 90, 95: 90}
    assert connected_components(links.limit(0)).count() == 0
