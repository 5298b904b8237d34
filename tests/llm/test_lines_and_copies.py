import random
from collections import Counter

import pytest

from rillwork.llm import exact_dedup
from rillwork.llm.exact_dedup import CuckooIndex, drop_exact_copies, exact_groups
from rillwork.llm.line_dedup import dedup_lines

STRIP = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_lines(rows, least):
    keys = [[lower(x.strip(STRIP)) for x in (t or "").split("\n")] for _, t in rows]
    n = Counter(k for own in keys for k in set(own))
    out = []
    for (i, t), own in zip(rows, keys):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, own) if not (k and n[k] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(docs):
    rng = random.Random(5)
    pool = ["All rights reserved", " all RIGHTS reserved\t", "É", "é", "", "  ", "x ", "unique"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else str(rng.random()) for _ in range(rng.randint(1, 6)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (3, "All rights reserved"), (None, "all rights reserved\nmine"), rows[0]]
    for least in (2, 10):
        got = sorted([tuple(r) for r in dedup_lines(docs(rows), least).collect()], key=str)
        assert got == brute_lines(rows, least)


def test_no_lines(docs):
    assert dedup_lines(docs([])).collect() == []


def test_copies_against_brute_force(docs):
    rng = random.Random(6)
    rows = [(i, rng.choice(["Same", "sAME", "É", "é", "", None, f"own {i}"])) for i in rng.sample(range(500), 80)]
    by = {}
    for i, t in rows:
        by.setdefault(lower(t or ""), []).append(i)
    got = exact_groups(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        own = next(v for v in by.values() if r["doc_id"] in v)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(own), len(own), r["doc_id"] == max(own))
    df = docs(rows)
    kept = drop_exact_copies(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(max(v) for v in by.values())


def test_copies_that_repeat_ids(docs):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "B"), (None, "c"), (None, "C")]
    got = sorted([tuple(r)[:4] for r in exact_groups(docs(rows)).collect()], key=str)
    assert got == sorted([(1, 1, 2, True), (1, 1, 2, True), (1, 2, 2, False), (2, 2, 2, True), (None, None, 2, True), (None, None, 2, True)], key=str)
    assert sorted([(r["doc_id"], r["text"]) for r in drop_exact_copies(docs(rows)).collect() if r["doc_id"]]) == [(1, "a"), (2, "B")]
    assert exact_groups(docs([])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_cuckoo_index_inserts_deletes_and_grows(seed):
    rng = random.Random(seed)
    index, live = CuckooIndex(2), {}
    for step in range(4000):
        key = rng.randbytes(32) if not live or rng.random() < 0.6 else rng.choice(list(live))
        if key in live and rng.random() < 0.7:
            assert index.delete(key) == live.pop(key)
            assert key not in index and index.delete(key) is None
        elif key not in live:
            live[key] = [step, 1]
            index.insert(key, live[key])
    assert index.resizes > 0 and len(index) == len(live)
    assert all(k in index for k in live) and not any(rng.randbytes(32) in index for _ in range(1000))


def test_tags_that_collide_are_told_apart():
    index = CuckooIndex()
    a, b = b"\1" * 32, b"\1" * 31 + b"\2"  # the same tag and bucket
    index.insert(a, [1, 1])
    assert a in index and b not in index
    index.merge(b, 2, 1)
    index.merge(a, 3, 1)
    assert index.payload == {b: [2, 1], a: [3, 2]}


def test_a_full_index_retires_digests(docs):
    rows = [(i, f"text {i % 37}") for i in range(400)]
    got = exact_dedup._groups(docs(rows), max_live=3).collect()
    assert len(got) == 400
    for r in got:
        own = [i for i, _ in rows if i % 37 == r["doc_id"] % 37]
        assert (r["keep_id"], r["group_size"]) == (max(own), len(own))


def test_very_long_texts(docs):
    long = "\n".join(f"line {k % 5000}" for k in range(60_000))
    rows = [(1, long), (2, long.upper()), (3, "line 7\nother")] + [(k, "line 7") for k in range(10, 20)]
    got = sorted([tuple(r) for r in dedup_lines(docs(rows)).collect()], key=str)
    assert got == brute_lines(rows, 10)
    assert {(r["doc_id"], r["keep_id"]) for r in exact_groups(docs(rows)).collect() if r["doc_id"] < 3} == {(1, 2), (2, 2)}
