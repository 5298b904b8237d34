import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rillwork.llm import suffix_dedup as S


def brute(rows, length=50):
    """Per row: (n_bytes, n_removed, n_spans, kept)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1) if i is not None else ():
            s = b[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1) if i is not None else ():
            if first[b[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(df, **options):
    got = S.remove_repeats(df, **options).collect()
    for r in got:
        spans = np.frombuffer(r["spans"], "<i8").reshape(-1, 2)
        assert len(spans) == r["n_spans"] and int((spans[:, 1] - spans[:, 0]).sum()) == r["n_removed"]
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got], key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    passage = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 160))) for _ in range(6)]
    own = lambda: "".join(rng.choice("xyzwü ") for _ in range(rng.randint(0, 80)))
    return [(i, "".join(rng.choice([rng.choice(passage), own()]) for _ in range(rng.randint(0, 6)))) for i in rng.sample(range(10 * n), n)]


def test_against_brute_force(docs):
    rows = texts(1) + [(9001, None), (9002, ""), (9003, "a" * 49), (9004, "a" * 300), (9005, "a" * 120), (9006, "ab" * 100)]
    for options in ({}, {"block_bytes": 500}, {"block_bytes": 500, "hot_blocks": 2}, {"gram": 30, "block_bytes": 900}, {"block_bytes": 500, "bucket_bytes": 50}):
        assert run(docs(rows), **options) == brute(rows)


def test_ids_that_repeat_or_are_null(docs):
    t = "the quick brown fox jumps over the lazy dog and runs far away"
    rows = [(1, t), (1, t), (None, t), (2, t), (2, "x" + t), (None, t * 2)]
    assert run(docs(rows), block_bytes=100) == brute(rows)


def test_empty_table(docs):
    assert run(docs([])) == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=60), min_size=1, max_size=12), st.integers(1, 12))
def test_merge_sort_orders_suffixes(parts, limit):
    data = np.frombuffer(b"".join(parts) + b"\0" * limit, np.uint8)
    start = np.arange(len(data) - limit)
    group = np.sort(start % 3)
    start = np.concatenate([start[start % 3 == k] for k in range(3)])
    order = S.suffix_merge_sort(S.HashedText(data), start, group, limit)
    raw = data.tobytes()
    key = [(int(group[j]), raw[start[j] : start[j] + limit]) for j in order]
    assert key == sorted(key) and sorted(order.tolist()) == list(range(len(start)))


def test_common_extension():
    text = S.HashedText(np.frombuffer(b"abcabdabcabx", np.uint8))
    assert text.common(np.array([0, 0, 0]), np.array([3, 6, 1]), 5).tolist() == [2, 5, 0]


def test_an_anchor_of_many_blocks_and_few_contexts_is_not_hot(docs):
    """Only what a bucket would gather makes an anchor hot; either way the result is the same."""
    anchors = np.array([5 << 20, 7 << 20], np.uint64)
    six = np.ascontiguousarray(anchors.view(np.uint8).reshape(-1, 8)[:, 2:])

    def hot(contexts):
        blob = S._pack(six, np.packbits([False, False]), np.array(contexts, "<u2"))
        batch = S._rows([(0, block, S._HASHES, blob) for block in range(4)], S._MESSAGE)
        (answer,) = S._answered_hashes(4, 100)(iter([batch]))
        return [np.unpackbits(S._unpack(x, np.uint8, np.uint8)[1], count=2).tolist() for x in answer["blob"].to_pylist()]

    assert hot([1, 25]) == [[0, 1]] * 4 and hot([24, 1]) == [[0, 0]] * 4
    rows = texts(1) + [(9004, "a" * 300), (9006, "ab" * 100)]
    for most in (1, 20):
        assert run(docs(rows), block_bytes=500, hot_blocks=2, hot_contexts=most) == brute(rows)
