import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from rillwork.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    assert plain(df.select(*names).collect()) == plain(con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall())


def test_registered():
    assert "pipeline" in E.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in E.queries()) == 1


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def contaminated(text, items):
    own, hit = words(text), set()
    for item in items:
        size = min(13, len(item))
        for p in {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if size else ():
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) == p:
                    hit.update(range(k, k + size))
    return bool(hit) and 20 * len(hit) >= len(own)


def components(rows):
    """Least ids over links on five-word shingles, pair by pair."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    least = [i for i, _ in rows]
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_each_stage_judged_on_its_own_input(spark):
    """Every stage keeps a part of its input, all columns, by its operator's own decisions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in P.STAGES:
        out = P.materialize(stage(spark, docs, SF), f"test-{name}")
        assert out.columns[: len(columns)] == columns
        assert out.select(columns).distinct().join(docs, columns, "left_anti").count() == 0
        before, after = [(r["doc_id"], r["text"]) for r in docs.collect()], sorted(r["doc_id"] for r in out.collect())
        if name != "mixture":
            assert out.columns == columns
        if name == "language":  # what has a letter stays
            assert after == sorted(i for i, t in before if any(c.isalpha() for c in t or ""))
        if name == "exact_copies":
            last = {}
            for i, t in sorted(before):
                last[t.encode().lower()] = i
            assert after == sorted(last.values())
        if name == "near_copies":
            assert after == sorted(i for (i, _), c in zip(before, components(before)) if i == c)
        if name == "contaminated":
            assert after == sorted(i for i, t in before if not contaminated(t, items))
        if name == "mixture":
            taken = QUERIES["op8_mix_sources"].__globals__["production_mixture"](docs).collect()
            assert Counter(after) == Counter(r["doc_id"] for r in taken)
        docs = out
    assert P.run(spark, SF).count() == docs.count()


def test_stages_on_edge_rows(spark, docs):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text + " x"), (3, None), (4, ""), (5, "12 34"), (None, text + " y z a b c"), (None, None), (6, "long " * 60_000), (7, text)]
    df = docs(rows)
    want = {"language": {1, 2, 6, 7, None}, "exact_copies": {2, 4, 5, 6, 7, None}, "near_copies": {1, 3, 4, 5, 6, None}, "contaminated": {1, 2, 3, 4, 5, 6, 7, None}}
    for name, stage in P.STAGES:
        out = stage(spark, df, SF)
        assert out.columns[: len(df.columns)] == df.columns
        got = out.collect()
        assert name == "mixture" or {r["doc_id"] for r in got} == want[name], name
        if name in ("exact_copies", "near_copies"):
            assert sum(r["doc_id"] == 1 for r in got) <= 1
        if name == "contaminated":
            assert len(got) == len(rows)
        assert stage(spark, df.limit(0), SF).collect() == []


def test_mixture_of_repeated_rows_keeps_to_its_budget(spark, docs):
    df = docs([(1, "a b c")] * 10)
    production = QUERIES["op8_mix_sources"].__globals__["production_mixture"](df)
    assert dict(P.STAGES)["mixture"](spark, df, SF).count() == production.count() < 10


def test_run_leaves_only_its_result(spark):
    from rillwork.llm import common

    begin = common.mark()
    out = P.run(spark, SF)
    assert len(common._WRITTEN) == begin + 1 and out.count()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from rillwork.llm.common import shared_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master="spark://h:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(fake)
