"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct word shingles as 64-bit hashes. Documents
with equal sets form a class, which one of them represents, so copies are
never paired. Signatures need two permutations only: sigma places a shingle's
hash on a ring of ``RING`` positions, pi is a table of the ring's positions in
random order, and coordinate k is the least entry of pi, circularly shifted by
k, over the set. As the shifted reads of one shingle are a contiguous slice of
pi, a signature is the minimum over slices. The coordinates are cut into bands;
classes that agree on a band share a bucket.

Pairs come from buckets without ever pairing all members of a large group. Two bounds
on the similarity, both exact, keep hopeless pairs out. A class's private shingles are in no other
class that has a bucket, so they lie in no intersection; a class with too many links to nothing.
A parity map has a bit for each of ``PARITY`` bins of shingles, set where the class's count in the bin is
odd; bits that differ between two maps are at most the shingles that differ between the two sets.

First, in a few bands, every member is verified with its bucket's leader, one drawn among the members with the
least private share, which are those nearest to the group's centre, and the links' components are
computed. Then, in all bands, members are verified with up to ``LEADERS`` leaders of their bucket, where the two are
in different components, and components are joined. Last, each bucket that still spans several
components gets its remaining pairs across components: members outside its largest component with
members of others. Pairs that the bounds leave are verified on full sets, so no candidate
pair whose ends are in different components goes undecided, while a group of near copies costs its size
times a few bands.

At similarity 0.8, 40 bands of 6 rows miss a pair with probability
(1 - 0.8^6)^40 = 5e-6; below 0.8 candidates are refused by verification. Nodes,
the classes of equal sets, are named by a 128-bit hash of their sorted set.

Defined results: null and empty texts, and texts without words, have an empty
set, link to nothing and are their own component; a text with fewer words than
a shingle has its whole sequence as its one shingle; rows that repeat an id are
one document if their texts agree, and otherwise link as documents that share
that id; a null id is a component of its own; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import materialize, row_key, rows_of
from rillwork.llm.components import connected_components

RING = 1 << 20
BANDS, ROWS = 40, 6
FIRST_BANDS = 3
LEADERS = 3
PARITY = 1024
SEED = 0x5EED

_MEMO_WORDS = 400_000
_ODD1, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    """Memo of the words' 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * _ODD1
    h ^= h >> np.uint64(29)
    h *= _ODD2
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, size: int, memo: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words."""
    own = (text or "").encode().lower().split()  # splits at ASCII white space only, as bytes do
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, own), np.uint64, len(own))
    n = max(1, len(h) - size + 1)
    width = min(size, len(h))
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mixed(out + h[k : k + n])
    return np.unique(out)


class CirculantMinHash:
    """Signatures of ``coordinates`` minima from sigma and the shifted pi."""

    def __init__(self, coordinates: int, ring: int = RING, seed: int = SEED):
        pi = np.random.default_rng(seed).permutation(ring).astype(np.uint32)
        self.ring = np.uint64(ring)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate((pi, pi[:coordinates])), coordinates)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        at = (_mixed(shingles * _ODD2) % self.ring).astype(np.int64)  # sigma
        least = self.slices[at[:512]].min(axis=0)
        for lo in range(512, len(at), 512):
            np.minimum(least, self.slices[at[lo : lo + 512]].min(axis=0), out=least)
        return least


def _band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        h = _mixed(h * _ODD1 + parts[:, k])
    return h.view(np.int64)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """The parity map of a set, 64 bins to a long."""
    odd = np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether two struct columns ``(size, private, parity)`` allow the similarity; exact, as no pair that links is refused.

    Similar sets share at least percent / (100 + percent) of the sum of their sizes.
    """
    sizes = F.col(f"{x}.size") + F.col(f"{y}.size")
    shared = F.least(F.col(f"{x}.size") - F.col(f"{x}.private"), F.col(f"{y}.size") - F.col(f"{y}.private"))
    differ = F.lit(0)
    for k in range(PARITY // 64):
        differ = differ + F.bit_count(F.col(f"{x}.parity")[k].bitwiseXOR(F.col(f"{y}.parity")[k]))
    differ = F.greatest(differ.cast("long"), F.col(f"{x}.private") + F.col(f"{y}.private"))
    return ((100 + percent) * shared >= percent * sizes) & ((100 + percent) * differ <= (100 - percent) * sizes)


def _sets(size: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, minhash, seen = _WordHashes(), CirculantMinHash(bands * rows), set()
        for b in batches:
            n, nodes, banded, parities = [], [], [], []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                own = shingle_set(text, size, memo)
                digest = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
                n.append(len(own))
                nodes.append(digest)
                if digest is None or doc_id is None or digest in seen:  # a class is banded once a task
                    banded.append(None)
                    parities.append(None)
                else:
                    seen.add(digest)
                    banded.append(_band_hashes(minhash.signature(own), bands, rows))
                    parities.append(_parity(own))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["__th"], pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(banded, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))], ["doc_id", "__th", "n_shingles", "node", "bands", "parity"])

    return run


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(size: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last = _WordHashes(), OrderedDict()

        def full_set(rep: bytes, text: str) -> np.ndarray:
            if rep not in last:
                last[rep] = shingle_set(text, size, memo)
                if len(last) > 64:
                    last.popitem(last=False)
            return last[rep]

        for b in batches:
            a, c = b["a"].to_pylist(), b["b"].to_pylist()
            ok = [jaccard_at_least(full_set(x, s), full_set(y, t), percent) for x, y, s, t in zip(a, c, b["text_a"].to_pylist(), b["text_b"].to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _exploded(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``(serial, shingle)`` rows of ``(serial, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for b in batches:
            for serial, text in zip(b["serial"].to_pylist(), b["text"].to_pylist()):
                own = shingle_set(text, size, memo).view(np.int64)
                for lo in range(0, len(own), 100_000):
                    part = own[lo : lo + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), serial)), pa.array(part)], ["serial", "shingle"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar. texts: ``(node, text)`` of class representatives."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_verified(size, percent), "a binary, b binary")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _placed(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, component)`` after the links have joined components."""
    a, b = (placed.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    joined = links.join(a, "a").join(b, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    moved = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("__to"))
    return materialize(placed.join(moved, "component", "left").select("node", F.coalesce("__to", "component").alias("component")), "placed")


def _with_leaders(members: DataFrame, leaders: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of members ``(band, node, component, facts)`` with leaders of their band, where components differ and the bounds allow a link.

    A leader is drawn by hash among the band's members with the least private share.
    """
    share = F.floor(64 * F.col("facts.private") / F.col("facts.size"))
    draws = [F.min_by(F.struct("node", "component", "facts"), F.struct(share, F.xxhash64("node", "band", F.lit(k)), "node")).alias(f"l{k}") for k in range(leaders)]
    open_ = members.groupBy("band").agg(*draws, F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    led = open_.select("band", F.explode(F.array_distinct(F.array(*(f"l{k}" for k in range(leaders))))).alias("l"))
    led = led.select("band", F.col("l.node").alias("leader"), F.col("l.component").alias("cl"), F.col("l.facts").alias("lead"))
    pairs = members.join(led, "band").where((F.col("component") != F.col("cl")) & _may_link("facts", "lead", percent))
    return pairs.select(*_ordered("node", "leader")).distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, __th, n_shingles, component_id, kept)``, a row per input row.

    ``component_id`` is the smallest id reachable over links of at least
    ``percent`` per cent Jaccard similarity; ``__th`` is the text's hash.
    """
    rows_in = row_key(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "__th")
    sets = materialize(rows_in.mapInArrow(_sets(shingle_words, bands, rows), "doc_id long, __th long, n_shingles long, node binary, bands array<bigint>, parity array<bigint>"), "sets")
    linked = sets.where("node is not null and doc_id is not null")
    first = linked.groupBy("node").agg(F.min(F.struct("doc_id", "__th")).alias("f"))
    first = materialize(first.select("node", F.col("f.doc_id").alias("first_id"), F.col("f.__th").alias("first_th")), "first")

    members = linked.where("bands is not null").select("node", F.posexplode("bands").alias("k", "band"))
    shared = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("band")
    buckets = materialize(members.join(shared, "band", "left_semi").distinct(), "buckets")

    # Only the texts of nodes that share a bucket are kept beside the pairs.
    nodes = buckets.select("node").distinct()
    wanted = first.join(nodes, "node", "left_semi").select("node", "first_id", "first_th")
    reps = rows_in.join(wanted.hint("merge"), (F.col("doc_id") == F.col("first_id")) & (F.col("__th") == F.col("first_th")))
    texts = materialize(reps.select("node", "text").dropDuplicates(["node"]).withColumn("serial", F.monotonically_increasing_id()), "texts")

    # The facts that bound similarities; nodes with too many private shingles are out.
    exploded = texts.select("serial", "text").mapInArrow(_exploded(shingle_words), "serial long, shingle long")
    single = exploded.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("serial").alias("serial")).where("n = 1")
    private = single.groupBy("serial").agg(F.count(F.lit(1)).alias("private"))
    sized = linked.where("bands is not null").select("node", F.col("n_shingles").alias("size"), "parity").dropDuplicates(["node"])
    facts = texts.select("node", "serial").join(private, "serial", "left").join(sized, "node").withColumn("private", F.coalesce("private", F.lit(0)).cast("long"))
    facts = materialize(facts.where(100 * F.col("private") <= (100 - percent) * F.col("size")).select("node", F.struct("size", "private", "parity").alias("facts")), "facts")
    buckets = materialize(buckets.join(facts, "node"), "members")
    placed = facts.select("node", F.col("node").alias("component"))

    # 1. A few bands: every member with its bucket's leader.
    few = buckets.where(F.col("k") < FIRST_BANDS).withColumn("component", F.col("node"))
    asked = materialize(_with_leaders(few, 1, percent), "asked")
    placed = _placed(placed, _links(asked, texts, shingle_words, percent))

    # 2. All bands: members with leaders of their bucket.
    spread = buckets.select("band", "node", "facts").join(placed, "node")
    more = materialize(_with_leaders(spread, LEADERS, percent).join(asked, ["a", "b"], "left_anti"), "more")
    placed = _placed(placed, _links(more, texts, shingle_words, percent))

    # 3. Buckets that still span components: all their other pairs across components that the bounds allow.
    spread = materialize(buckets.select("band", "node", "facts").join(placed, "node"), "spread")
    shares = spread.groupBy("band", "component").agg(F.count(F.lit(1)).alias("m"))
    mixed = shares.groupBy("band").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("band", "main")
    inside = materialize(spread.join(mixed, "band"), "mixed")
    x, y = (inside.select("band", F.col("node").alias(c), F.col("component").alias(f"c{c}"), F.col("facts").alias(f"f{c}"), F.col("main").alias(f"m{c}")) for c in "xy")
    across = (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("my")) | (F.col("x") < F.col("y")))
    rest = x.where("cx <> mx").join(y, "band").where(across & _may_link("fx", "fy", percent)).select(*_ordered("x", "y")).distinct()
    rest = materialize(rest.join(asked.unionByName(more), ["a", "b"], "left_anti"), "rest")
    placed = _placed(placed, _links(rest, texts, shingle_words, percent))

    # Nodes without a link stay as they are; only the others carry a component further.
    moved = materialize(first.join(placed, "node").select("node", "first_id", "component"), "moved")
    least = materialize(moved.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("component", "component_id"), "least")
    found = first.select("node", "first_id").join(moved.join(least, "component").select("node", "component_id"), "node", "left")
    # As a table of its own, one row a class, so that the skew-join rule can deal out a hot class's rows.
    found = materialize(found.select("node", F.coalesce("component_id", "first_id").alias("component_id")), "found")
    out = sets.drop("bands", "parity").join(found, "node", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "__th", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one document of each component.

    Of rows that repeat its id and text one stays; of rows that repeat its id with other
    texts, one of each text; rows without an id all stay.
    """
    return rows_of(docs, near_duplicates(docs, **options).where("kept"), "left_semi", once=True)
