"""Benchmark decontamination over a stored positional inverted index.

Training documents are indexed shard by shard: a shard is about ``SHARD_CHARS``
of whole texts of one scan task. Its words become term numbers, each term gets its positional
posting list, and the shard's vocabulary and posting lists are a row of a table
in the shared folder. The index is kept by document, as search engines shard
theirs, so no posting is shuffled and no term's list gathers in one task. It holds all terms, so it serves any
benchmark, window or span: texts are read and cut into words once.

A test phrase is looked up from its rarest term in the shard: that term's
posting list, adjusted by the term's offset, is intersected with the
offset-adjusted lists of the other terms, rarest first, until only starts of
exact occurrences are left. Proximity matches intersect the lists within a span
instead.

The benchmark travels to the shards in blocks of at most ``BLOCK_BYTES`` of
text. One block is the usual case and needs no shuffle at all; further blocks
each make a pass over the index and their hits are united by document.

Defined results: null text has no words and is never contaminated; an item
without words never occurs; items that share an id are one item in the lists;
an item without an id is not listed or counted, but its words are hit; rows that repeat an id are judged on their own;
an empty benchmark leaves every document clean; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import materialize, row_key, rows_of

WINDOW = 13
MIN_SHARE = 20  # contaminated: MIN_SHARE * n_hit >= n_words
BLOCK_BYTES = 8 << 20
SHARD_CHARS = 4 << 20

#: Bytes of words as they are after lower-casing A-Z; all others part words.
_WORD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD).split()


class Phrases:
    """The test side: terms numbered from 1, and each item's windows as rows of term numbers."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.terms: dict[bytes, int] = {}
        self.phrases: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            own = [self.terms.setdefault(w, len(self.terms) + 1) for w in words(text)]
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                names = self.phrases.setdefault(tuple(own[at : at + size]), set())
                if item is not None:
                    names.add(item)
        self.flat = np.fromiter((t for p in self.phrases for t in p), np.int64)
        self.first = np.cumsum([0, *map(len, self.phrases)])[:-1]
        self.windows = list(self.phrases.items())

    def possible(self, df: np.ndarray) -> list[tuple[tuple[int, ...], set[str]]]:
        """The phrases all of whose terms occur, with their items. df: occurrences by term."""
        if not self.windows:
            return []
        return [self.windows[k] for k in np.flatnonzero(np.logical_and.reduceat(df[self.flat] > 0, self.first))]


class Postings:
    """The positional posting lists of all terms of one shard of documents.

    n_words: of each document; terms, counts: the vocabulary and each term's
    occurrences; positions: the posting lists, end to end in the vocabulary's order.
    """

    def __init__(self, n_words: np.ndarray, terms: list[bytes], counts: np.ndarray, positions: np.ndarray):
        self.n_words, self.terms, self.counts, self.positions = n_words, terms, counts, positions

    @classmethod
    def of(cls, texts: list[str | None]) -> Postings:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        runs = []
        for text in texts:
            own = words(text)
            runs.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
        n_words = np.array([len(r) for r in runs], np.int64)
        term = np.concatenate([np.zeros(0, np.int32), *runs])
        # A gap between documents keeps any phrase from crossing from one to the next.
        at = np.arange(len(term)) + np.repeat(np.arange(len(n_words)), n_words)
        return cls(n_words, list(number), np.bincount(term, minlength=len(number)), at[np.argsort(term, kind="stable")])

    def packed(self) -> bytes:
        terms = b" ".join(self.terms)
        head = np.array([len(self.terms), len(terms)], "<i8").tobytes()
        steps = np.diff(self.positions, prepend=0).astype("<i4")
        return zstandard.compress(head + terms + self.counts.astype("<i4").tobytes() + steps.tobytes(), 1)

    @classmethod
    def unpacked(cls, n_words: np.ndarray, blob: bytes) -> Postings:
        raw = zstandard.decompress(blob)
        n, size = (int(x) for x in np.frombuffer(raw, "<i8", 2))
        counts = np.frombuffer(raw, "<i4", n, 16 + size).astype(np.int64)
        steps = np.frombuffer(raw, "<i4", offset=16 + size + 4 * n)
        return cls(n_words, raw[16 : 16 + size].split(), counts, np.cumsum(steps, dtype=np.int64))


class PositionalIndex:
    """A shard's posting lists by the numbers that the test side gave to terms."""

    def __init__(self, shard: Postings | list[str | None], terms: dict[bytes, int]):
        shard = shard if isinstance(shard, Postings) else Postings.of(shard)
        self.n_words, self.positions = shard.n_words, shard.positions
        self.starts = np.cumsum(self.n_words + 1) - self.n_words - 1
        self.length = int(self.n_words.sum() + len(self.n_words))
        number = np.fromiter((terms.get(w, 0) for w in shard.terms), np.int64, len(shard.terms))
        asked, ends = np.flatnonzero(number), np.cumsum(shard.counts)
        self.low, self.counts = np.zeros(len(terms) + 1, np.int64), np.zeros(len(terms) + 1, np.int64)
        self.low[number[asked]] = (ends - shard.counts)[asked]
        self.counts[number[asked]] = shard.counts[asked]

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.low[term] : self.low[term] + self.counts[term]]

    def df(self, term: int) -> int:
        return int(self.counts[term])

    def phrase(self, terms: tuple[int, ...]) -> np.ndarray:
        """Starts of the exact occurrences."""
        order = sorted(range(len(terms)), key=lambda k: self.df(terms[k]))
        found = self.postings(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            there = self.postings(terms[k])
            at = np.searchsorted(there, found + k)
            at[at == len(there)] = 0
            found = found[there[at] == found + k] if len(there) else found[:0]
        return found

    def near(self, terms: tuple[int, ...], span: int) -> np.ndarray:
        """Positions of the rarest term that have every other term within ``span`` words either side, in one document."""
        order = sorted(set(terms), key=self.df)
        found = self.postings(order[0])
        for term in order[1:]:
            there = self.postings(term)
            if not len(found) or not len(there):
                return found[:0]
            doc = np.searchsorted(self.starts, found, "right") - 1
            low = np.maximum(found - span, self.starts[doc])
            high = np.minimum(found + span, np.append(self.starts, self.length)[doc + 1] - 1)
            found = found[np.searchsorted(there, high, "right") > np.searchsorted(there, low)]
        return found

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def _indexed(shard_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flushed() -> pa.RecordBatch:
            ids, hashes, texts = zip(*held)
            shard = Postings.of(list(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *(pa.array([x], pa.list_(pa.int64())) for x in (ids, hashes, shard.n_words)), pa.array([shard.packed()], pa.binary())],
                ["shard", "ids", "hashes", "n_words", "postings"],
            )

        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("doc_id", "__th", "text"))):
                held.append(row)
                size += len(row[2] or "")
                if size >= shard_chars:
                    yield flushed()
                    number, held, size = number + 1, [], 0
        if held:
            yield flushed()

    return run


def positional_index(docs: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The stored index: a row per shard with its documents' ids, text hashes and word counts, and the posting lists of all terms."""
    rows = row_key(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return materialize(rows.mapInArrow(_indexed(shard_chars), "shard long, ids array<bigint>, hashes array<bigint>, n_words array<bigint>, postings binary"), "postings")


_MATCHES = [
    ("shard", pa.int64()),
    ("row", pa.int64()),
    ("doc_id", pa.int64()),
    ("__th", pa.int64()),
    ("n_words", pa.int64()),
    ("hits", pa.binary()),
    ("items", pa.list_(pa.string())),
    ("near_items", pa.list_(pa.string())),
]
_MATCHES_DDL = "shard long, row long, doc_id long, __th long, n_words long, hits binary, items array<string>, near_items array<string>"


def _matcher(phrases, span: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """phrases: a broadcast of Phrases."""

    def matched(test: Phrases, number: int, ids: pa.Array, hashes: pa.Array, index: PositionalIndex) -> pa.RecordBatch:
        edge = np.zeros(index.length + 2, np.int32)
        items: list[set[str]] = [set() for _ in index.n_words]
        near: list[set[str]] = [set() for _ in index.n_words]
        for terms, names in test.possible(index.counts):
            found = index.phrase(terms)
            if len(found):
                np.add.at(edge, found, 1)
                np.add.at(edge, found + len(terms), -1)
                for d in np.unique(index.doc_of(found)):
                    items[d] |= names
            if span is not None:
                for d in np.unique(index.doc_of(index.near(terms, span))):
                    near[d] |= names
        covered = np.cumsum(edge[:-1]) > 0
        spans = [np.flatnonzero(covered[s : s + n]).astype("<i4").tobytes() for s, n in zip(index.starts, index.n_words)]
        n = len(ids)
        columns = [np.full(n, number), np.arange(n), ids, hashes, index.n_words, spans, [sorted(x) for x in items], [sorted(x) for x in near]]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _MATCHES)], [name for name, _ in _MATCHES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test: Phrases = phrases.value
        for b in batches:
            for i in range(len(b)):
                n_words = b["n_words"][i].values.to_numpy(zero_copy_only=False)
                shard = Postings.unpacked(n_words, b["postings"][i].as_py())
                yield matched(test, b["shard"][i].as_py(), b["ids"][i].values, b["hashes"][i].values, PositionalIndex(shard, test.terms))

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hits = [np.unique(np.concatenate([np.frombuffer(h, "<i4") for h in x])).astype("<i4").tobytes() for x in b["hits"].to_pylist()]
        lists = [pa.array([sorted({i for part in x for i in part}) for x in b[c].to_pylist()], pa.list_(pa.string())) for c in ("items", "near_items")]
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["__th"], b["n_words"], pa.array(hits, pa.binary()), *lists], ["doc_id", "__th", "n_words", "hits", "items", "near_items"])


def index_matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, span: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``benchmark_matches`` over an index that is there already."""
    spark = index.sparkSession
    test = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = test.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    parts, wanted = [], ["doc_id", "__th", "n_words", "hits", "items", "near_items"]
    for k in range(blocks):  # each block has a bounded size: hashing deals the items out evenly
        mine = test if blocks == 1 else test.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in mine.collect()], window))
        parts.append(index.mapInArrow(_matcher(phrases, span), _MATCHES_DDL))
    if blocks == 1:
        return parts[0].select(*wanted)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # A group has one row a block.
    same, lists = (F.first(c).alias(c) for c in wanted[:3]), (F.collect_list(c).alias(c) for c in wanted[3:])
    grouped = every.groupBy("shard", "row").agg(*same, *lists).select(*wanted)
    return grouped.mapInArrow(_united, "doc_id long, __th long, n_words long, hits binary, items array<string>, near_items array<string>")


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, span: int | None = None, block_bytes: int = BLOCK_BYTES, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``(doc_id, __th, n_words, hits, items, near_items)``, a row per input row; ``__th`` is the text's hash.

    ``hits``: little-endian int32 positions of the words inside an occurrence.
    ``items``: sorted ids of the items with an occurring window of ``window``
    words. ``near_items``: with ``span`` set, those whose window has all its
    terms within so many words of its rarest term.
    """
    return index_matches(positional_index(docs, shard_chars), benchmark, window, span, block_bytes)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: int = MIN_SHARE, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, contaminated)``, a row per input row."""
    n_hit = (F.octet_length("hits") / 4).cast("long")
    return benchmark_matches(docs, benchmark, window, **options).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        ((n_hit > 0) & (min_share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_share: int = MIN_SHARE, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    n_hit = F.octet_length("hits") / 4
    spoilt = benchmark_matches(docs, benchmark, **options).where((n_hit > 0) & (min_share * n_hit >= F.col("n_words")))
    return rows_of(docs, spoilt, "left_anti")
