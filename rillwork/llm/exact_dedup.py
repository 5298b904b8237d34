"""Exact deduplication through a cuckoo-filter index.

Two texts are equal when they are identical after lower-casing A-Z. Every row
is digested (SHA-256 of the normalised UTF-8 bytes). The digests pass through
cuckoo-filter indexes twice: each map task first merges its own copies, so that
a digest leaves a task once however many copies it had, then the partial
groups are dealt out by digest and merged by one index per shuffle partition.
A filter miss proves that a digest is new; a hit is verified against the full
digests kept beside the buckets.

An index holds at most ``MAX_LIVE`` digests. In a map task a full index hands its groups on
and deletes their digests, which may then come again as another partial group. A shuffle partition
comes sorted by digest (Spark sorts it and may spill), so there a full index deletes all
digests that lie behind, which can't come again.

Defined results: null text counts as empty, empty texts form one group, rows
whose ``doc_id`` repeats all count in ``group_size``, a null ``doc_id`` sorts
below all others, an empty table gives an empty result, and further columns of
the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import row_key, rows_of

SLOTS = 4
MAX_KICKS = 200
MAX_LIVE = 200_000


class CuckooIndex:
    """Cuckoo filter over live digests, with the digests kept for verification.

    A digest's 16-bit tag lies in one of two buckets of four slots. ``keys``
    holds, slot by slot, the whole digest, so a tag hit is always verified and
    the filter can be rebuilt at twice the size from stored keys when an
    insertion overflows. ``payload`` carries what belongs to a live digest.
    """

    def __init__(self, buckets: int = 64):
        self.payload: dict[bytes, list] = {}
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.n = buckets
        self.tags = [[0] * SLOTS for _ in range(buckets)]
        self.keys: list[list[bytes | None]] = [[None] * SLOTS for _ in range(buckets)]

    def _tag(self, digest: bytes) -> int:
        return (digest[0] << 8 | digest[1]) or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[2:10], "little") & (self.n - 1)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ ((tag * 0x5BD1E995) & (self.n - 1))

    def _find(self, digest: bytes) -> tuple[int, int] | None:
        tag, first = self._tag(digest), self._home(digest)
        for bucket in (first, self._other(first, tag)):
            tags = self.tags[bucket]
            for slot in range(SLOTS):
                if tags[slot] == tag and self.keys[bucket][slot] == digest:
                    return bucket, slot
        return None

    def __contains__(self, digest: bytes) -> bool:
        return self._find(digest) is not None

    def __len__(self) -> int:
        return len(self.payload)

    def _place(self, digest: bytes) -> bytes | None:
        """Put a digest in; returns the digest left without a slot, if any."""
        tag = self._tag(digest)
        bucket = self._home(digest)
        for b in (bucket, self._other(bucket, tag)):
            if 0 in self.tags[b]:
                slot = self.tags[b].index(0)
                self.tags[b][slot], self.keys[b][slot] = tag, digest
                return None
        for kick in range(MAX_KICKS):
            slot = (tag + kick) % SLOTS
            tag, self.tags[bucket][slot] = self.tags[bucket][slot], tag
            digest, self.keys[bucket][slot] = self.keys[bucket][slot], digest
            bucket = self._other(bucket, tag)
            if 0 in self.tags[bucket]:
                slot = self.tags[bucket].index(0)
                self.tags[bucket][slot], self.keys[bucket][slot] = tag, digest
                return None
        return digest

    def _resize(self) -> None:
        self.resizes += 1
        stored, size = list(self.payload), self.n
        while True:
            size *= 2
            self._clear(size)
            if all(self._place(k) is None for k in stored):
                return

    def insert(self, digest: bytes, payload: list) -> None:
        self.payload[digest] = payload
        if self._place(digest) is not None:
            self._resize()

    def delete(self, digest: bytes) -> list | None:
        at = self._find(digest)
        if at is None:
            return None
        self.tags[at[0]][at[1]], self.keys[at[0]][at[1]] = 0, None
        return self.payload.pop(digest)

    def merge(self, digest: bytes, doc_id: int | None, count: int) -> None:
        """One more row, or group of rows, with this digest: the largest id stays live."""
        if self._find(digest) is None:
            self.insert(digest, [doc_id, count])
            return
        live = self.payload[digest]
        live[1] += count
        if doc_id is not None and (live[0] is None or doc_id > live[0]):
            live[0] = doc_id

    def retire(self, digests: list[bytes]) -> pa.RecordBatch:
        """Delete live digests; their groups as a batch."""
        gone = [self.delete(d) for d in digests]
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([g[0] for g in gone], pa.int64()), pa.array([g[1] for g in gone], pa.int64())], ["digest", "keep_id", "group_size"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [hashlib.sha256((t or "").encode().lower()).digest() for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["__th"], pa.array(out, pa.binary())], ["doc_id", "__th", "digest"])


def _merged(max_live: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for b in batches:
            for digest, doc_id, n in zip(b["digest"].to_pylist(), b["keep_id"].to_pylist(), b["group_size"].to_pylist()):
                if len(index) >= max_live and digest not in index:
                    yield from (index.retire(part) for part in _cut(list(index.payload)))
                index.merge(digest, doc_id, n)
        yield from (index.retire(part) for part in _cut(list(index.payload)))

    return run


def _cut(digests: list[bytes], size: int = 20_000) -> list[list[bytes]]:
    return [digests[at : at + size] for at in range(0, len(digests), size)]


def _groups(docs: DataFrame, max_live: int = MAX_LIVE) -> DataFrame:
    rows = row_key(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "__th")
    rows = rows.mapInArrow(_digests, "doc_id long, __th long, digest binary")
    schema = "digest binary, keep_id long, group_size long"
    partial = rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")).mapInArrow(_merged(max_live), schema)
    groups = partial.repartition("digest").sortWithinPartitions("digest").mapInArrow(_merged(max_live), schema)
    # A group is one row here, so the skew-join rule can deal a hot digest's rows over many tasks.
    return rows.join(groups, "digest")


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row per input row.

    Rows that repeat both the id and the text are one document: if one is kept, all are.
    """
    return _groups(docs).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts those with the largest id.

    Of rows that repeat id and text, one stays. Where equal texts have no id but null, they all stay, as nothing tells them apart.
    """
    return rows_of(docs, _groups(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))), "left_semi", once=True)
