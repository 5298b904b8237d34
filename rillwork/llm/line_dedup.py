"""Line deduplication.

Lines are exploded, normalised (ASCII white space stripped at both ends, A-Z
lower-cased) and hashed to 128 bits; the documents of each hash are counted
with map-side partial sums; hashes at or over the threshold are joined back to
the (document, hash) rows, the most frequent ones by broadcast, so that no task gets
all rows of a hot line, and collected per document; each document is then reassembled by position without the lines of those hashes.

Defined results: null or empty text is one empty line, an empty key (a line of
white space) is never dropped, a line that repeats inside one document counts
that document once, rows that repeat an id count as documents of their own, a
null ``doc_id`` is a value like any other, an empty table gives an empty
result, and further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import materialize, row_key

STRIP = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MAX_HOT = 4096


def _key(line: bytes) -> bytes | None:
    line = line.strip(STRIP)
    return xxhash.xxh3_128_digest(line.lower()) if line else None


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at: list[int] = []
        keys: list[bytes] = []
        for i, text in enumerate(b["text"].to_pylist()):
            own = {_key(x) for x in (text or "").encode().split(b"\n")}
            own.discard(None)
            keys += own
            at += [i] * len(own)
        rows = pa.array(at, pa.int32())
        for lo in range(0, len(keys), 100_000):
            part = rows.slice(lo, 100_000)
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(part), b["__th"].take(part), pa.array(keys[lo : lo + 100_000], pa.binary())], ["doc_id", "__th", "key"])


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, dropped in zip(b["text"].to_pylist(), b["dropped"].to_pylist()):
            lines = (text or "").encode().split(b"\n")
            n_lines.append(len(lines))
            if dropped:
                gone = set(dropped)
                stay = [x for x in lines if _key(x) not in gone]
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode())
            else:
                n_dropped.append(0)
                kept.append(text or "")
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)``, a row per input row; ``text`` holds the lines that stay."""
    rows = row_key(docs)
    lines = rows.mapInArrow(_exploded, "doc_id long, __th long, key binary")
    frequent = materialize(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs), "frequent")
    # Keys with 1 / MAX_HOT of all frequent lines or more are MAX_HOT at most: they travel to the lines.
    total = frequent.agg(F.sum("n")).first()[0] or 0
    hot, cold = (frequent.where(c).select("key") for c in (F.col("n") * MAX_HOT >= total, F.col("n") * MAX_HOT < total))
    found = lines.join(F.broadcast(hot), "key", "left_semi").unionByName(lines.join(F.broadcast(hot), "key", "left_anti").join(cold, "key", "left_semi"))
    dropped = found.groupBy(F.col("doc_id").alias("__id"), F.col("__th").alias("__h")).agg(F.collect_set("key").alias("dropped"))
    on = rows["doc_id"].eqNullSafe(dropped["__id"]) & (rows["__th"] == dropped["__h"])
    joined = rows.join(dropped.hint("shuffle_hash"), on, "left").select("doc_id", "text", "dropped")
    return joined.mapInArrow(_reassembled, "doc_id long, n_lines long, n_dropped long, text string")
