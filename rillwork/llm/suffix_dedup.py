"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte of a document is removed when it is covered by a string of ``length``
bytes that also starts in a document with a smaller ``doc_id``. Strings
are judged on the input, and matches never cross documents.

Suffixes are sorted by mergesort. Two of them are compared through prefix
polynomial hashes: the hash of any substring comes from two prefix hashes, so
binary search finds the common extension in a logarithmic number of steps, and
the byte after it decides. Neighbours in the sorted order that agree on
``length`` bytes are verified byte by byte.

To sort only suffixes that can repeat, and to spread them over tasks:

1. Documents are packed into blocks of a few MB and written to the shared folder.
2. Of the ``GRAM``-byte strings inside each window of ``length`` bytes, the one with the
   least hash is the window's anchor. It depends on the window's content
   only, so equal windows have equal anchors. Blocks send each distinct anchor
   hash once; the answer, a bit for each, says whether it occurs in several documents.
3. For anchors that do, a block sends the bytes of their windows (the context),
   once for each distinct context, from its smallest document; copies
   inside the block are settled there. A context goes to the bucket of its
   anchor's hash, where all windows equal to its own arrive too.
   Anchors found in ``hot_blocks`` blocks or more, and with ``hot_contexts`` contexts or more (distinct
   ones of each block), send each window by itself, to the bucket of the window's own hash, so that
   no bucket gathers a hot anchor. Many blocks alone don't make one: what counts is what a bucket would hold.
4. A bucket settles equal contexts at once and suffix-sorts the windows of anchors
   that have several contexts, but for windows whose hash is the only one of its kind. Its answer is a bit for each window.
5. Each block removes what is covered.

A block sends a repeated context once, however many copies it holds, so that no
task receives more than one row a block for any string. There is a bucket for every
``bucket_bytes`` of blocks (and four a shuffle partition at least), so buckets
keep their size as the table grows, and a task holds one of them at a time.

Defined results: null text is empty; texts shorter than ``length`` keep all
bytes; rows that repeat an id never remove each other's bytes; a null id is
compared with nothing, so its row stays whole and removes nothing; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import materialize, shuffle_width

LENGTH = 50
GRAM = 18
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
HOT_BLOCKS = 1024
HOT_CONTEXTS = 1 << 16
_CHUNK = 1 << 20
_SORT_WINDOWS = 400_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(29))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(29)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p)


class HashedText:
    """Bytes with prefix polynomial hashes modulo 2^64."""

    _pow = _powers(_BASE, 1 << 12)
    _inv = _powers(_BASE_INV, 1 << 12)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n >= len(HashedText._pow):
            HashedText._pow, HashedText._inv = _powers(_BASE, 2 * n + 2), _powers(_BASE_INV, 2 * n + 2)
        self.data = data
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * self._pow[:n], out=self.prefix[1:])

    def hash(self, start: np.ndarray, size) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self._inv[start]

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all substrings of ``size`` bytes."""
        return (self.prefix[size:] - self.prefix[:-size]) * self._inv[: max(0, len(self.data) - size + 1)]

    def common(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Lengths, up to ``limit``, on which the suffixes at a and b agree."""
        out = np.full(len(a), limit, np.int64)
        rest = np.flatnonzero(self.hash(a, limit) != self.hash(b, limit))
        if len(rest):
            x, y = a[rest], b[rest]
            low, high = np.zeros(len(rest), np.int64), np.full(len(rest), limit - 1, np.int64)
            while (low < high).any():
                mid = (low + high + 1) >> 1
                same = self.hash(x, mid) == self.hash(y, mid)
                low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
            out[rest] = low
        return out

    def compare(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Negative, zero or positive as the suffixes at a and b compare on ``limit`` bytes."""
        k = self.common(a, b, limit)
        at = np.minimum(k, limit - 1)
        return np.where(k == limit, 0, self.data[a + at].astype(np.int16) - self.data[b + at])


def suffix_merge_sort(text: HashedText, start: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Order of the suffixes at ``start`` inside each run of equal ``group`` values, by bottom-up mergesort.

    All merges of a level are done together: an element's place is its own
    rank plus its rank in the sibling run, found by binary search.
    """
    n = len(start)
    order = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if n else order
    size = np.diff(np.append(first, n))
    begin, end = np.repeat(first, size), np.repeat(first + size, size)
    width = 1
    while n and width < size.max():
        j = np.arange(n)
        base = begin + (j - begin) // (2 * width) * (2 * width)
        mid, stop = np.minimum(base + width, end), np.minimum(base + 2 * width, end)
        j = j[mid < stop]
        base, mid, stop = base[j], mid[j], stop[j]
        left = j < mid
        low, high = np.where(left, mid, base), np.where(left, stop, mid)
        origin, own = low.copy(), start[order[j]]
        while len(live := np.flatnonzero(low < high)):
            probe = (low[live] + high[live]) >> 1
            c = text.compare(start[order[probe]], own[live], limit)
            after = np.where(left[live], c < 0, c <= 0)
            low[live] = np.where(after, probe + 1, low[live])
            high[live] = np.where(after, high[live], probe)
        merged = order.copy()
        merged[base + (j - np.where(left, base, mid)) + (low - origin)] = order[j]
        order, width = merged, 2 * width
    return order


def _rows_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are the same."""
    out = np.ones(len(a), bool)
    for lo in range(0, len(a), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        s = size[part]
        k = np.arange(s.max() if len(s) else 0)
        inside = k < s[:, None]
        x, y = (data[np.minimum(p[part][:, None] + k, len(data) - 1)] for p in (a, b))
        out[part] = ((x == y) | ~inside).all(axis=1)
    return out


def _classes(text: HashedText, start: np.ndarray, size: np.ndarray, also: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each substring, the index of an equal one from the smallest document; ``also`` must agree too."""
    h = _mixed(text.hash(start, size) + _mixed(also.astype(np.uint64) * _U(256) + size.astype(np.uint64)))
    order = np.lexsort((doc, h))
    new = np.concatenate(([True], h[order][1:] != h[order][:-1])) if len(order) else np.zeros(0, bool)
    rep = np.empty(len(h), np.int64)
    rep[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    wrong = ~_rows_equal(text.data, start, start[rep], size)
    rep[wrong] = np.flatnonzero(wrong)  # a hash collision: it stands for itself
    return rep


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(hash, at, low, high)``: anchors and the first and last start of the windows that have them.

    data: documents end to end; ends: where they end. An anchor may come in parts.
    """
    n, out = len(data), []
    last = np.repeat(ends, np.diff(ends, prepend=0)) - length  # the last start of a window, for each byte
    for s in range(0, n, _CHUNK):
        part = HashedText(data[s : min(n, s + _CHUNK + length - 1)])
        if len(part.data) < length:
            break
        h = _mixed(part.grams(gram))
        key = (h >> _U(22) << _U(22)) | np.arange(len(h), dtype=np.uint64)
        least, width, want = key, 1, length - gram + 1
        while 2 * width <= want:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < want:
            least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
        start = np.flatnonzero(np.arange(s, s + len(least)) <= last[s : s + len(least)])
        at = (least[start] & _U((1 << 22) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
        if len(new):
            stop = np.append(new[1:], len(at)) - 1
            out.append((h[at[new]], at[new] + s, start[new] + s, start[stop] + s))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


class _Block:
    """A block's documents, its anchors, and their distinct hashes in bucket order."""

    def __init__(self, ids: list, sizes: list[int], packed: bytes, length: int, gram: int, buckets: int):
        self.ids = ids
        self.data = np.frombuffer(zstandard.decompress(packed), np.uint8)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.starts = self.ends - sizes
        self.hash, self.at, self.low, self.high = anchors(self.data, self.ends, length, gram)
        row = np.searchsorted(self.ends, self.at, "right")
        named = np.array([x is not None for x in ids], bool)[row] if len(ids) else np.zeros(0, bool)
        self.hash, self.at, self.low, self.high, row = (x[named] for x in (self.hash, self.at, self.low, self.high, row))
        self.doc = np.array([x or 0 for x in ids], np.int64)[row]
        bucket = bucket_of(self.hash, buckets)
        order = np.lexsort((self.doc, self.hash, bucket))
        h, d = self.hash[order], self.doc[order]
        new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.distinct, self.bucket = h[first], bucket[order][first]
        self.number = np.empty(len(h), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.several = d[first] != d[np.append(first[1:], len(h)) - 1] if len(first) else np.zeros(0, bool)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> _U(17)) % _U(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Sorted bucket numbers, run by run."""
    edge = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(edge, np.append(edge[1:], len(bucket))):
        yield int(bucket[lo]), slice(int(lo), int(hi))


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds), 8), 8 * (len(kinds) + 1), []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(raw[at : at + size], kind))
        at += int(size)
    return out


_Batches = Iterator[pa.RecordBatch]


def _blocks(block_bytes: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        number, held, size = TaskContext.get().partitionId() << 28, [], 0

        def flushed() -> pa.RecordBatch:
            packed = zstandard.compress(b"".join(t for _, t in held), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([[i for i, _ in held]], pa.list_(pa.int64())), pa.array([[len(t) for _, t in held]], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
                ["block", "ids", "sizes", "packed"],
            )

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                held.append((doc_id, (text or "").encode()))
                size += len(held[-1][1]) + 64
                if size >= block_bytes:
                    yield flushed()
                    number, held, size = number + 1, [], 0
        if held:
            yield flushed()

    return run


_BLOCK = "block long, ids array<bigint>, sizes array<bigint>, packed binary"


def _opened(b: pa.RecordBatch, length: int, gram: int, buckets: int) -> Iterator[tuple[int, int, _Block]]:
    for i in range(len(b)):
        yield i, b["block"][i].as_py(), _Block(b["ids"][i].as_py(), b["sizes"][i].as_py(), b["packed"][i].as_py(), length, gram, buckets)


def _rows(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, schema)], [name for name, _ in schema])


_MESSAGE = [("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())]
_MESSAGE_DDL = "bucket long, block long, kind int, blob binary"
_HASHES, _CONTEXTS, _OWN, _ANSWER = range(4)


def _contexts(x: _Block, length: int) -> np.ndarray:
    """How many distinct contexts each distinct anchor hash has in the block."""
    count = np.bincount(x.number, minlength=len(x.distinct))
    some = np.flatnonzero(count[x.number] > 1)
    if len(some):
        low, size, number = x.low[some], x.high[some] - x.low[some] + length, x.number[some]
        h = _mixed(HashedText(x.data).hash(low, size) + _mixed((x.at[some] - low).astype(np.uint64) * _U(256) + size.astype(np.uint64)))
        order = np.lexsort((h, number))
        h, number = h[order], number[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (number[1:] != number[:-1])))
        several = np.bincount(number[new], minlength=len(count))
        count = np.where(count > 1, several, count)
    return np.minimum(count, 0xFFFF).astype("<u2")


def _sent_hashes(length: int, gram: int, buckets: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        for b in batches:
            for _, block, x in _opened(b, length, gram, buckets):
                six = x.distinct.view(np.uint8).reshape(-1, 8)[:, 2:]  # the low bits follow from the bucket only in part, the high ones suffice
                contexts = _contexts(x, length)
                yield _rows([(k, block, _HASHES, _pack(np.ascontiguousarray(six[part]), np.packbits(x.several[part]), contexts[part])) for k, part in _by_bucket(x.bucket)], _MESSAGE)

    return run


def _gathered(batches: _Batches) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Bucket by bucket: a task's rows come sorted by bucket, so one bucket is held at a time."""
    at, held = None, []
    for b in batches:
        for bucket, *row in zip(*(b[c].to_pylist() for c in ("bucket", "block", "kind", "blob"))):
            if bucket != at and held:
                yield at, held
                held = []
            at = bucket
            held.append(row)
    if held:
        yield at, held


def _answered_hashes(hot_blocks: int, hot_contexts: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        for bucket, rows in _gathered(batches):
            hashes, several, contexts = [], [], []
            for _, _, blob in rows:
                six, bits, n = _unpack(blob, np.uint8, np.uint8, "<u2")
                contexts.append(n)
                wide = np.zeros((len(six) // 6, 8), np.uint8)
                wide[:, :6] = six.reshape(-1, 6)
                hashes.append(wide.view(np.uint64).ravel())
                several.append(np.unpackbits(bits, count=len(hashes[-1])).astype(bool))
            h, s = np.concatenate(hashes), np.concatenate(several)
            _, number, count = np.unique(h, return_inverse=True, return_counts=True)
            known = np.zeros(len(count), bool)
            known[number[s]] = True
            held = np.bincount(number, np.concatenate(contexts), len(count))  # what a bucket would gather of each
            repeated, hot = (known | (count > 1))[number], ((count >= hot_blocks) & (held >= hot_contexts))[number]
            at, out = 0, []
            for (block, _, _), part in zip(rows, hashes):
                mine = slice(at, at + len(part))
                out.append((bucket, block, _ANSWER, _pack(np.packbits(repeated[mine]), np.packbits(hot[mine]))))
                at += len(part)
            yield _rows(out, _MESSAGE)

    return run


def _flags(x: _Block, answers: list) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor: repeated, hot."""
    flags = np.zeros((2, len(x.distinct)), bool)
    by = {a["bucket"]: a["blob"] for a in answers or [] if a["kind"] == _ANSWER}
    for k, part in _by_bucket(x.bucket):
        for row, bits in zip(flags, _unpack(by[k], np.uint8, np.uint8)):
            row[part] = np.unpackbits(bits, count=part.stop - part.start).astype(bool)
    return flags[0][x.number], flags[1][x.number]


def _sent_contexts(length: int, gram: int, buckets: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        for b in batches:
            for i, block, x in _opened(b, length, gram, buckets):
                repeated, hot = _flags(x, b["answers"][i].as_py())
                text = HashedText(x.data)
                plain = np.flatnonzero(repeated & ~hot)
                each = np.flatnonzero(hot)
                n = x.high[each] - x.low[each] + 1
                window = np.repeat(x.low[each], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                low, high = np.concatenate((x.low[plain], window)), np.concatenate((x.high[plain], window))
                at, doc = np.concatenate((x.at[plain], window)), np.concatenate((x.doc[plain], np.repeat(x.doc[each], n)))
                bucket = np.concatenate((bucket_of(x.hash[plain], buckets), bucket_of(_mixed(text.hash(window, length)), buckets)))
                rep = _classes(text, low, high - low + length, at - low, doc)
                sent = np.flatnonzero(rep == np.arange(len(rep)))
                sent = sent[np.argsort(bucket[sent], kind="stable")]
                place = np.full(len(rep), -1, np.int32)
                place[sent] = np.arange(len(sent))
                answer = np.where(doc == doc[rep], place[rep], -1).astype("<i4")  # -1: equal to a smaller document's here
                own = [(int(block % buckets), block, _OWN, _pack(low.astype("<i4"), (high - low).astype(np.uint8), answer))]
                size = high - low + length
                for k, part in _by_bucket(bucket[sent]):
                    w = sent[part]
                    flat = np.repeat(low[w], size[w]) + (np.arange(size[w].sum()) - np.repeat(np.cumsum(size[w]) - size[w], size[w]))
                    own.append((k, block, _CONTEXTS, _pack(doc[w].astype("<i8"), (at - low)[w].astype(np.uint8), (high - low)[w].astype(np.uint8), x.data[flat])))
                yield _rows(own, _MESSAGE)

    return run


def settle(data: np.ndarray, doc: np.ndarray, offset: np.ndarray, extra: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each context, a bit for each of its windows that also starts in a smaller document.

    data: the contexts end to end; extra: windows beyond the first; offset: of the anchor.
    """
    n = len(doc)
    size = extra.astype(np.int64) + length
    start = np.cumsum(size) - size
    text = HashedText(data)
    full = (_U(1) << (extra.astype(np.uint64) + _U(1))) - _U(1)
    bits = np.zeros(n, np.uint64)
    rep = _classes(text, start, size, offset, doc)
    bits[doc > doc[rep]] = full[doc > doc[rep]]

    kinds = np.flatnonzero(rep == np.arange(n))
    h = _mixed(text.hash(start[kinds] + offset[kinds], gram))
    order = np.argsort(h, kind="stable")
    kinds, h = kinds[order], h[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(h)))
    lowest, highest = (f.reduceat(doc[kinds], first) if len(first) else first for f in (np.minimum, np.maximum))
    group = np.repeat(np.arange(len(first)), count)
    asked = np.repeat((count > 1) & (lowest < highest), count)
    kinds, group = kinds[asked], group[asked]
    windows = np.cumsum(extra[kinds].astype(np.int64) + 1)
    cuts = np.flatnonzero(np.diff(group, prepend=-1))
    at = 0
    while at < len(kinds):  # whole groups, up to so many windows at a time
        later = cuts[(cuts > at) & (windows[cuts - 1] - (windows[at - 1] if at else 0) >= _SORT_WINDOWS)]
        stop = int(later[0]) if len(later) else len(kinds)
        _sort_windows(text, doc, offset, extra, start, kinds[at:stop], group[at:stop], bits, length)
        at = stop
    same = doc == doc[rep]
    bits[same] = bits[rep[same]]
    return bits


def _sort_windows(text: HashedText, doc, offset, extra, start, kinds, group, bits, length: int) -> None:
    n = extra[kinds].astype(np.int64) + 1
    which = np.repeat(kinds, n)
    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(group, n) * 256 + (offset[which].astype(np.int64) - shift)
    order = np.argsort(key, kind="stable")
    which, shift, key = which[order], shift[order], key[order]
    at = start[which] + shift
    # A window whose hash no other of its key has is equal to none; the sort decides on all others.
    _, number, count = np.unique(_mixed(text.hash(at, length) + _mixed(key.astype(np.uint64))), return_inverse=True, return_counts=True)
    shared = count[number] > 1
    which, shift, key, at = which[shared], shift[shared], key[shared], at[shared]
    if not len(which):
        return
    order = suffix_merge_sort(text, at, key, length)
    which, shift, key, at = which[order], shift[order], key[order], at[order]
    near = np.flatnonzero((key[1:] == key[:-1]) & (text.common(at[1:], at[:-1], length) == length)) + 1
    true = _rows_equal(text.data, at[near], at[near - 1], np.full(len(near), length))
    apart = np.ones(len(at), bool)
    if true.all():
        apart[near] = False
    else:  # a hash collision among neighbours: by the bytes themselves
        strings = np.ascontiguousarray(text.data[at[:, None] + np.arange(length)]).view(f"V{length}").ravel()
        _, string = np.unique(strings, return_inverse=True)
        order = np.lexsort((string, key))
        which, shift, key, string = which[order], shift[order], key[order], string[order]
        apart[1:] = (key[1:] != key[:-1]) | (string[1:] != string[:-1])
    first = np.flatnonzero(apart)
    least = np.minimum.reduceat(doc[which], first)[np.cumsum(apart) - 1]
    gone = doc[which] > least
    np.bitwise_or.at(bits, which[gone], _U(1) << shift[gone].astype(np.uint64))


def _answered_contexts(length: int, gram: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        for bucket, rows in _gathered(batches):
            out = [(bucket, block, kind, blob) for block, kind, blob in rows if kind == _OWN]
            parts = [(block, _unpack(blob, "<i8", np.uint8, np.uint8, np.uint8)) for block, kind, blob in rows if kind == _CONTEXTS]
            if parts:
                doc, offset, extra, data = (np.concatenate([p[k] for _, p in parts]) for k in range(4))
                bits, at = settle(data, doc, offset, extra, length, gram), 0
                for block, p in parts:
                    mine = bits[at : at + len(p[0])]
                    at += len(mine)
                    out.append((bucket, block, _ANSWER, _pack(mine)))
            yield _rows(out, _MESSAGE)

    return run


def _removed(length: int) -> Callable[[_Batches], _Batches]:
    schema = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.binary()), ("kept", pa.binary())]

    def run(batches: _Batches) -> _Batches:
        for b in batches:
            for i in range(len(b)):
                ids, sizes = b["ids"][i].as_py(), np.array(b["sizes"][i].as_py(), np.int64)
                data = np.frombuffer(zstandard.decompress(b["packed"][i].as_py()), np.uint8)
                edge, answers = np.zeros(len(data) + 1, np.int32), b["answers"][i].as_py() or []
                own = next((a["blob"] for a in answers if a["kind"] == _OWN), None)
                if own is not None:
                    low, extra, answer = _unpack(own, "<i4", np.uint8, "<i4")
                    bits = [np.zeros(0, np.uint64)] + [_unpack(a["blob"], np.uint64)[0] for a in sorted((a for a in answers if a["kind"] == _ANSWER), key=lambda a: a["bucket"])]
                    mask = np.concatenate((*bits, [_U(0)]))[answer]
                    mask = np.where(answer < 0, (_U(1) << (extra.astype(np.uint64) + _U(1))) - _U(1), mask)
                    for k in range(int(extra.max(initial=0)) + 1):
                        p = low[(mask >> _U(k)) & _U(1) == 1] + k
                        np.add.at(edge, p, 1)
                        np.add.at(edge, p + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                ends, out = np.cumsum(sizes), []
                for doc_id, s, e in zip(ids, ends - sizes, ends):
                    g = gone[s:e]
                    n = int(g.sum())
                    spans = np.flatnonzero(np.diff(g, prepend=False, append=False)).astype("<i8") if n else np.zeros(0, "<i8")
                    out.append((doc_id, int(e - s), n, len(spans) // 2, spans.tobytes(), (data[s:e][~g] if n else data[s:e]).tobytes()))
                for lo in range(0, len(out), 2000):
                    yield _rows(out[lo : lo + 2000], schema)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, hot_blocks: int = HOT_BLOCKS, bucket_bytes: int = BUCKET_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, spans, kept)``, a row per input row.

    ``spans`` holds the maximal removed runs as little-endian int64 pairs of
    begin and end, ``kept`` the remaining bytes. ``length`` is at most 64 + ``gram``, so that a context's windows fit a 64-bit answer.
    """
    if not gram <= length <= gram + 62:
        raise ValueError("length must lie between gram and gram + 62")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = materialize(rows.mapInArrow(_blocks(block_bytes), _BLOCK), "blocks")
    buckets = max(4 * shuffle_width(docs.sparkSession), math.ceil(blocks.count() * block_bytes / bucket_bytes))

    def dealt(messages: DataFrame) -> DataFrame:
        parts = math.ceil(buckets / 4)  # four buckets in each, exactly
        return messages.repartitionById(parts, (F.col("bucket") % parts).cast("int")).sortWithinPartitions("bucket")

    def with_answers(messages: DataFrame) -> DataFrame:
        answers = messages.groupBy("block").agg(F.collect_list(F.struct("bucket", "kind", "blob")).alias("answers"))
        return blocks.join(answers, "block", "left")

    hashes = dealt(blocks.mapInArrow(_sent_hashes(length, gram, buckets), _MESSAGE_DDL))
    repeated = hashes.mapInArrow(_answered_hashes(hot_blocks, hot_contexts), _MESSAGE_DDL)
    contexts = dealt(with_answers(repeated).mapInArrow(_sent_contexts(length, gram, buckets), _MESSAGE_DDL))
    settled = contexts.mapInArrow(_answered_contexts(length, gram), _MESSAGE_DDL)
    return with_answers(settled).mapInArrow(_removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, spans binary, kept binary")
