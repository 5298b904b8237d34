"""Toxicity scores from class-conditional Kneser-Ney models.

One interpolated Kneser-Ney model of the bytes of words is trained for toxic
and one for ordinary texts. Orders above ``SHARED`` are conditional
on the class; the orders up to it pool the continuation counts of both, so
that rare expressions, which one class may never have seen, fall back on the
same distribution. A text's score compares the two log-likelihoods, normalised
by length: their difference per byte over the whole text, and that of its two most
telling words, go through a logistic function that is fitted on sampled rows
that the models have not seen, weighted by the classes' shares of all rows.

The n-grams are counted by class over the whole texts of all labelled rows, in
a distributed aggregate; the driver gathers one row per distinct n-gram of the highest order,
of which all lower orders follow, so the model grows with the n-grams that the corpus has
and not with its length. The few weights of the logistic function are fitted on a
sample of whole rows, drawn by a seeded hash of their ids, of about ``per_class`` rows of each class
and at most ``HELD`` of them: they are scored by models of all other rows, and only
their features are gathered; afterwards their n-grams are added to the models. Scoring
reads every whole text; distinct words are scored once a task.

Defined results: null, empty and wordless texts get the score that the
classes' shares of the labelled rows give; with only one class labelled, that class's
share (0 or 1) is every score; without labelled rows the score is 0; labels
other than 0 and 1 are ignored, rows that repeat are scored alike, and
further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.suffix_dedup import _BYTE, HashedText

ORDER = 5
SHARED = 2
DISCOUNT = 0.75
PER_CLASS = 2000
HELD = 0.3
SEED = 11
_MEMO_WORDS = 500_000
_CHUNK = 20_000
_U = np.uint64

_START, _END = b"\x02", b"\x03"
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of letters as UTF-8, A-Z lower-cased; all characters beyond ASCII count as letters."""
    return (text or "").encode().translate(_LETTERS).split()


class _Laid:
    """Words end to end, each after a context of start marks; predicted places, and hashes of their n-grams."""

    def __init__(self, own: list[bytes], order: int):
        pad = _START * (order - 1)
        self.text = HashedText(np.frombuffer(b"".join(pad + w + _END for w in own), np.uint8))
        size = np.array([len(w) + 1 for w in own], np.int64)
        self.word = np.repeat(np.arange(len(own)), size)
        first = np.cumsum(size + order - 1) - size
        self.at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def grams(self, n: int) -> np.ndarray:
        return self.text.hash(self.at - n + 1, n)

    def contexts(self, n: int) -> np.ndarray:
        return self.text.hash(self.at - n + 1, n - 1)

    def rows(self, n: int) -> np.ndarray:
        """The bytes of each n-gram."""
        return self.text.data[self.at[:, None] + np.arange(1 - n, 1)]


class _Grams:
    """Distinct n-grams of one order, as numbers; they and their suffixes hash as they do in words that are laid."""

    def __init__(self, codes: np.ndarray, order: int):
        self.order = order
        self.data = [(codes >> 8 * (order - 1 - j) & 255).astype(np.uint8) for j in range(order)]

    def _hash(self, start: int, size: int) -> np.ndarray:
        return sum((_BYTE[self.data[start + j]] * HashedText._pow[j] for j in range(size)), np.zeros(len(self.data[0]), _U))

    def grams(self, n: int) -> np.ndarray:
        return self._hash(self.order - n, n)

    def contexts(self, n: int) -> np.ndarray:
        return self._hash(self.order - n, n - 1)

    def marked(self, n: int) -> np.ndarray:
        """Whether the n-gram begins with a start mark, and so has no left context of its own."""
        return self.data[self.order - n] == _START[0]


def gram_counts(counts: Sequence[Counter], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of counted words as numbers, in order, and how often each counter has them, a column each."""
    own, codes, n = sorted(set().union(*counts)), [np.zeros(0, np.int64)], [np.zeros((0, len(counts)), np.int64)]
    for lo in range(0, len(own), _CHUNK):
        part = own[lo : lo + _CHUNK]
        laid = _Laid(part, order)
        each = np.array([[c[w] for c in counts] for w in part], np.int64)
        codes.append(laid.rows(order).astype(np.int64) @ (1 << 8 * np.arange(order - 1, -1, -1)))
        n.append(each[laid.word])
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros((len(found), len(counts)), np.int64)
    np.add.at(total, at, np.concatenate(n))
    return found, total


class KneserNeyPair:
    """Interpolated Kneser-Ney models of two classes with shared low orders. counts: words of each class."""

    def __init__(self, counts: tuple[Counter, Counter], order: int = ORDER, shared: int = SHARED, discount: float = DISCOUNT):
        self._fit(*gram_counts(counts, order), order, shared, discount)

    @classmethod
    def of_grams(cls, codes: np.ndarray, counts: np.ndarray, order: int = ORDER, shared: int = SHARED, discount: float = DISCOUNT) -> KneserNeyPair:
        """From what ``gram_counts`` gives, a column for each class."""
        pair = cls.__new__(cls)
        pair._fit(codes, counts, order, shared, discount)
        return pair

    def _fit(self, codes: np.ndarray, counts: np.ndarray, order: int, shared: int, discount: float) -> None:
        self.order = order
        laid, weight = _Grams(codes, order), counts.T.astype(np.float64)
        raw, number, unique, first = {}, {}, {}, {}
        for n in range(1, order + 1):
            unique[n], first[n], number[n] = np.unique(laid.grams(n), return_index=True, return_inverse=True)
            raw[n] = [np.bincount(number[n], w, len(unique[n])) for w in weight]
        self.tables = []
        below = [np.full(1, -np.log(256.0))] * 2
        for n in range(1, order + 1):
            if n == order:
                count = raw[n]
            else:
                seen = [c > 0 for c in raw[n + 1]]
                if n <= shared:
                    seen = [seen[0] | seen[1]] * 2
                suffix = number[n][first[n + 1]]
                marked = laid.marked(n)[first[n]]
                both = raw[n][0] + raw[n][1]
                count = [np.where(marked, both if n <= shared else raw[n][k], np.bincount(suffix, seen[k], len(unique[n]))) for k in (0, 1)]
            contexts, of = np.unique(laid.contexts(n)[first[n]], return_inverse=True) if n > 1 else (np.zeros(1, np.uint64), np.zeros(len(unique[n]), np.int64))
            lower = number[n - 1][first[n]] if n > 1 else np.zeros(len(unique[n]), np.int64)
            logs, weights = [], []
            for k in (0, 1):
                total = np.bincount(of, count[k], len(contexts))
                kinds = np.bincount(of, count[k] > 0, len(contexts))
                spare = np.where(total > 0, discount * kinds / np.maximum(total, 1e-9), 1.0)
                own_part = np.maximum(count[k] - discount, 0) / np.maximum(total[of], 1e-9)
                logs.append(np.log(own_part + spare[of] * np.exp(below[k][lower])))
                weights.append(np.log(spare))
            below = logs
            self.tables.append((unique[n], np.stack(logs, 1).astype(np.float32), contexts, np.stack(weights, 1).astype(np.float32)))

    def compare(self, own: list[bytes]) -> np.ndarray:
        """For each word, the log-likelihood under class 1 less that under class 0."""
        laid = _Laid(own, self.order)
        p = np.full((len(laid.at), 2), -np.log(256.0), np.float32)
        for n, (grams, logs, contexts, weights) in enumerate(self.tables, 1):
            g = laid.grams(n)
            at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
            seen = grams[at] == g
            if n > 1:
                c = laid.contexts(n)
                to = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
                p += np.where((contexts[to] == c)[:, None], weights[to], np.float32(0))
            else:
                p += weights[0]
            p = np.where(seen[:, None], logs[at], p)
        return np.bincount(laid.word, p[:, 1] - p[:, 0], len(own))


class ToxicityModel:
    """The two models, and the logistic function of their comparison."""

    def __init__(self, texts: list[str | None], toxic: list[int], share: float, seed: int = SEED):
        """From rows in memory; ``train`` does the same with those of a table."""
        self.share, self.pair, self.memo = share, None, {}
        held = np.random.default_rng(seed).random(len(texts)) < HELD
        counts = [Counter() for _ in range(4)]
        for text, label, h in zip(texts, toxic, held):
            counts[2 * h + label].update(words(text))
        mine = [k for k in np.flatnonzero(held) if words(texts[k])]
        self.fit(*gram_counts(counts), lambda: ([self.features(texts[k]) for k in mine], [toxic[k] for k in mine]))

    def fit(self, codes: np.ndarray, counts: np.ndarray, held: Callable[[], tuple[list, list]]) -> None:
        """counts: of the two classes in most rows, and in the rows held back; held: features and classes of the latter."""
        most = counts[:, :2]
        if not most.any(axis=0).all():
            return
        seen = most.any(axis=1)
        self.pair = KneserNeyPair.of_grams(codes[seen], most[seen])
        features, y = held()
        x = np.array(features, np.float64).reshape(-1, 4)
        self.scale = np.maximum(np.abs(x).max(axis=0, initial=0), 1e-9)
        self.weights = _logistic(x / self.scale, np.array(y, np.float64), self.share)
        self.pair, self.memo = KneserNeyPair.of_grams(codes, most + counts[:, 2:]), {}

    def learn(self, own: set[bytes]) -> None:
        """Score the words that are new."""
        new = [w for w in own if w not in self.memo]
        if len(self.memo) + len(new) > _MEMO_WORDS:
            self.memo, new = {}, list(own)
        for lo in range(0, len(new), _CHUNK):
            part = new[lo : lo + _CHUNK]
            self.memo.update(zip(part, self.pair.compare(part).tolist()))

    def features(self, text: str | None) -> np.ndarray:
        own = words(text)
        self.learn(set(own))
        each = np.fromiter(map(self.memo.__getitem__, own), np.float64, len(own))
        top = np.sort(each)[-2:]
        return np.array([1.0, each.sum() / sum(map(len, own)), top[-1], top[0]])

    def score(self, text: str | None) -> float:
        if self.pair is None or not words(text):
            return self.share
        return float(1 / (1 + np.exp(-np.clip((self.features(text) / self.scale) @ self.weights, -40, 40))))


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression by Newton's method; class 1 has ``share`` of the weight."""
    w = np.zeros(x.shape[1])
    if not len(y) or not 0 < y.mean() < 1:
        return w
    c = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (c * (p - y)) + ridge * len(y) * w / 100
        curve = (x * (c * p * (1 - p))[:, None]).T @ x + ridge * len(y) / 100 * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams by ``slot``; a task's memory is bounded by the distinct words that it gathers before it passes them on."""

    def passed_on() -> pa.RecordBatch:
        codes, n = gram_counts(counts)
        return pa.RecordBatch.from_arrays([pa.array(codes), *(pa.array(np.ascontiguousarray(n[:, k])) for k in range(4))], ["gram", "n0", "n1", "n2", "n3"])

    counts = [Counter() for _ in range(4)]
    for b in batches:
        for text, slot in zip(b["text"], b["slot"].to_pylist()):
            counts[slot].update(words(text.as_py()))
            if sum(map(len, counts)) > _MEMO_WORDS // 2:
                yield passed_on()
                counts = [Counter() for _ in range(4)]
    yield passed_on()


def _featured(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: ToxicityModel = model.value
        for b in batches:
            rows = [(y, own.features(t).tolist()) for t, y in zip(b["text"].to_pylist(), b["toxic"].to_pylist()) if words(t)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = SEED) -> ToxicityModel:
    """Count all labelled rows, and fit the weights on about ``per_class`` of each class, as the module says. docs: (doc_id, text); labels: (doc_id, toxic)."""
    sc = docs.sparkSession.sparkContext
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    model = ToxicityModel([], [], counts.get(1, 0) / sum(counts.values()) if counts else 0.0, seed)
    if len(counts) < 2:
        return model
    share = F.when(F.col("toxic") == 1, min(HELD, per_class / counts[1])).otherwise(min(HELD, per_class / counts[0]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.withColumn("held", draw < share)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # The labels grow with the input, so they are not sent to all executors; without a sort, the texts move once.
    slots = texts.join(rows.hint("shuffle_hash"), "doc_id").select("text", (F.col("held").cast("int") * 2 + F.col("toxic")).alias("slot"))
    grams = slots.mapInArrow(_counted, "gram long, n0 long, n1 long, n2 long, n3 long").groupBy("gram").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4)))
    found = grams.toArrow().sort_by("gram")
    columns = [found[c].to_numpy().astype(np.int64) for c in found.column_names]

    def held() -> tuple[list, list]:
        sample = texts.join(F.broadcast(rows.where("held")), "doc_id").select("text", "toxic")
        own = sorted((r["toxic"], r["x"]) for r in sample.mapInArrow(_featured(sc.broadcast(model)), "toxic int, x array<double>").collect())
        return [x for _, x in own], [y for y, _ in own]

    model.fit(columns[0], np.stack(columns[1:], 1), held)
    return model


def _scored(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: ToxicityModel = model.value
        for b in batches:
            texts = b["text"].to_pylist()
            if own.pair is not None:  # words that are new are scored together
                fresh: set[bytes] = set()
                for t in texts:
                    fresh.update(words(t))
                    if len(fresh) > _MEMO_WORDS // 2:
                        own.learn(fresh)
                        fresh = set()
                own.learn(fresh)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([own.score(t) for t in texts], pa.float64())], ["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score)``, a row per input row; the model, of bounded size, goes to all executors."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scored(sent), "doc_id long, score double")
