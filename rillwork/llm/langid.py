"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes. Two GRU layers, one from each side, give every
position a state; a linear layer labels every position, and a document's
probabilities pool the positions' log-probabilities over the whole
text. It is trained in numpy by backpropagation through time, with Adam, on a
bounded sample of labelled rows (``per_lang`` different texts of each language, ``max_rows`` at most in all,
drawn by a seeded hash, and ``train_windows`` windows of excerpts of them), so that neither
the driver's memory nor training time follows the corpus. Texts are cut into windows of
``WINDOW`` bytes that run side by side as one batch; every byte is labelled.

Defined results: ``und`` with score 0 for a null or empty text or one without a
letter; rows without a language are never learned from but are labelled; with
no rows to learn from, all are ``und``; rows that repeat are labelled
alike; ties go to the language first in order; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rillwork.llm.common import unused

WINDOW = 48
HIDDEN = 8
PER_LANG = 400
TRAIN_WINDOWS = 6000
MAX_ROWS = 40_000
EXCERPT = 4096
EVIDENCE = 8.0
DRAW_BITS = 12
SEED = 7
_BATCH_WINDOWS = 2048

UND = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """The logistic function by way of tanh, in place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


class ByteBiGRU:
    """Weights and the passes over (time, batch) arrays of byte numbers; 0 pads, a byte b is b + 1."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng, self.labels, self.h = np.random.default_rng(seed), labels, hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        self.w = {}
        for side in "fb":
            # Reset and update gates side by side, then the candidate; the input part is a table by byte.
            self.w |= {f"x{side}": draw(257, 3 * hidden), f"u{side}": draw(hidden, 2 * hidden), f"c{side}": draw(hidden, hidden)}
        self.w |= {"out": draw(2 * hidden, len(labels)), "bias": np.zeros(len(labels), np.float32)}

    def _run(self, x: np.ndarray, side: str, tape: list | None = None) -> np.ndarray:
        h, (steps, batch) = self.h, x.shape
        wx, wu, wc = self.w[f"x{side}"], self.w[f"u{side}"], self.w[f"c{side}"]
        states = np.empty((steps, batch, h), np.float32)
        state = np.zeros((batch, h), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            into = wx[x[t]]
            gates = _sigmoid(into[:, : 2 * h] + state @ wu)
            r, z = gates[:, :h], gates[:, h:]
            gated = r * state
            new = np.tanh(into[:, 2 * h :] + gated @ wc)
            if tape is not None:
                tape.append((t, state, gates, gated, new))
            state = new + z * (state - new)
            states[t] = state
        return states

    def logits(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, label)"""
        h = self.h
        return self._run(x, "f") @ self.w["out"][:h] + self._run(x, "b") @ self.w["out"][h:] + self.w["bias"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the labelled positions, and its gradients through time."""
        h, w = self.h, self.w
        tapes: dict[str, list] = {"f": [], "b": []}
        states = {side: self._run(x, side, tapes[side]) for side in "fb"}
        logit = states["f"] @ w["out"][:h] + states["b"] @ w["out"][h:] + w["bias"]
        logit -= logit.max(axis=2, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=2, keepdims=True)
        real = (x > 0).astype(np.float32)
        n = max(1.0, float(real.sum()))
        steps, columns = np.indices(x.shape)
        loss = -float((np.log(p[steps, columns, y[None, :].repeat(len(x), 0)] + 1e-9) * real).sum()) / n
        p[steps, columns, y[None, :].repeat(len(x), 0)] -= 1
        d = p * (real / n)[:, :, None]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["bias"] = d.sum(axis=(0, 1))
        flat = d.reshape(-1, d.shape[2])
        for side, rows in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            g["out"][rows] = states[side].reshape(-1, h).T @ flat
            down = d @ w["out"][rows].T
            carry = np.zeros_like(down[0])
            for t, before, gates, gated, new in reversed(tapes[side]):
                r, z = gates[:, :h], gates[:, h:]
                ds = down[t] + carry
                dnew = ds * (1 - z) * (1 - new * new)
                dgated = dnew @ w[f"c{side}"].T
                dgates = np.concatenate((dgated * before, ds * (before - new)), axis=1) * gates * (1 - gates)
                g[f"c{side}"] += gated.T @ dnew
                g[f"u{side}"] += before.T @ dgates
                np.add.at(g[f"x{side}"], x[t], np.concatenate((dgates, dnew), axis=1))
                carry = ds * z + dgated * r + dgates @ w[f"u{side}"].T
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 360, batch: int = 192, rate: float = 0.02, seed: int = SEED) -> ByteBiGRU:
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.w.items()} for _ in range(2))
        for k in range(1, steps + 1):
            mine = rng.integers(0, len(y), batch)
            _, g = self.gradients(x[:, mine], y[mine])
            step = rate * min(1.0, 2 * (1 - k / (steps + 1)))
            for name, a in self.w.items():
                grad = np.clip(g[name], -0.1, 0.1)
                m[name] += 0.1 * (grad - m[name])
                v[name] += 0.01 * (grad * grad - v[name])
                a -= (step * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(document, label): mean of the positions' log-probabilities over all bytes of each text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        windows = -(-sizes // WINDOW)
        grid = np.zeros((int(windows.sum()), WINDOW), np.int16)
        begin = (np.cumsum(windows) - windows) * WINDOW
        flat = grid.reshape(-1)
        for at, t in zip(begin, texts):
            flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
            flat[at : at + len(t)] += 1
        owner = np.repeat(np.arange(len(texts)), windows)
        total = np.zeros((len(texts), len(self.labels)), np.float64)
        for lo in range(0, len(grid), _BATCH_WINDOWS):
            x = np.ascontiguousarray(grid[lo : lo + _BATCH_WINDOWS].T)
            logit = self.logits(x)
            logit -= logit.max(axis=2, keepdims=True)
            logit -= np.log(np.exp(logit).sum(axis=2, keepdims=True))
            logit *= (x > 0)[:, :, None]
            np.add.at(total, owner[lo : lo + _BATCH_WINDOWS], logit.sum(axis=0))
        return total / np.maximum(sizes, 1)[:, None]


_DROP = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def network_input(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and every run of other ASCII as one space."""
    return b" ".join((text or "").encode().translate(_DROP).split())


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text) if text else False


def train(labelled: DataFrame, per_lang: int = PER_LANG, train_windows: int = TRAIN_WINDOWS, seed: int = SEED, max_rows: int = MAX_ROWS, excerpt: int = EXCERPT) -> ByteBiGRU | None:
    """Fit on at most ``per_lang`` different texts of each language of ``labelled(text, lang)``; None without rows.

    A language's texts are the first in the order of a seeded hash, so the sample is the same on every run and spreads over
    the whole table whatever its size, and copies of a text count once. No language is left out: with more
    than ``max_rows / per_lang`` of them each has fewer texts, one at least. Windows are drawn from an
    excerpt of ``excerpt`` characters, at a seeded place of the text, which bounds the sample in bytes too.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = rows.withColumn("draw", F.xxhash64("text", F.lit(seed)))
    langs = rows.agg(F.count_distinct("lang")).first()[0]
    if not langs:
        return None
    share = max(1, min(per_lang, max_rows // langs))
    drawn = _smallest(rows.select("lang", "draw").distinct(), share)
    at = F.pmod(F.xxhash64("text", F.lit(seed + 1)), F.greatest(F.length("text") - excerpt + 1, F.lit(1))) + 1
    cut = F.col("text").substr(at.cast("int"), F.lit(excerpt))
    sample = rows.join(F.broadcast(drawn), ["lang", "draw"]).groupBy("lang", "draw").agg(F.min(cut).alias("text")).select("lang", "text").collect()
    per = max(1, train_windows // langs)
    rng, x, y, labels = np.random.default_rng(seed), [], [], sorted({r["lang"] for r in sample})
    for k, lang in enumerate(labels):
        own = [w for r in sorted(sample) if r["lang"] == lang and has_letter(r["text"]) and (w := network_input(r["text"]))]
        for _ in range(per if own else 0):
            text = own[rng.integers(len(own))]
            at = int(rng.integers(max(1, len(text) - WINDOW + 1)))
            cut = np.zeros(WINDOW, np.int16)
            part = np.frombuffer(text[at : at + WINDOW], np.uint8)
            cut[: len(part)] = part.astype(np.int16) + 1
            x.append(cut)
            y.append(k)
    if not x:
        return None
    return ByteBiGRU(labels, seed=seed).fit(np.array(x).T.copy(), np.array(y))


def _smallest(drawn: DataFrame, share: int) -> DataFrame:
    """The ``share`` smallest values of ``draw`` of each language of ``drawn(lang, draw)``.

    The draw is uniform, so counts of its first ``DRAW_BITS`` bits tell where a language's share ends, and only the
    values up to there, about ``share`` and a bucket of a common language, meet in one task.
    """
    bucketed = drawn.withColumn("bucket", F.shiftright("draw", 64 - DRAW_BITS))
    before = W.partitionBy("lang").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = bucketed.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < share).groupBy("lang").agg(F.max("bucket").alias("end"))
    near = bucketed.join(F.broadcast(ends), "lang").where(F.col("bucket") <= F.col("end"))
    ranked = near.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("draw")))
    return ranked.where(F.col("at") <= share).select("lang", "draw")


def _labelled(model, keep: tuple[str, str] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """keep: all columns are passed on, and the result's two added by these names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: ByteBiGRU | None = model.value
        for b in batches:
            texts = b["text"].to_pylist()
            lang, score = np.full(len(texts), UND, object), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if net else []
            for lo in range(0, len(known), 512):
                mine = known[lo : lo + 512]
                p = net.pooled([network_input(texts[i]) for i in mine])
                # Positions are not independent: the pooled evidence counts as that of a few of them.
                p = np.exp(EVIDENCE * (p - p.max(axis=1, keepdims=True)))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                lang[mine], score[mine] = np.array(net.labels, object)[best], p[np.arange(len(mine)), best]
            own = b.columns if keep else [b["doc_id"]]
            names = b.schema.names if keep else ["doc_id"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, *(keep or ("__lang_pred", "__lang_score"))])

    return run


def identify(docs: DataFrame, model: ByteBiGRU | None) -> DataFrame:
    """``(doc_id, lang_pred, score)``, a row per input row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_labelled(sent), "doc_id long, __lang_pred string, __lang_score double")
    return found.select("doc_id", F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.0, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told, with at least ``min_score``. Nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, **options))
    lang, score = unused(docs, "__lang_pred", "__lang_score")
    schema = StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])
    found = docs.mapInArrow(_labelled(sent, keep=(lang, score)), schema)
    return found.where((F.col(lang) != UND) & (F.col(score) >= min_score)).select(*(f"`{c}`" for c in docs.columns))
