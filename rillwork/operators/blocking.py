"""Candidate pairs by blocking on several keys, with provenance.

A block joins two sources on a key. Keys that are null, empty or shared by more
rows of a side than the block's cap are left out, on each side by itself. Pairs of all
blocks are united and grouped, so that a pair carries the blocks that found it.

``linked_pairs`` finds the same pairs without moving one: each entity learns which of its keys are used, travels to those
keys with what it carries, and a pair comes out where its first common key is.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.sources.schemas import require_columns


class Block(NamedTuple):
    name: str
    column: str
    cap: int
    prefix: int | None = None

    @property
    def key(self) -> Column:
        c = F.col(self.column)
        return F.substring(c, 1, self.prefix) if self.prefix else c


#: The six blocks, their keys and their caps a side.
BLOCKS = (
    Block("exact_name", "business_name_compact", 5000),
    Block("exact_address", "business_address_compact", 3000),
    Block("sorted_name", "business_name_sorted_tokens", 1000),
    Block("name_prefix6", "business_name_compact", 500, 6),
    Block("name_prefix4", "business_name_compact", 250, 4),
    Block("numeric_address", "business_address_numeric_tokens", 300),
)

PAIR = ["source1_entity_id", "candidate_entity_id"]
KEY = ["block", "k1", "k2"]
#: At most so many of the most frequent keys over their cap travel to the rows; any other key has at most 1 / MAX_HOT of them.
MAX_HOT = 10_000
#: About so many pairs of a key come out in one task at most.
CELL = 500_000


def block_keys(normalized: DataFrame) -> DataFrame:
    """``entity_id`` and a key column for each block."""
    require_columns(normalized, "entity_id", *(b.column for b in BLOCKS))
    return normalized.select("entity_id", *(b.key.alias(b.name) for b in BLOCKS))


def _within_cap(rows: DataFrame, key: list[str], cap: Column) -> DataFrame:
    """The rows whose key, which is never null, is shared by at most ``cap`` of them.

    Counts combine map-side. The most frequent keys over the cap are dropped where their rows are read, by a
    broadcast of bounded size, so that no hot key's rows meet in one task; a semi join drops the rest.
    """
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > cap).orderBy(F.desc("__n"), *key).limit(MAX_HOT).select(*key)
    accepted = counts.where(F.col("__n") <= cap).select(*key)
    return rows.join(F.broadcast(hot), key, "left_anti").join(accepted, key, "left_semi")


def size_filter(df: DataFrame, key: str, cap: int) -> DataFrame:
    """The rows whose key is neither null nor empty and is shared by at most ``cap`` rows."""
    keyed = df.where(F.col(key).isNotNull() & (F.length(key) > 0))
    return _within_cap(keyed, [key], F.lit(cap))


def block_pairs(s1_keys: DataFrame, target_keys: DataFrame, block: str, cap: int) -> DataFrame:
    """``(source1_entity_id, candidate_entity_id, block_name)`` of one block."""
    left = size_filter(s1_keys.select(F.col("entity_id").alias(PAIR[0]), block), block, cap)
    right = size_filter(target_keys.select(F.col("entity_id").alias(PAIR[1]), block), block, cap)
    return left.join(right, block).where(F.col(PAIR[0]) != F.col(PAIR[1])).select(*PAIR, F.lit(block).alias("block_name"))


def _long(normalized: DataFrame, name: str, caps: dict[str, int]) -> DataFrame:
    """``(block, key, name)`` of all blocks from one pass; keys that are null, empty or over the cap are out.

    Keys travel as 128 bits of hash, whatever their length.
    """
    keyed = block_keys(normalized)
    each = F.array(*(F.struct(F.lit(k).alias("block"), F.col(b.name).alias("text")) for k, b in enumerate(BLOCKS)))
    rows = keyed.select(F.col("entity_id").alias(name), F.explode(each).alias("e")).where(F.col("e.text").isNotNull() & (F.length("e.text") > 0))
    rows = rows.select(name, "e.block", F.xxhash64("e.text").alias("k1"), F.xxhash64(F.lit("2"), "e.text").alias("k2"))
    cap = F.element_at(F.array(*(F.lit(caps.get(b.name, b.cap)) for b in BLOCKS)), F.col("block") + 1)
    return _within_cap(rows, KEY, cap)


def raw_pairs(s1: DataFrame, target: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """The pairs of all blocks, one row for each block that found a pair."""
    names = F.array(*(F.lit(b.name) for b in BLOCKS))
    pairs = _long(s1, PAIR[0], caps or {}).join(_long(target, PAIR[1], caps or {}), KEY).where(F.col(PAIR[0]) != F.col(PAIR[1]))
    return pairs.select(*PAIR, F.element_at(names, F.col("block") + 1).alias("block_name"))


def candidates(s1: DataFrame, target: DataFrame, source: str, caps: dict[str, int] | None = None) -> DataFrame:
    """``(ids, candidate_source, block_support_count, blocks)``, a row per pair; blocks sorted."""
    blocks = F.array_sort(F.collect_set("block_name"))
    grouped = raw_pairs(s1, target, caps).groupBy(*PAIR).agg(blocks.alias("blocks"))
    return grouped.select(*PAIR, F.lit(source).alias("candidate_source"), F.size("blocks").alias("block_support_count"), "blocks")


def candidate_stats(s1: DataFrame, target: DataFrame, source: str, caps: dict[str, int] | None = None) -> DataFrame:
    """A row per block with its raw pairs, and one named ``total`` with raw and distinct pairs and the share that went."""
    by_block = [F.count_if(F.col("block_name") == b.name).alias(b.name) for b in BLOCKS]
    pairs = raw_pairs(s1, target, caps).groupBy(*PAIR).agg(*by_block)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = pairs.agg(F.count(F.lit(1)).alias("distinct"), *(zero(b.name).alias(b.name) for b in BLOCKS))
    raw, none = sum(F.col(b.name) for b in BLOCKS), F.lit(None)
    share = F.when(raw > 0, F.round(100.0 * (raw - F.col("distinct")) / raw, 6)).otherwise(0.0)
    row = lambda name, n, d, s: F.struct(F.lit(name).alias("block_name"), n.cast("long").alias("raw_pairs"), d.cast("long").alias("distinct_pairs"), s.cast("double").alias("reduction_percent"))
    rows = [*(row(b.name, F.col(b.name), none, none) for b in BLOCKS), row("total", raw, F.col("distinct"), share)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(source).alias("candidate_source"), "r.*")


#: The order in which a pair's blocks are looked at.
WIDEST = ("name_prefix4", "name_prefix6", "exact_name", "sorted_name", "exact_address", "numeric_address")
_WIDER = [f"w{j}" for j in range(len(WIDEST) - 1)]
_PLACE = 60  # bits below a block's place in a key's first half


def keyed(normalized: DataFrame, *carried: Column | str) -> DataFrame:
    """``entity_id``, ``carried`` and ``keys``: 124 bits of hash for each key that is neither null nor empty.

    A key is ``a``, whose upper bits are the block's place in ``WIDEST``, and ``b``; ``w0`` to ``w4`` are the row's ``a`` in the blocks before.
    """
    require_columns(normalized, "entity_id", *(b.column for b in BLOCKS))
    text = [next(b.key for b in BLOCKS if b.name == name) for name in WIDEST]
    first = [F.lit(k << _PLACE).bitwiseOR(F.shiftrightunsigned(F.xxhash64(t), 64 - _PLACE)) for k, t in enumerate(text)]
    wider = lambda k, j: (F.when(F.length(text[j]) > 0, first[j]) if j < k else F.lit(None).cast("long")).alias(_WIDER[j])
    each = [F.when(F.length(t) > 0, F.struct(first[k].alias("a"), F.xxhash64(F.lit("2"), t).alias("b"), *(wider(k, j) for j in range(len(_WIDER))))) for k, t in enumerate(text)]
    return normalized.select("entity_id", *carried, F.array_compact(F.array(*each)).alias("keys"))


def links(rows: DataFrame, targets: dict[int, str], caps: dict[str, int] | None = None) -> DataFrame:
    """``(entity_id, n, ks, found<target>...)``: where an entity travels, and its keys that are used for a target.

    rows, targets: as for ``linked_pairs``. ``ks`` has a key's halves and ``g``: a key of more than ``CELL`` pairs is dealt out over g by g cells.
    """
    caps = {b.name: b.cap for b in BLOCKS} | (caps or {})
    cap = F.element_at(F.array(*(F.lit(caps[name]) for name in WIDEST)), F.shiftright("a", _PLACE).cast("int") + 1)
    each = rows.where(F.col("n").isin(1, *targets)).select("entity_id", "n", F.inline("keys"))
    counts = each.groupBy("a", "b").agg(*(F.count_if(F.col("n") == i).alias(f"c{i}") for i in (1, *targets)), *(F.when((F.min(w) == F.max(w)) & (F.count(w) == F.count(F.lit(1))), F.min(w)).alias(w) for w in _WIDER)).withColumn("cap", cap)
    by_side = counts.select("a", "b", "cap", F.inline(F.array(*(F.struct(F.lit(i).alias("n"), F.col(f"c{i}").alias("c")) for i in (1, *targets)))))
    hot = by_side.where(F.col("c") > F.col("cap")).orderBy(F.desc("c"), "a", "b", "n").limit(MAX_HOT).select("a", "b", "n")
    fits = lambda i: F.col(f"c{i}").between(1, F.col("cap"))
    made = F.col("c1") * sum(F.when(fits(t), F.col(f"c{t}")).otherwise(0) for t in targets)
    cells = F.greatest(F.lit(1), F.ceil(F.sqrt(made / CELL))).cast("int").alias("g")
    used = counts.where(fits(1)).select("a", "b", *_WIDER, cells, *(fits(t).alias(f"u{t}") for t in targets)).where(" or ".join(f"u{t}" for t in targets))
    own = (F.col("n") == 1) | F.coalesce(*(F.when(F.col("n") == t, F.col(f"u{t}")) for t in targets))
    met = each.drop(*_WIDER).join(F.broadcast(hot), ["a", "b", "n"], "left_anti").join(used, ["a", "b"]).where(own)
    ids = met.groupBy("entity_id", "n").agg(F.array_sort(F.collect_set(F.struct("a", "b", "g", *_WIDER, *(f"u{t}" for t in targets)))).alias("ks"))
    # What is used for a target, and of that what lies in no earlier key that is used for it.
    found = lambda t: F.transform(F.filter("ks", lambda k: k[f"u{t}"]), lambda k: k["a"]).alias(f"found{t}")
    ids = ids.select("entity_id", "n", "ks", *map(found, targets))
    held = lambda k, t: F.exists(F.array_compact(F.array(*(k[w] for w in _WIDER))), lambda w: F.array_contains(f"found{t}", w))
    sent = lambda k: F.exists(F.array(*(k[f"u{t}"] & ~held(k, t) for t in targets)), lambda x: x)
    return ids.withColumn("ks", F.transform(F.filter("ks", sent), lambda k: F.struct(*(k[c].alias(c) for c in ("a", "b", "g")))))


def linked_pairs(rows: DataFrame, targets: dict[int, str], carried: list[str], caps: dict[str, int] | None = None, linked: DataFrame | None = None) -> DataFrame:
    """``(ids, candidate_source, block_support_count)`` and ``carried`` of both sides, prefixed ``s1_`` and ``s2_``: the pairs of ``candidates``.

    rows: those of ``keyed`` with ``n``, 1 for the first source; targets: the other sources' numbers and names. Where ids repeat, a pair
    comes once for each two rows of its ids. Entities travel once for each used key (and cell of it), but for those all of whose rows share
    an earlier used key; pairs do not travel. linked: ``links`` of the rows, if it is at hand; rows then need no keys.
    """
    ids = links(rows, targets, caps) if linked is None else linked
    sides = rows.where(F.col("n").isin(1, *targets)).select("entity_id", "n", *carried).join(ids, ["entity_id", "n"])
    place = lambda k: F.pmod(F.xxhash64("entity_id"), k["g"]).cast("int")
    cell = lambda k, x, first: place(k) * k["g"] + x if first else x * k["g"] + place(k)
    dealt = lambda first: F.inline(F.flatten(F.transform("ks", lambda k: F.transform(F.sequence(F.lit(0), k["g"] - 1), lambda x: F.struct(k["a"].alias("a"), k["b"].alias("b"), cell(k, x, first).alias("cell"))))))
    mine = F.coalesce(*(F.when(F.col("n") == t, F.col(f"found{t}")) for t in targets))
    one = sides.where("n = 1").select(F.col("entity_id").alias(PAIR[0]), *(f"found{t}" for t in targets), *(F.col(c).alias(f"s1_{c}") for c in carried), dealt(True))
    other = sides.where("n <> 1").select(F.col("entity_id").alias(PAIR[1]), "n", mine.alias("found"), *(F.col(c).alias(f"s2_{c}") for c in carried), dealt(False))
    theirs = F.coalesce(*(F.when(F.col("n") == t, F.col(f"found{t}")) for t in targets))
    pairs = one.join(other, ["a", "b", "cell"]).where(F.col(PAIR[0]) != F.col(PAIR[1])).withColumn("common", F.array_intersect(theirs, "found")).where(F.get("common", F.lit(0)) == F.col("a"))
    support = F.size(F.array_distinct(F.transform("common", lambda a: F.shiftright(a, _PLACE))))
    name = F.coalesce(*(F.when(F.col("n") == t, F.lit(s)) for t, s in targets.items()))
    return pairs.select(*PAIR, name.alias("candidate_source"), support.alias("block_support_count"), *(f"{p}_{c}" for p in ("s1", "s2") for c in carried))
