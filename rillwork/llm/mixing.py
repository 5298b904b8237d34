"""Mixing sources to target weights by hierarchical budgeting.

A tree of domain, language and source has the corpus's tokens at its leaves.
A token budget is handed down from the root: siblings share their
parent's budget by weight, no node gets more than its subtree can supply (its
tokens times ``max_epochs``), and what one cannot use goes to its siblings
in proportion to their weights before anything is left to the parent's
siblings. With capacities summed up the tree first, one pass down does this:
among siblings in order of capacity per weight, the ones that fill
up are a prefix, and prefix sums give the common level of the rest.

A leaf's budget buys whole epochs and then a prefix of one more epoch, whose
order is the MD5 of seed, epoch and document. Prefix sums over a hot leaf
never meet in one task: the order's first ``HEX`` hexadecimal digits deal a leaf's
documents to 16^HEX buckets, sums of buckets find the one where the prefix ends, and
only inside a bucket are single documents ranked.

All of it is DataFrame and SQL functions.

Defined results: a null level value is a node named ``(none)``; null and empty texts
have no tokens and come with their bucket's order; a weight of 0 or less gives
nothing; a budget beyond all capacity takes ``max_epochs`` of everything; rows
that repeat are documents of their own; ties in the order go by id and text
hash; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillwork.llm.common import materialize, unused

HEX = 3
BROADCAST_LEAVES = 2_000
_TOKEN = "[^ \\t-\\r]+"


def weight_of(column: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(column == name, w).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget``: the part of ``parent_budget`` that each of the siblings gets. Needs capacity and weight."""
    order = [(F.col("capacity") / F.col("weight")).asc(), *(F.col(c).asc() for c in nodes.columns if c not in ("capacity", "weight", "parent_budget"))]
    siblings = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    before = siblings.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    after = siblings.orderBy(*order).rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(after)
    fair = F.floor(F.col("weight") * F.max("__level").over(siblings)).cast("long")
    return nodes.withColumn("__level", level.cast("double")).withColumn("budget", F.greatest(F.lit(0), F.least("capacity", fair))).drop("__level", "parent_budget")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[Column], budget: int, max_epochs: int) -> DataFrame:
    """``(*levels, tokens, budget)``: the token budget of each leaf of ``leaves(*levels, tokens)``.

    weights: of the nodes of each level, as integer columns over that level's path.
    """
    above = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("capacity")).withColumn("weight", weights[depth - 1])
        nodes = nodes.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)).withColumn("weight", F.greatest("weight", F.lit(1)))
        if above is None:
            nodes = nodes.withColumn("parent_budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(above, path[:-1])
        shared = _share(nodes, path[:-1])
        above = shared.select(*path, F.col("budget").alias("parent_budget"))
    return leaves.join(above.withColumnRenamed("parent_budget", "budget"), levels)


def select_mixture(docs: DataFrame, levels: dict[str, Column], weights: list[Column], budget_share: float, max_epochs: int, seed: int) -> DataFrame:
    """``(doc_id, __th, *levels, n_tokens, epoch)``: a row for each time a document is taken, epochs from 0.

    levels: the tree's level names, from the top, with the columns that give them.
    budget_share: the token budget as a share of all tokens.
    """
    names = list(levels)
    named = [F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in levels.items()]
    rows = docs.select("doc_id", F.xxhash64("text").alias("__th"), *named, F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(_TOKEN)).cast("long").alias("n_tokens"))
    rows = materialize(rows, "tokens")
    leaves = materialize(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    size = leaves.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    plan = leaf_budgets(leaves, names, weights, int(size["tokens"] * budget_share), max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    plan = plan.withColumn("__whole", whole).withColumn("__rest", F.col("budget") - F.col("__whole") * F.col("tokens")).drop("tokens", "budget")
    plan = materialize(plan, "plan")
    # Few leaves travel to the documents; many meet them in a shuffle, where the skew-join rule deals out hot leaves.
    placed = rows.join(F.broadcast(plan) if size["n"] <= BROADCAST_LEAVES else plan, names)

    full = placed.where("__whole > 0").select("doc_id", "__th", *names, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("__whole") - 1)).alias("epoch"))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("__whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    last = placed.where("__rest > 0").withColumn("__order", order).withColumn("__bucket", F.substring("__order", 1, HEX))
    sums = last.groupBy(*names, "__bucket").agg(F.sum("n_tokens").alias("__tokens"))
    running = W.partitionBy(*names).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__tokens").over(running), F.lit(0))).drop("__tokens")
    ranked = W.partitionBy(*names, "__bucket").orderBy("__order", "doc_id", "__th").rowsBetween(W.unboundedPreceding, W.currentRow)
    prefix = last.join(sums, [*names, "__bucket"]).where(F.col("__before") <= F.col("__rest")).withColumn("__sum", F.col("__before") + F.sum("n_tokens").over(ranked))
    prefix = prefix.where(F.col("__sum") <= F.col("__rest")).select("doc_id", "__th", *names, "n_tokens", F.col("__whole").alias("epoch"))
    return full.unionByName(prefix)


#: Production parameters of the registered query and of the pipeline: the tree and its weights.
DOMAINS = {"web": 4, "books": 3, "forums": 2, "news": 1}
LANGS = {"en": 5, "de": 2, "fr": 2, "es": 1}
BUDGET_SHARE = 0.6
MAX_EPOCHS = 2
SEED = 17


def domain_of(source: Column) -> Column:
    """The domain that a source's number falls to: 0-4 web, 5-9 books, 10-14 forums, others news; no number: null."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    group = F.floor(F.when(number != "", number.cast("int")) / 5)
    return F.when(group == 0, "web").when(group == 1, "books").when(group == 2, "forums").when(group.isNotNull(), "news")


def _levels() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def production_mixture(docs: DataFrame) -> DataFrame:
    weights = [weight_of(F.col("domain"), DOMAINS, 1), weight_of(F.col("lang"), LANGS, 1), F.lit(1).cast("long")]
    return select_mixture(docs, _levels(), weights, BUDGET_SHARE, MAX_EPOCHS, SEED)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the production mixture takes, all columns, with ``mix_domain``, ``mix_tokens`` and ``mix_epoch``.

    Rows that repeat id, text, language and source are numbered, and as many of them come as the mixture takes.
    Columns of ``docs`` that have the names of the added ones give way to them.
    """
    columns = [c for c in docs.columns if c.lower() not in ("mix_domain", "mix_tokens", "mix_epoch")]
    docs = docs.select(*(F.col(f"`{c}`") for c in columns))
    names = ["id", "th", "domain", "lang", "source", "number"]
    own = unused(docs, *(f"__{n}" for n in names))
    identity = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text"), *(F.coalesce(c.cast("string"), F.lit("(none)")) for c in _levels().values())]
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(identity, own)))
    keyed = keyed.withColumn(own[5], F.row_number().over(W.partitionBy(*own[:5]).orderBy(F.lit(0))))
    taken = production_mixture(docs)
    alike = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__th"), F.col("domain"), F.col("lang"), F.col("source")]
    taken = taken.select(*(c.alias(n) for c, n in zip(alike, own)), F.col("n_tokens").alias("mix_tokens"), F.col("epoch").alias("mix_epoch"))
    taken = taken.groupBy(*own[:5], "mix_tokens", "mix_epoch").agg(F.count(F.lit(1)).alias("mix_copies"))
    clash = unused(docs, "mix_copies")[0]
    out = keyed.join(taken.withColumnRenamed("mix_copies", clash), own[:5]).where(F.col(own[5]) <= F.col(clash))
    return out.select(*(F.col(f"`{c}`") for c in columns), F.col(own[2]).alias("mix_domain"), "mix_tokens", "mix_epoch")
