"""The linkage data model over the documents table.

Documents stand in for listings: the feed that a document's ``source`` names
belongs to one of three sources by its number, the text up to the first full stop
or line end is the name, and all the rest, between length and language, the
address. Documents of the first source truly match those of the others whose whole
text is the same after compaction.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.functions import text as T
from rillwork.operators.blocking import keyed
from rillwork.operators.features import facts
from rillwork.operators.normalize import normalize_source
from rillwork.sources.files import spread
from rillwork.sources.staging import staged


def source_number() -> Column:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", 1).otherwise(number.cast("int") % 3 + 1)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(entity_id, business_name, business_address, country, n)`` of all documents; n is the source's number."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars"))
    name = F.regexp_extract("text", "^[^.\\n]*", 0)
    rows = docs.withColumn("business_name", name).withColumn("__rest", F.expr("substring(text, length(business_name) + 1)")).withColumn("n", source_number())
    address = F.when(F.col("__rest") != "", F.concat_ws(" ", F.col("n_chars").cast("string"), "__rest", "lang"))
    return rows.select(
        F.concat(F.lit("S"), F.col("n").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        "business_name",
        address.alias("business_address"),
        F.col("lang").alias("country"),
        "n",
    )


#: Tables that the query being built has staged; None outside queries.
_open: dict[tuple, DataFrame] | None = None


def one_query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``f``, within which ``once`` stages a table a single time. Nothing is kept from one query to the next."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        global _open
        outer = _open
        if outer is None:
            _open = {}
        try:
            return f(spark, sf_dir)
        finally:
            _open = outer

    return run


def once(build: Callable[[], DataFrame], *key: object) -> DataFrame:
    """The table that ``build`` gives, staged at its first use in a query."""
    if _open is None:
        return build()
    if key not in _open:
        _open[key] = staged(build(), str(key[0]))
    return _open[key]


def source(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return entities(spark, sf_dir).where(F.col("n") == n).drop("n")


def normalized(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """All sources are normalised in one pass; within a query, once."""
    return once(lambda: normalize_source(entities(spark, sf_dir)), "normalized", sf_dir).where(F.col("n") == n).drop("n")


def linkable(spark: SparkSession, sf_dir: str, wanted: list[str]) -> DataFrame:
    """Ids, sources' numbers, hashed block keys and the facts of the ``wanted`` features; within a query, staged once."""
    build = lambda: keyed(normalize_source(entities(spark, sf_dir)), "n", *facts(wanted))
    return once(build, "linkable", sf_dir, tuple(wanted))


def gathered(spark: SparkSession, sf_dir: str, wanted: list[str]) -> DataFrame:
    """``linkable`` with a row per entity: the facts of one of its rows, and where its id repeats, those of all of them as ``rows``."""

    def build() -> DataFrame:
        each = keyed(normalize_source(entities(spark, sf_dir)), "n", *facts(wanted))
        carried = [c for c in each.columns if c not in ("entity_id", "n", "keys")]
        one = each.groupBy("entity_id", "n").agg(F.flatten(F.collect_list("keys")).alias("keys"), F.collect_list(F.struct(*carried)).alias("rows"))
        return one.select("entity_id", "n", "keys", *(F.col("rows")[0][c].alias(c) for c in carried), F.when(F.size("rows") > 1, F.col("rows")).alias("rows"))

    return once(build, "gathered", sf_dir, tuple(wanted))


def whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(n, id, h)``: the hash of each document's whole text; null for none."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    whole = T.compact(T.casefolded(F.col("text")))
    rows = docs.withColumn("n", source_number()).select("n", F.concat(F.lit("S"), F.col("n").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("id"), whole.alias("whole"))
    return rows.select("n", "id", F.when(F.col("whole") != "", F.md5(F.col("whole").cast("binary"))).alias("h"))


def true_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(entity_id, n, truth)``: two entities truly match if their arrays ``truth`` share a hash. Staged once in a query."""
    build = lambda: whole_texts(spark, sf_dir).groupBy(F.col("id").alias("entity_id"), "n").agg(F.collect_set("h").alias("truth"))
    return once(build, "truth", sf_dir)


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source1_entity_id, matched_entity_ids)``, a row per entity of source 1; null for no match."""
    keyed = whole_texts(spark, sf_dir)
    lists = keyed.where("n <> 1").groupBy("h").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("matched_entity_ids"))
    return keyed.where("n = 1").join(lists, "h", "left").select(F.col("id").alias("source1_entity_id"), "matched_entity_ids")
