"""A training-corpus pipeline over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it
keeps, all columns; the last adds the mixture's columns. ``run`` writes each stage's
rows as Parquet in the shared folder, reads them again for the next and deletes what a stage no longer needs.

In every stage null texts count as empty ones, an empty table gives an empty table, and columns beyond
``doc_id``, ``text``, ``lang`` and ``source`` pass through whatever their names. Rows that repeat an id and its text: see each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillwork.llm.common import mark, materialize, release, table
from rillwork.llm.decontaminate import drop_contaminated
from rillwork.llm.exact_dedup import drop_exact_copies
from rillwork.llm.langid import keep_identified
from rillwork.llm.minhash_dedup import drop_near_copies
from rillwork.llm.mixing import mixed_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; those without letters (``und``) go. Rows that repeat stay or go together."""
    return keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id, once if rows repeat it; of equal texts without any id, all."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a similarity of 0.8 or more on five-word shingles, one document, once if rows repeat it; texts without words stay."""
    return drop_near_copies(docs, shingle_words=5, percent=80)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in 13-word windows of the benchmark. Rows that repeat stay or go together."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13, min_share=20)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, once for each epoch; rows that repeat count one by one."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("contaminated", contaminated),
    ("mixture", mixture),
]

#: The first stage is a trained network and the third a search by signatures, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    begin = mark()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(spark, begin, keep=docs)
    return docs
