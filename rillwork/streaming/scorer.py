"""Scoring of candidate pairs as they arrive: stream-static joins, no state.

The batch operators are used as they are; the normalised sources are static tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillwork.operators.blocking import PAIR
from rillwork.operators.features import pair_features
from rillwork.operators.scoring import THRESHOLD, accepted, linear_score
from rillwork.sources.schemas import require_columns


def score_stream(pairs: DataFrame, s1: DataFrame, target: DataFrame, score: Callable[[DataFrame], DataFrame] = linear_score, threshold: float = THRESHOLD) -> DataFrame:
    """``(ids, candidate_source, match_probability)`` of the accepted pairs of a stream (or a table)."""
    require_columns(pairs, *PAIR, "candidate_source", "block_support_count")
    scored = score(pair_features(pairs.select(*PAIR, "candidate_source", "block_support_count"), s1, target))
    return accepted(scored, threshold).select(*PAIR, "candidate_source", "match_probability")


def write_stream(scored: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to Parquet, exactly once by the checkpoint; ``once`` takes what is there and ends."""
    writer = scored.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
