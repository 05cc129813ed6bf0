"""Blocking of a stream of new query entities against static, capped target postings (a stateless stream-static join)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import blocking as B
from tessera.operators.keys import normalize, postings


def stream_candidates(entities: DataFrame, target_index: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, m: int = B.TOP_M) -> StreamingQuery:
    """Candidates of every micro-batch of a stream of entities; the top m are taken per batch, where an entity is whole."""

    def batch(df: DataFrame, epoch: int) -> None:
        probed = B.probe(postings(normalize(df)), target_index)
        write(B.exact_pairs(probed).union(B.top_m(B.token_scores(probed), m).select("s1", "tgt")).distinct(), epoch)

    return entities.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
