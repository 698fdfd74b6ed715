"""Starting a stream as a bounded batch or as a continuous job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from medstrata.config import STREAM_INTERVAL, check_mode

BatchFunction = Callable[[DataFrame, int], None]


def trigger_of(mode: str) -> dict:
    """``batch`` takes everything available and ends; ``stream`` keeps running."""
    return {"availableNow": True} if check_mode(mode) == "batch" else {"processingTime": STREAM_INTERVAL}


def run_stream(
    stream: DataFrame, on_batch: BatchFunction, checkpoint: str, mode: str = "batch"
) -> StreamingQuery:
    """Start ``on_batch`` over the stream; a batch run has ended on return."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(mode))
        .start()
    )
    if mode == "batch":
        query.awaitTermination()
    return query
