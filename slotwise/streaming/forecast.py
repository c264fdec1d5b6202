"""Rolling overwrite of the forecast table, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from slotwise.sources.forecast import publish


def stream_rolling_overwrite(
    batches: DataFrame, path: str, checkpoint: str, scope: str = "date"
) -> StreamingQuery:
    """Publish every micro-batch; publishing a batch again changes nothing, so a retry is safe."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            publish(batch.sparkSession, path, batch, scope)

    return (
        batches.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
