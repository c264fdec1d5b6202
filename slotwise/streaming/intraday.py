"""Intraday aggregate over an event stream."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators.mart import INTRADAY_SUMS
from slotwise.sources.stages import staged


def stream_intraday_agg(events: DataFrame, ts: str = "ts", delay: str = "2 hours") -> DataFrame:
    """Event-time 30-minute sums per program and channel, with a watermark.

    Windows start on the half hour, so their key equals the batch slot.
    """
    grouped = (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, "30 minutes"), "program_id", "channel_id")
        .agg(*[F.sum(src).alias(name) for name, src in INTRADAY_SUMS.items()])
    )
    start = F.col("window.start")
    return grouped.select(
        F.to_date(start).alias("ref_date"),
        (F.hour(start) * 60 + F.minute(start)).alias("slot"),
        "program_id",
        "channel_id",
        *INTRADAY_SUMS,
    )


def write_updates(agg: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Update mode: every micro-batch stores the slots it changed.

    A batch owns one folder and overwrites it, so a retried batch leaves the
    same rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        agg.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """Current state: the newest version of every slot."""
    keys = ["ref_date", "slot", "program_id", "channel_id"]
    rows = spark.read.parquet(path)
    newest = F.struct("batch_id", *INTRADAY_SUMS)
    return rows.groupBy(*keys).agg(F.max(newest).alias("v")).select(*keys, *[f"v.{c}" for c in INTRADAY_SUMS])


def write_slots(
    events: DataFrame, path: str, checkpoint: str, ts: str = "ts", delay: dt.timedelta = dt.timedelta(hours=2),
) -> StreamingQuery:
    """Slot sums of a stream that loses no row, however late.

    All measures are sums, so every micro-batch stores the sums of its own rows, and no state is kept. Rows behind the
    watermark (the newest event time of earlier batches minus `delay`) are stored apart, under late/, where a reader
    sees which slots changed after they were closed. A batch owns its folders and overwrites them: a retry leaves the same.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        edge = closed_until(spark, path, batch_id, delay)
        late = F.lit(False) if edge is None else F.col(ts) < F.lit(edge)
        rows = batch.withColumns({"_start": F.window(ts, "30 minutes")["start"], "_late": F.coalesce(late, F.lit(False))})
        sums = rows.groupBy("_late", "_start", "program_id", "channel_id").agg(
            *[F.sum(src).alias(name) for name, src in INTRADAY_SUMS.items()], F.max(ts).alias("newest"))
        sums = staged(sums, "slots")
        slot = F.hour("_start") * 60 + F.minute("_start")
        for name, wanted in (("slots", False), ("late", True)):
            part = sums.where(F.col("_late") == wanted)
            part = part.select(F.to_date("_start").alias("ref_date"), slot.alias("slot"), "program_id", "channel_id", *INTRADAY_SUMS)
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        sums.agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")

    return events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_until(spark: SparkSession, path: str, batch_id: int, delay: dt.timedelta) -> dt.datetime | None:
    """Watermark of a batch; None before any event. One row for each earlier batch is read."""
    if batch_id == 0:
        return None
    newest = spark.read.schema("newest timestamp, batch_id long").parquet(f"{path}/newest")
    found = newest.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
    return None if found is None else found - delay


def read_slots(spark: SparkSession, path: str, late: bool | None = None) -> DataFrame:
    """Slot sums so far; with `late`, only those of rows behind the watermark, or only the others."""
    names = ["slots", "late"] if late is None else ["late" if late else "slots"]
    keys = ["ref_date", "slot", "program_id", "channel_id"]
    parts = [spark.read.option("recursiveFileLookup", True).parquet(f"{path}/{n}") for n in names]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in INTRADAY_SUMS])


def since_days(df: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    return df.where(F.col("ref_date") >= F.lit(as_of.date() - dt.timedelta(days=days)))
