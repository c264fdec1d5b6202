"""Streaming twins: run to completion over the available files, then read the result."""

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import mart as mart_ops
from slotwise.sources import demo, forecast
from slotwise.sources.stages import new_stage, stage_sink
from slotwise.streaming import intraday
from slotwise.streaming.forecast import stream_rolling_overwrite
from verification import inputs as i
from verification.registry import check
from verification.sqltext import D

K = i.KEYS


@check("stream_intraday_agg", f"{K} {' '.join(mart_ops.INTRADAY_SUMS)}:bigint", ["actual"], "SELECT * FROM actual")
def _(s, d):
    schema = demo.table(s, d, "events").schema
    events = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    rows = s.sql(demo.INTRADAY_SQL.replace("SELECT event_id,", "SELECT event_id, cast(ts AS timestamp) AS event_time,").replace("FROM events", "FROM {events}"),
                 events=events)
    path = new_stage(s, "stream-actual")
    q = intraday.write_updates(intraday.stream_intraday_agg(rows, "event_time"), path, new_stage(s, "stream-ckpt"))
    q.awaitTermination()
    return intraday.since_days(intraday.read_updates(s, path), i.AS_OF)


@check("stream_late_rows", f"{K} {' '.join(mart_ops.INTRADAY_SUMS)}:bigint", ["actual"], "SELECT * FROM actual")
def _(s, d):
    """The events in twelve micro-batches without order in time: most batches hold rows behind the watermark."""
    source, path = new_stage(s, "stream-events"), new_stage(s, "stream-slots")
    events = demo.table(s, d, "events")
    events.repartition(12, "event_id").write.parquet(source)
    stream = s.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rows = s.sql(demo.INTRADAY_SQL.replace("SELECT event_id,", "SELECT event_id, cast(ts AS timestamp) AS event_time,").replace("FROM events", "FROM {events}"),
                 events=stream)
    intraday.write_slots(rows, path, new_stage(s, "stream-ckpt"), "event_time").awaitTermination()
    return intraday.since_days(intraday.read_slots(s, path), i.AS_OF)


@check("stream_rolling_overwrite", f"{K} sl_pred:double", ["mart"], f"""
WITH f AS (SELECT ref_date, slot, program_id, channel_id, sl_plan AS sl_pred FROM mart WHERE vol_plan > 0),
b AS (SELECT ref_date, slot, program_id, channel_id, 0.5 AS sl_pred FROM mart WHERE vol_plan > 1 AND slot >= 480)
SELECT f.* FROM f LEFT JOIN (SELECT ref_date, min(slot) AS m FROM b GROUP BY 1) AS x USING (ref_date) WHERE m IS NULL OR f.slot < m
UNION ALL SELECT * FROM b""")
def _(s, d):
    m = i.mart(s, d)
    path, source = new_stage(s, "forecast"), new_stage(s, "forecast-in")
    before = m.where(F.col("vol_plan") > 0).select(
        *catalog.KEYS, F.col("sl_plan").alias("sl_pred"))
    forecast.publish(s, path, before)
    batch = m.where((F.col("vol_plan") > 1) & (F.col("slot") >= 480)).select(
        *catalog.KEYS, F.lit(0.5).cast("double").alias("sl_pred"))
    stage_sink(batch, source)
    for _attempt in range(2):  # the second run has a new checkpoint: the same batch is delivered again
        stream = s.readStream.schema(batch.schema).parquet(source)
        stream_rolling_overwrite(stream, path, new_stage(s, "forecast-ckpt")).awaitTermination()
    return forecast.read_forecast(s, path, batch.schema)
