"""Late rows of a stream: what is behind the watermark is kept apart, and no row is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotwise.operators.mart import INTRADAY_SUMS
from slotwise.sources.stages import new_stage
from slotwise.streaming import intraday

START = dt.datetime(2024, 1, 10, 8, 0)
#: Minutes after START of the rows of each micro-batch; the watermark is the newest minute of earlier batches minus 120.
BATCHES = [[0, 10, 40], [200, 215], [30, 100, 190], [600], [479, 480, 599, -500]]
LATE = [30, 479, -500]


def events(spark, minutes):
    cols = sorted(set(INTRADAY_SUMS.values()))
    rows = [(START + dt.timedelta(minutes=m), 900001, 7, *[m + 1000 + k for k in range(len(cols))]) for m in minutes]
    return spark.createDataFrame(rows, "ts timestamp, program_id int, channel_id int, " + ", ".join(f"`{c}` long" for c in cols))


@pytest.fixture(scope="module")
def stored(spark):
    source, path, checkpoint = (new_stage(spark, n) for n in ("in", "slots", "ckpt"))
    for k, minutes in enumerate(BATCHES):
        frame = events(spark, minutes)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        intraday.write_slots(stream, path, checkpoint).awaitTermination()
    return path


def sums(spark, minutes):
    rows = events(spark, minutes).withColumn("start", F.window("ts", "30 minutes")["start"])
    out = rows.groupBy(F.to_date("start").alias("ref_date"), (F.hour("start") * 60 + F.minute("start")).alias("slot"), "program_id", "channel_id")
    return sorted(map(tuple, out.agg(*[F.sum(c).alias(n) for n, c in INTRADAY_SUMS.items()]).collect()))


def test_late_rows_are_merged(spark, stored):
    assert sorted(map(tuple, intraday.read_slots(spark, stored).collect())) == sums(spark, sum(BATCHES, []))


def test_rows_behind_the_watermark_are_apart(spark, stored):
    assert sorted(map(tuple, intraday.read_slots(spark, stored, late=True).collect())) == sums(spark, LATE)
    on_time = [m for m in sum(BATCHES, []) if m not in LATE]
    assert sorted(map(tuple, intraday.read_slots(spark, stored, late=False).collect())) == sums(spark, on_time)


def test_watermark_follows_earlier_batches_only(spark, stored):
    two_hours = dt.timedelta(hours=2)
    assert intraday.closed_until(spark, stored, 0, two_hours) is None
    assert intraday.closed_until(spark, stored, 1, two_hours) == START + dt.timedelta(minutes=40) - two_hours
    assert intraday.closed_until(spark, stored, 4, two_hours) == START + dt.timedelta(minutes=600) - two_hours


def test_state_store_form_drops_late_rows(spark):
    """The aggregate with a watermark in Spark's state store stays for streams in order; it does lose what is late."""
    source, path, checkpoint = (new_stage(spark, n) for n in ("in", "slots", "ckpt"))
    for minutes in BATCHES[:4] + [[0]]:
        frame = events(spark, minutes)
        frame.coalesce(1).write.mode("append").parquet(source)
        agg = intraday.stream_intraday_agg(spark.readStream.schema(frame.schema).parquet(source))
        intraday.write_updates(agg, path, checkpoint).awaitTermination()
    got = sorted(map(tuple, intraday.read_updates(spark, path).collect()))
    assert got != sums(spark, sum(BATCHES[:4], [0]))
