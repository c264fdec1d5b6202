import datetime as dt

import pytest
from pyspark.sql import functions as F

from slotwise.functions import clock, numbers, suffix
from slotwise.operators import cleaning, columns, windows
from slotwise.operators.reports import slot_end


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("minute,slot", [(0, 0), (430, 420), (449, 420), (450, 450), (479, 450), (1439, 1410)])
def test_slot_floor(spark, minute, slot):
    assert one(spark, clock.slot_floor("m"), m=minute) == slot


def test_clock_text(spark):
    assert one(spark, clock.minute_of_day("t"), t="07:40:00.0000000") == 460
    assert one(spark, clock.minute_of_day("t"), t="late") is None


def test_parse_slot_timestamp_bad_text_is_null(spark):
    d = dt.date(2024, 1, 5)
    assert one(spark, clock.parse_slot_timestamp("d", "t"), d=d, t="07:30:00.0000000") == dt.datetime(2024, 1, 5, 7, 30)
    assert one(spark, clock.parse_slot_timestamp("d", "t"), d=d, t="closed") is None


def test_ratio_guards(spark):
    assert one(spark, numbers.ratio("a", "b"), a=3, b=0) == 0.0
    assert one(spark, numbers.ratio("a", "b"), a=3, b=-2) == 0.0
    assert one(spark, numbers.ratio("a", "b"), a=3, b=4) == 0.75


def test_publishable(spark):
    assert one(spark, numbers.publishable("p", "v"), p=0.7, v=0) == 0.0
    assert one(spark, numbers.publishable("p", "v"), p=1.7, v=1) == 1.0
    assert one(spark, numbers.publishable("p", "v"), p=-0.2, v=1) == 0.0


def test_target_space_round_trip(spark):
    y = one(spark, numbers.from_target_space(numbers.to_target_space("y")), y=0.37)
    assert abs(y - 0.37) < 1e-12


def rows(spark, data):
    return spark.createDataFrame(data, "vol_in_sla bigint, vol_actual bigint, sl_plan double")


def test_target_clips_and_defaults(spark):
    out = cleaning.target(rows(spark, [(5, 4, 1.4), (0, 0, None), (1, 4, 0.5)]), "sl_residual").collect()
    assert [(r.sl_actual, r.sl_plan) for r in out] == [(1.0, 1.0), (0.0, 0.0), (0.25, 0.5)]
    assert out[2].sl_residual == -0.25


def test_target_without_plan_column(spark):
    out = cleaning.target(rows(spark, [(1, 2, 0.5)]).drop("sl_plan")).first()
    assert out.sl_plan == 0.0


def test_unknown_target(spark):
    with pytest.raises(ValueError, match="unknown target"):
        cleaning.target(rows(spark, [(1, 2, 0.5)]), "other")


def test_require_and_ensure(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    with pytest.raises(ValueError, match=r"\['c'\]"):
        columns.require_columns(df, ["a", "c"])
    assert columns.ensure_columns(df, ["b", "c"]).first().asDict() == {"a": 1, "b": 0.0, "c": 0.0}
    assert columns.available_features(df, ["c", "b", "a"]) == (["b", "a"], ["c"])


def test_fill_numeric_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "a bigint, b decimal(10,2), c string")
    r = columns.fill_numeric(df).first()
    assert (r.a, float(r.b), r.c) == (0, 0.0, None)


def test_program_filter(spark):
    df = spark.createDataFrame([(1, 7), (2, 7), (1, 3)], "program_id int, channel_id int")
    with pytest.raises(ValueError, match="empty program list"):
        windows.program_filter(df, [])
    assert windows.program_filter(df, [1], 7).count() == 1
    assert windows.program_filter(df, range(1, 3000), 7).count() == 2  # long list: semi join


def test_date_window_edges(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def span(**kw):
        r = df.where(windows.date_window("d", 10, **kw)).agg(F.min("d"), F.max("d")).first()
        return r[0].isoformat(), r[1].isoformat()

    midnight, ten = dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 21, 10)
    assert span(as_of=midnight, mode="inference", future_days=3) == ("2024-01-11", "2024-01-24")
    assert span(as_of=ten, mode="inference", future_days=3) == ("2024-01-12", "2024-01-24")
    assert span(as_of=ten, cutoff="20/01/2024") == ("2024-01-10", "2024-01-20")
    assert span(as_of=ten) == ("2024-01-12", "2024-02-09")


def test_suffixes(spark):
    names = ["metricas_7d.json", "metricas_20260511_1430_7d.json", "benchmark_20260507_164441_14d.csv", "odd.json"]
    df = spark.createDataFrame([(n,) for n in names], "f string").withColumn("s", suffix.strip_prefix("f"))
    got = df.select("s", suffix.days("s"), suffix.timestamp_text("s"), suffix.title("s")).collect()
    assert [tuple(r) for r in got] == [
        ("7d", 7, "", "Benchmark de 7 dias"),
        ("20260511_1430_7d", 7, "", "Benchmark de 7 dias - 2026-05-11 14:30"),
        ("20260507_164441_14d", 14, "2026-05-07 16:44:41", "Benchmark de 14 dias - 2026-05-07 16:44"),
        ("odd", 0, "", "odd"),
    ]


def test_slot_end_passes_midnight(spark):
    df = spark.createDataFrame([(1, 0), (1, 60), (1, 1410), (2, 1410)], "program_id int, slot int")
    got = {(r.program_id, r.slot): r.slot_end for r in slot_end(df).collect()}
    assert got == {(1, 0): "01:00:00", (1, 60): "02:00:00", (1, 1410): "24:30:00", (2, 1410): "24:00:00"}


def test_relevant_slots(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 0, 1), (1, 0, 0), (0, 1, 0)], "vol_plan int, vol_actual int, hc_plan int")
    assert cleaning.relevant_slots(df).count() == 3
