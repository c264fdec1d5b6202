import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import history, splits

START = dt.datetime(2024, 1, 1)


def series(spark, spec, seed=1):
    """spec: {(program, channel): [slot numbers since START]}"""
    rng = random.Random(seed)
    rows = []
    for (p, c), slots in spec.items():
        for s in slots:
            values = [round(rng.random(), 3) for _ in range(1 + len(catalog.LAGGED_METRICS))]
            rows.append((p, c, START + dt.timedelta(minutes=30 * s), *values))
    cols = "program_id int, channel_id int, slot_ts timestamp, sl_actual double, " + ", ".join(
        f"{m} double" for m in catalog.LAGGED_METRICS)
    return spark.createDataFrame(rows, cols)


def expected(pdf):
    """The rolling features in pandas, series by series."""
    pdf = pdf.sort_values(["program_id", "channel_id", "slot_ts"]).copy()
    g = pdf.groupby(["program_id", "channel_id"])["sl_actual"]
    mean = pdf["sl_actual"].mean()
    for k in (1, 2, 3):
        pdf[f"sl_lag_{k}"] = g.shift(k).fillna(mean)
    prev = g.shift(1).groupby([pdf["program_id"], pdf["channel_id"]])
    pdf["sl_mean_3"] = prev.transform(lambda x: x.rolling(3, min_periods=1).mean()).fillna(mean)
    pdf["sl_mean_6"] = prev.transform(lambda x: x.rolling(6, min_periods=1).mean()).fillna(mean)
    pdf["sl_std_6"] = prev.transform(lambda x: x.rolling(6, min_periods=2).std()).fillna(0.0)
    pdf["avg_wait_lag_1"] = pdf.groupby(["program_id", "channel_id"])["avg_wait"].shift(1).fillna(0.0)
    return pdf


COLS = ["sl_lag_1", "sl_lag_2", "sl_lag_3", "sl_mean_3", "sl_mean_6", "sl_std_6", "avg_wait_lag_1"]


@pytest.mark.parametrize("bucket_days", [1, 7])
def test_halo_equals_plain_rolling(spark, bucket_days):
    rng = random.Random(7)
    spec = {
        (1, 7): range(48 * 30),  # a dense series
        (2, 7): sorted(rng.sample(range(48 * 30), 60)),  # gaps longer than a bucket
        (3, 7): [0], (3, 3): [5, 900], (4, 7): range(6), (5, 7): range(40, 47),
        (6, 7): [10 + 48 * 8 * i for i in range(9)],  # one row every 8 days
    }
    df = series(spark, spec)
    got = history.lag_and_rolling(df, bucket_days=bucket_days).toPandas()
    want = expected(df.toPandas())
    key = ["program_id", "channel_id", "slot_ts"]
    both = got.merge(want, on=key, suffixes=("", "_want"))
    assert len(both) == len(got) == len(want)
    for c in COLS:
        pd.testing.assert_series_equal(both[c], both[f"{c}_want"], check_names=False, rtol=1e-9, atol=1e-9)
    assert (got["sl_accel"] - (got["sl_lag_1"] - got["sl_lag_2"])).abs().max() == 0


def test_last_observed_history(spark):
    df = series(spark, {(1, 7): range(60)}).withColumn("vol_actual", F.lit(1))
    edge = START + dt.timedelta(minutes=30 * 50)
    df = df.withColumn("sl_actual", F.when(F.col("slot_ts") >= F.lit(edge), 0.0).otherwise(F.col("sl_actual")))
    seen = [r.sl_actual for r in df.where(F.col("slot_ts") < F.lit(edge)).orderBy("slot_ts").collect()]
    out = history.lag_and_rolling(df, future_from=edge).where(F.col("slot_ts") >= F.lit(edge)).collect()
    assert {round(r.sl_lag_1, 9) for r in out} == {seen[-1]}
    assert {round(r.sl_lag_3, 9) for r in out} == {seen[-3]}
    assert all(abs(r.sl_mean_6 - sum(seen[-6:]) / 6) < 1e-9 for r in out)


def test_numbered_is_row_number(spark):
    df = series(spark, {(1, 7): range(0, 300, 7), (1, 3): range(0, 300, 11), (2, 7): [3]})
    out = history.row_index(df).toPandas().sort_values(["program_id", "slot_ts", "channel_id"])
    assert list(out["row_num"]) == [i + 1 for p in (1, 2) for i in range((out["program_id"] == p).sum())]


def test_folds_never_train_on_the_future(spark):
    df = series(spark, {(1, 7): range(101), (2, 7): range(13)})
    out = history.time_folds(df, 5).toPandas()
    for (p, fold), part in out.groupby(["program_id", "fold"]):
        n = {1: 101, 2: 13}[p]
        t = n // 6
        test = part[part["role"] == "test"]["row_num"] - 1
        train = part[part["role"] == "train"]["row_num"] - 1
        start = n - (5 - fold) * t
        assert list(sorted(test)) == list(range(start, start + t))
        assert list(sorted(train)) == list(range(start))


def test_head_tail_uses_ceil(spark):
    out = splits.head_tail_split(series(spark, {(1, 7): range(11)}), 0.2).toPandas()
    assert out["is_validation"].sum() == 3
    assert out[out["is_validation"]]["row_num"].min() == 9


def test_date_split(spark):
    nine_days = splits.date_split(series(spark, {(1, 7): range(48 * 9)}), 0.2).toPandas()
    assert nine_days[nine_days["is_test"]]["slot_ts"].dt.date.nunique() == 1
    one_day = splits.date_split(series(spark, {(1, 7): range(5)}), 0.2).toPandas()
    assert one_day["is_test"].all()


def test_future_split(spark):
    df = series(spark, {(1, 7): range(96)}).withColumn("vol_actual", F.when(F.hour("slot_ts") < 6, 1).otherwise(0))
    out = splits.future_split(df, dt.datetime(2024, 1, 2, 3)).toPandas()
    assert out[out["is_future"]]["slot_ts"].min() == pd.Timestamp("2024-01-02 06:00")
    none = splits.future_split(df.withColumn("vol_actual", F.lit(0)), dt.datetime(2024, 1, 2)).toPandas()
    assert none[none["is_future"]]["slot_ts"].min() == pd.Timestamp("2024-01-02 00:30")


def test_sample_is_stable(spark):
    df = series(spark, {(1, 7): range(500)})
    a = splits.bounded_sample(df, ["slot_ts"], 50).toPandas()
    b = splits.bounded_sample(df.repartition(5), ["slot_ts"], 50).toPandas()
    assert set(a["slot_ts"]) == set(b["slot_ts"]) and len(a) == 50
