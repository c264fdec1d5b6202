"""Row-lag and rolling features of a series, and exact row numbers, at any series length.

A series (program, channel) may hold a large share of all rows, so no window is
partitioned by the series alone. Rows are split into calendar buckets; a bucket
first receives a copy of the rows that precede it (its halo), and windows run
inside the bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise import catalog

DEPTH = 6  # widest look-back of any feature
EPOCH = "1970-01-01"


def bucket_of(ts: str, days: int) -> Column:
    return F.floor(F.date_diff(F.col(ts), F.lit(EPOCH)) / days).cast("int")


def with_halo(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], days: int, depth: int) -> DataFrame:
    """df plus, per bucket, the last `depth` rows before it (flag _halo).

    Only bucket tails travel between buckets: at most `depth` rows each, found
    by looking back over at most `depth` non-empty buckets.
    """
    keys = list(keys)
    rows = df.withColumn("_bucket", bucket_of(ts, days))
    newest = Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts).desc())
    row = F.struct(F.col(ts).alias("ts"), *[F.col(v).alias(v) for v in values])
    tails = (
        rows.select(*keys, "_bucket", ts, *values)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= depth)
        .groupBy(*keys, "_bucket")
        .agg(F.collect_list(row).alias("_tail"))
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(-depth, -1)
    earlier = F.sort_array(F.flatten(F.collect_list("_tail").over(before)))
    halo = (
        tails.withColumn("_tail", F.slice(F.reverse(earlier), 1, depth))
        .select(*keys, "_bucket", F.inline("_tail"))
        .withColumnRenamed("ts", ts)
        .withColumn("_halo", F.lit(True))
    )
    return rows.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)


def lag_and_rolling(
    df: DataFrame,
    keys: Sequence[str] = tuple(catalog.SERIES),
    ts: str = "slot_ts",
    bucket_days: int = 7,
    future_from=None,
) -> DataFrame:
    """Lags 1-3 and rolling statistics of sl_actual, lag 1 of nine metrics.

    Lags count rows, not minutes. First rows fall back to the mean of the whole
    table (service level) or 0.0 (the rest). Rows after the last actual slot
    carry sl_actual = 0, and their lags see those zeros; pass `future_from`
    (a timestamp) to hide values at or after it from later rows and use the
    last value observed before it instead.
    """
    values = ["sl_actual", *catalog.LAGGED_METRICS]
    wide = with_halo(df, keys, ts, values, bucket_days, DEPTH)
    w = Window.partitionBy(*keys, "_bucket").orderBy(ts)
    sl = F.col("sl_actual")
    mean = F.coalesce(df.agg(F.avg("sl_actual")).scalar(), F.lit(0.0))

    def lag(c, k, fill):
        return F.coalesce(F.lag(c, k).over(w), fill)

    out = {
        **{f"sl_lag_{k}": lag("sl_actual", k, F.col("_mean")) for k in (1, 2, 3)},
        **{f"{m}_lag_1": lag(m, 1, F.lit(0.0)) for m in catalog.LAGGED_METRICS},
        "sl_mean_3": F.coalesce(F.avg(sl).over(w.rowsBetween(-3, -1)), F.col("_mean")),
        "sl_mean_6": F.coalesce(F.avg(sl).over(w.rowsBetween(-6, -1)), F.col("_mean")),
        "sl_std_6": F.coalesce(F.stddev_samp(sl).over(w.rowsBetween(-6, -1)), F.lit(0.0)),
    }
    done = (
        wide.withColumn("_mean", mean)
        .withColumns(out)
        .where(~F.col("_halo"))
        .withColumn("sl_accel", F.col("sl_lag_1") - F.col("sl_lag_2"))
        .drop("_mean", "_halo", "_bucket")
    )
    return done if future_from is None else hold_last_observed(done, df, keys, ts, future_from)


def hold_last_observed(done: DataFrame, df: DataFrame, keys: Sequence[str], ts: str, future_from) -> DataFrame:
    """Replace service-level history of rows after `future_from` by the last observed values."""
    history = ["sl_lag_1", "sl_lag_2", "sl_lag_3", "sl_mean_3", "sl_mean_6", "sl_std_6", "sl_accel"]
    edge = F.lit(future_from)
    past = df.where((F.col(ts) < edge) & (F.col("vol_actual") > 0))
    recent = past.withColumn("_bucket", bucket_of(ts, 1))
    newest = Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts).desc())
    tails = recent.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= DEPTH)
    last = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    ranked = tails.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") <= DEPTH)

    def nth(k):
        return F.max(F.when(F.col("_rank") == k, F.col("sl_actual")))

    within3 = F.when(F.col("_rank") <= 3, F.col("sl_actual"))
    observed = ranked.groupBy(*keys).agg(
        nth(1).alias("o_sl_lag_1"),
        F.coalesce(nth(2), nth(1)).alias("o_sl_lag_2"),
        F.coalesce(nth(3), nth(2), nth(1)).alias("o_sl_lag_3"),
        F.avg(within3).alias("o_sl_mean_3"),
        F.avg("sl_actual").alias("o_sl_mean_6"),
        F.coalesce(F.stddev_samp("sl_actual"), F.lit(0.0)).alias("o_sl_std_6"),
    )
    observed = observed.withColumn("o_sl_accel", F.col("o_sl_lag_1") - F.col("o_sl_lag_2"))
    joined = done.join(observed, list(keys), "left")
    swap = {
        c: F.when(F.col(ts) >= edge, F.coalesce(F.col(f"o_{c}"), F.col(c))).otherwise(F.col(c)) for c in history
    }
    return joined.withColumns(swap).drop(*[f"o_{c}" for c in history])


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: str | Column,
    number: str = "row_num",
    size: str | None = "n_rows",
) -> DataFrame:
    """Exact 1-based row number per key without one task per key.

    `bucket` must follow the ordering (e.g. the date of the leading timestamp).
    Rows are numbered inside their bucket and shifted by the row count of the
    earlier buckets, which is a window over one row per bucket.
    """
    keys = list(keys)
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    rows = df.withColumn("_b", b)
    counts = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    run = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    offsets = counts.select(
        *keys,
        "_b",
        F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"),
        F.sum("_n").over(every).alias("_total"),
    )
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    out = rows.join(offsets, [*keys, "_b"]).withColumn(
        number, (F.row_number().over(inside) + F.col("_before")).cast("bigint")
    )
    if size:
        out = out.withColumn(size, F.col("_total"))
    return out.drop("_b", "_before", "_total")


def row_index(df: DataFrame, number: str = "row_num") -> DataFrame:
    """Stable row number per program, used to address its attributions."""
    return numbered(df, ["program_id"], ["slot_ts", "channel_id"], F.to_date("slot_ts"), number, None)


def time_folds(df: DataFrame, k: int = 5) -> DataFrame:
    """Expanding-window folds per program: one row per (row, fold) it takes part in.

    With n rows and test size t = n div (k + 1), fold i tests rows
    [n - (k - i) t, n - (k - i - 1) t) and trains on all earlier rows.
    """
    rows = numbered(df, ["program_id"], ["slot_ts", "channel_id"], F.to_date("slot_ts"))
    i = F.col("row_num") - 1
    t = F.floor(F.col("n_rows") / (k + 1))
    folds = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    rows = rows.withColumns({"_i": i, "_t": t}).withColumn("fold", folds)
    start = F.col("n_rows") - (F.lit(k) - F.col("fold")) * F.col("_t")
    stop = start + F.col("_t")
    role = F.when(F.col("_i") < start, "train").when(F.col("_i") < stop, "test")
    return rows.withColumn("role", role).where(F.col("role").isNotNull()).drop("_i", "_t")
