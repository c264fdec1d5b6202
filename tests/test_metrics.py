import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.operators import cleaning, metrics
from slotwise.operators.encoding import encoding_lookup, encoding_override, target_encoding_fit


def frame(spark, rows):
    return spark.createDataFrame(rows, "program_id int, vol_actual int, sl_actual double, sl_pred double, sl_plan double")


def test_r2_of_constant_actuals(spark):
    df = frame(spark, [(1, 1, 0.5, 0.5, 0.4), (1, 1, 0.5, 0.5, 0.5), (2, 1, 0.5, 0.4, 0.5), (2, 1, 0.5, 0.5, 0.5), (3, 1, 0.2, 0.9, 0.2)])
    got = {r.program_id: r for r in metrics.metrics_by_program(df).collect()}
    assert got[1].r2_model == 1.0 and got[2].r2_model == 0.0
    assert got[3].r2_model == 0.0 and got[3].n_rows == 1  # undefined below two rows
    assert got[3].uplift_mae_pct == 0.0  # the plan is perfect


def test_only_operational_rows_count(spark):
    df = frame(spark, [(1, 0, 0.0, 1.0, 1.0), (1, 2, 0.5, 0.4, 0.9)])
    r = metrics.regression_metrics(df).first()
    assert r.n_rows == 1 and abs(r.mae_model - 0.1) < 1e-12 and abs(r.uplift_mae_pct - 75.0) < 1e-9
    assert metrics.regression_metrics(df.where("vol_actual > 9")).count() == 0


def psi(expected, actual, buckets=10):
    """Reference value by numpy."""
    e, a = np.array(expected), np.array(actual)
    edges = np.linspace(min(e.min(), a.min()), max(e.max(), a.max()), buckets + 1)

    def share(x):
        idx = np.clip(np.digitize(x, edges) - 1, 0, buckets - 1)
        s = np.bincount(idx, minlength=buckets) / len(x)
        return np.where(s == 0, 0.0001, s)

    e, a = share(e), share(a)
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.mark.parametrize("expected,actual", [
    ([0.0, 0.3, 0.3, 1.0], [0.3, 0.9, 1.0]), ([0.5] * 4, [0.5] * 3), ([0.1 * i for i in range(11)], [0.1 * i for i in range(5)])])
def test_psi(spark, expected, actual):
    rows = [(1, "train", v) for v in expected] + [(1, "test", v) for v in actual]
    df = spark.createDataFrame(rows, "program_id int, role string, sl_actual double")
    r = metrics.psi_drift(df).first()
    assert math.isclose(r.psi, psi(expected, actual), abs_tol=1e-9)
    assert r.drift == ("DRIFT" if r.psi > 0.15 else "STABLE")


def test_psi_without_second_sample_is_zero(spark):
    df = spark.createDataFrame([(1, "train", 0.2), (1, "train", 0.4)], "program_id int, role string, sl_actual double")
    assert metrics.psi_drift(df).first().psi == 0.0


def test_bands_need_ten_rows(spark):
    rows = [(1, 1, 0.1, 0.2, 0.0)] * 10 + [(1, 1, 1.0, 0.9, 0.0)] * 9
    got = metrics.metrics_by_band(frame(spark, rows)).collect()
    assert [r.band for r in got] == ["sl_0_30"]


def test_readiness_threshold(spark):
    rows = [(1, 1, 0.5, 0.0, 0.0)] * 50 + [(2, 1, 0.5, 0.0, 0.0)] * 49 + [(3, 1, 0.0, 0.0, 0.0)] * 60
    programs = spark.createDataFrame([(p,) for p in (1, 2, 3, 4)], "program_id int")
    ready = metrics.training_readiness(frame(spark, rows), programs)
    assert {r.program_id: r.status for r in ready.collect()} == {1: "trainable", 2: "insufficient", 3: "inactive", 4: "no_data"}
    r = metrics.training_summary(ready).first()
    assert (r.n_trained, r.n_skipped, r.trained_rows) == (1, 3, 50)


def test_residual_rebuild(spark):
    df = spark.createDataFrame([(0.9, 0.5, 0.05), (0.9, -0.1, 0.3), (None, 0.2, 0.2)], "sl_plan double, residual_pred double, sl_residual double")
    got = [(r.sl_pred, r.sl_actual, r.was_clipped) for r in metrics.residual_final(df, 0.15).collect()]
    want = [(1.0, 0.95, True), (0.8, 1.0, False), (0.15, 0.2, True)]
    for g, w in zip(got, want):
        assert g[2] == w[2] and abs(g[0] - w[0]) < 1e-12 and abs(g[1] - w[1]) < 1e-12


def test_cv_summary_population_std(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "program_id int, r2 double")
    r = metrics.cv_summary(df).first()
    assert abs(r.cv_r2_mean - 0.3) < 1e-12 and abs(r.cv_r2_std - 0.1) < 1e-12


def test_encoding(spark):
    rows = [(1, 1, 1.0, 0.0, 0.0)] * 30 + [(2, 1, 0.0, 0.0, 0.0)] * 10
    enc = target_encoding_fit(frame(spark, rows))
    got = {r.program_id: r.enc for r in enc.collect()}
    assert abs(got[1] - (0.5 * 1.0 + 0.5 * 0.75)) < 1e-12 and abs(got[2] - 0.75 * 0.75) < 1e-12
    new = frame(spark, [(9, 1, 0.0, 0.0, 0.0), (1, 1, 0.0, 0.0, 0.0)])
    assert {r.program_id: round(r.program_enc, 9) for r in encoding_lookup(new, enc).collect()} == {9: 0.75, 1: 0.875}
    assert encoding_lookup(new, enc.limit(0)).first().program_enc == 0.5
    over = encoding_override(new.withColumn("program_enc", F.lit(0.875)), enc).collect()
    assert {(r.program_id, r.program_enc, r.enc_mismatch) for r in over} == {(9, 0.875, False), (1, 0.875, False)}


def test_correlation_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) * [1, 10, 100] + [0, 5, 1000]
    df = spark.createDataFrame([tuple(map(float, r)) + (7.0,) for r in x], "a double, b double, c double, k double")
    got = {(r.feature_a, r.feature_b): r["corr"] for r in metrics.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 10
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            if i <= j:
                assert abs(got[a, b] - want[i, j]) < 1e-9
    assert got["a", "k"] is None


def test_histogram_keeps_every_row(spark):
    df = spark.range(101).select((F.col("id") / 100).alias("x"))
    h = metrics.histogram(df, "x", 30).collect()
    assert sum(r.n_rows for r in h) == 101 and {r.bin for r in h} == set(range(30))
    assert metrics.histogram(df.withColumn("x", F.lit(2.0)), "x").collect()[0].n_rows == 101


def test_distribution_total_row(spark):
    df = frame(spark, [(1, 1, 0.0, 0.0, 0.0), (1, 1, 1.0, 0.0, 0.0), (2, 1, 0.5, 0.0, 0.0)])
    total = [r for r in cleaning.target_distribution(df).collect() if r.is_total == 1][0]
    assert (total.n_rows, total.n_zero, total.n_one, total.n_between) == (3, 1, 1, 1)
