"""Error metrics of model and plan, drift, and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions.numbers import clip, clip_residual
from slotwise.operators.cleaning import r2_label
from slotwise.operators.columns import with_program_facts

# Bands of the actual service level.
BANDS = [("sl_0_30", 0.0, 0.3), ("sl_30_60", 0.3, 0.6), ("sl_60_80", 0.6, 0.8), ("sl_80_100", 0.8, 1.01)]
MIN_BAND_ROWS = 10


def r2(actual: str, pred: str) -> Column:
    """1 - SSE/SST; a constant actual scores 1 when perfect, else 0."""
    y, p = F.col(actual), F.col(pred)
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(y)
    constant = F.max(y) == F.min(y)
    return F.when(constant, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - sse / F.when(~constant, sst))


def _mae(y: str, p: str) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def _mse(y: str, p: str) -> Column:
    d = F.col(y) - F.col(p)
    return F.avg(d * d)


def uplift(base: Column, model: Column) -> Column:
    """Improvement over the plan in percent; 0 when the plan is perfect."""
    return F.when(base > 0, (base - model) / base * 100).otherwise(F.lit(0.0))


def metric_columns(y: str = "sl_actual", pred: str = "sl_pred", plan: str = "sl_plan") -> list[Column]:
    one = F.count(y) > 1
    return [
        F.count("*").alias("n_rows"),
        F.avg(y).alias("sl_actual_mean"),
        F.avg(pred).alias("sl_pred_mean"),
        F.avg(plan).alias("sl_plan_mean"),
        _mae(y, pred).alias("mae_model"),
        _mse(y, pred).alias("mse_model"),
        F.sqrt(_mse(y, pred)).alias("rmse_model"),
        F.when(one, r2(y, pred)).otherwise(F.lit(0.0)).alias("r2_model"),
        _mae(y, plan).alias("mae_plan"),
        _mse(y, plan).alias("mse_plan"),
        F.sqrt(_mse(y, plan)).alias("rmse_plan"),
        F.when(one, r2(y, plan)).otherwise(F.lit(0.0)).alias("r2_plan"),
    ]


def _with_uplift(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "uplift_mae_pct": uplift(F.col("mae_plan"), F.col("mae_model")),
            "uplift_rmse_pct": uplift(F.col("rmse_plan"), F.col("rmse_model")),
        }
    )


def _operational(df: DataFrame) -> DataFrame:
    return df.where(F.col("vol_actual") > 0).withColumn("sl_plan", clip(F.coalesce("sl_plan", F.lit(0.0))))


def regression_metrics(df: DataFrame) -> DataFrame:
    """One row: model against plan over operational intervals."""
    return _with_uplift(_operational(df).agg(*metric_columns())).where("n_rows > 0")


def metrics_by_program(df: DataFrame, keys: Sequence[str] = ("program_id",)) -> DataFrame:
    return _with_uplift(_operational(df).groupBy(*keys).agg(*metric_columns()))


def metrics_document(df: DataFrame, keys: Sequence[str] = (), pillars: bool = False) -> DataFrame:
    """Global row (program_id NULL) and one row per program in one pass; with `pillars`, the mean pillar impacts too."""
    keys = list(keys)
    impacts = [F.avg(c).alias(c) for c in catalog.PILLAR_COLUMNS] if pillars else []
    sets = [[F.col(k) for k in keys], [F.col(k) for k in [*keys, "program_id"]]]
    cols = [F.col(k) for k in [*keys, "program_id"]]
    out = _operational(df).groupingSets(sets, *cols).agg(
        *metric_columns(), *impacts, F.grouping("program_id").cast("int").alias("is_total")
    )
    return _with_uplift(out)


def evaluated_programs(df: DataFrame, min_rows: int = 10) -> DataFrame:
    """Holdout variant: programs with enough rows, rounded to 4 digits, labelled."""
    base = df.withColumn("sl_pred", clip("sl_pred")).groupBy("program_id").agg(*metric_columns())
    return base.where(F.col("n_rows") >= min_rows).select(
        "program_id",
        F.round("r2_model", 4).alias("r2_score"),
        F.round("rmse_model", 4).alias("rmse"),
        F.round("mae_model", 4).alias("mae"),
        "n_rows",
        F.round("sl_actual_mean", 3).alias("sl_actual_mean"),
        r2_label(F.col("r2_model")).alias("label"),
    )


def band_of(y: str = "sl_actual") -> Column:
    c = F.col(y)
    out = None
    for name, low, high in BANDS:
        cond = (c >= low) & (c < high)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def metrics_by_band(df: DataFrame, min_rows: int = MIN_BAND_ROWS) -> DataFrame:
    rows = df.withColumns({"band": band_of(), "sl_pred": clip("sl_pred")}).where(F.col("band").isNotNull())
    return (
        rows.groupBy("band")
        .agg(*metric_columns())
        .where(F.col("n_rows") >= min_rows)
        .select("band", "n_rows", "mae_model", "rmse_model", "r2_model")
    )


def residual_final(df: DataFrame, limit: float | None = 0.15) -> DataFrame:
    """Service level rebuilt from plan + predicted residual (optionally clipped)."""
    plan = clip(F.coalesce("sl_plan", F.lit(0.0)))
    res = F.col("residual_pred") if limit is None else clip_residual("residual_pred", limit)
    clipped = F.lit(False) if limit is None else F.abs("residual_pred") > limit
    return df.withColumns(
        {
            "was_clipped": clipped,
            "sl_pred": clip(plan + res),
            "sl_actual": clip(plan + F.col("sl_residual")),
            "sl_plan": plan,
        }
    )


def psi_bins(x: Column, low: Column, high: Column, buckets: int = 10) -> Column:
    """Index of the equal-width bin: number of edges <= x, minus one, inside the range."""
    step = (high - low) / buckets
    hits = F.lit(0)
    for i in range(buckets + 1):
        edge = high if i == buckets else F.lit(float(i)) * step + low
        hits = hits + F.when(edge <= x, 1).otherwise(0)
    return F.least(F.greatest(hits - 1, F.lit(0)), F.lit(buckets - 1))


def psi_drift(
    df: DataFrame, sample: str = "role", value: str = "sl_actual", buckets: int = 10,
    threshold: float = 0.15, expected: str = "train", actual: str = "test", many: bool = False,
) -> DataFrame:
    """Population stability index of `actual` rows against `expected` rows per program. `many`: see with_program_facts.

    Bins span the pooled range; empty bins count as 0.0001; a missing sample
    gives 0.0.
    """
    v = F.col(value).cast("double")
    span = df.groupBy("program_id").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    binned = with_program_facts(df.select("program_id", sample, value), span, many).where("program_id IS NOT NULL").withColumn("_bin", psi_bins(v, F.col("_lo"), F.col("_hi"), buckets))
    is_e, is_a = F.col(sample) == expected, F.col(sample) == actual
    per_key = [F.count_if(is_e & (F.col("_bin") == b)).alias(f"_e{b}") for b in range(buckets)]
    per_key += [F.count_if(is_a & (F.col("_bin") == b)).alias(f"_a{b}") for b in range(buckets)]
    counts = binned.groupBy("program_id").agg(F.count_if(is_e).alias("n_expected"), F.count_if(is_a).alias("n_actual"), *per_key)
    terms = F.lit(0.0)
    for b in range(buckets):
        e = F.try_divide(F.col(f"_e{b}"), F.col("n_expected"))
        a = F.try_divide(F.col(f"_a{b}"), F.col("n_actual"))
        e, a = (F.when(c == 0, F.lit(0.0001)).otherwise(c) for c in (e, a))
        terms = terms + (a - e) * F.ln(a / e)
    out = counts.select("program_id", "n_expected", "n_actual", F.coalesce(terms, F.lit(0.0)).alias("psi"))
    return out.withColumn("drift", F.when(F.col("psi") > threshold, "DRIFT").otherwise("STABLE"))


def cv_summary(folds: DataFrame, keys: Sequence[str] = ("program_id",)) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return folds.groupBy(*keys).agg(
        F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"), F.count("*").alias("n_folds")
    )


def training_readiness(df: DataFrame, programs: DataFrame, min_rows: int = 50, target: str = "sl_actual") -> DataFrame:
    """Status of every configured program: no data, inactive, too few rows, or trainable."""
    seen = df.groupBy("program_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(target) > 0).alias("n_operational")
    )
    n, op = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_operational", F.lit(0))
    return programs.select("program_id").join(seen, "program_id", "left").select(
        "program_id",
        n.alias("n_rows"),
        op.alias("n_operational"),
        F.when(n == 0, "no_data")
        .when(op == 0, "inactive")
        .when(op < min_rows, "insufficient")
        .otherwise("trainable")
        .alias("status"),
    )


def training_summary(readiness: DataFrame) -> DataFrame:
    """Trained and skipped programs, overall."""
    trained = F.col("status").isin("trainable", "trained")
    return readiness.agg(
        F.count_if(trained).alias("n_trained"),
        F.count_if(~trained).alias("n_skipped"),
        F.coalesce(F.sum(F.when(trained, F.col("n_rows"))), F.lit(0)).alias("trained_rows"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (long form); NULL where a column is constant.

    One aggregate of central co-moments, so large means do not cancel the spread.
    """
    cols = list(columns)
    x = [F.col(c).cast("double") for c in cols]
    varies = [F.min(c) < F.max(c) for c in x]

    def pair(i: int, j: int) -> Column:
        spread = F.sqrt(F.regr_sxx(x[i], x[j])) * F.sqrt(F.regr_syy(x[i], x[j]))  # of rows that have both values
        corr = F.try_divide(F.regr_sxy(x[i], x[j]), spread)  # corr() itself fails on a constant
        corr = F.when(varies[i] & varies[j], corr)  # merged partials can leave a constant a spread of 1e-15
        return F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"), corr.alias("corr"))

    pairs = [pair(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max; the last bin is closed."""
    v = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    rows = df.where(F.col(column).isNotNull()).select(v.alias("v"), span.alias("span")).select("v", "span.lo", "span.hi")
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) / F.when(width > 0, width))).otherwise(0)
    return rows.groupBy(F.least(index, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n_rows"))


def importance_report(importances: DataFrame, top: int = 5) -> DataFrame:
    """Rank of each feature per program, with flags for the top ones and the unused ones."""
    w = Window.partitionBy("program_id").orderBy(F.col("importance").desc(), "position")
    return importances.withColumn("rank", F.row_number().over(w)).withColumns(
        {"is_top": F.col("rank") <= top, "is_unused": F.col("importance") == 0}
    )
