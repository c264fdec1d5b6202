"""Linear models: one aggregation fits every program at once, scoring is a join."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions.numbers import from_target_space, publishable, total

MOMENT_SCHEMA = "program_id int, part int, n double, means array<double>, products array<double>"
#: Groups that a task holds before it sends them on; parts of a program that are merged one by one before the last merge.
FLUSH_GROUPS, MERGE_PARTS = 256, 64

Moment = tuple[float, np.ndarray, np.ndarray]


def merge(a: Moment | None, b: Moment) -> Moment:
    """Count, means and sums of products about the means, of two sets of rows together."""
    if a is None:
        return b
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def moments(df: DataFrame, columns: Sequence[str], group: str | None = "program_id") -> DataFrame:
    """Count, means and centred sums of products per group, in up to MERGE_PARTS rows each.

    Each task centres its own rows, so large means do not cancel the spread, and emits k x k numbers per program. A hot
    program therefore reaches the exchange as a few hundred numbers per task.
    """
    cols = list(columns)
    k = len(cols)
    gid = F.col(group).cast("int") if group else F.lit(0)
    data = df.select(gid.alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def rows_of(found: dict[int, Moment], part: int) -> pd.DataFrame:
        return pd.DataFrame(
            [(g, part, m[0], m[1].tolist(), m[2].ravel().tolist()) for g, m in found.items()],
            columns=["program_id", "part", "n", "means", "products"],
        )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) % MERGE_PARTS
        acc: dict[int, Moment] = {}
        for pdf in batches:
            for g, own in pdf.groupby("g"):
                x = own.iloc[:, 1:].to_numpy(dtype="float64")
                mean = x.mean(0)
                acc[g] = merge(acc.get(g), (float(len(x)), mean, (x - mean).T @ (x - mean)))
            if len(acc) > FLUSH_GROUPS:
                yield rows_of(acc, part)
                acc.clear()
        yield rows_of(acc, part)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return rows_of({int(pdf["program_id"].iloc[0]): total_moment(pdf, k)}, int(pdf["part"].iloc[0]))

    return data.mapInPandas(partial, MOMENT_SCHEMA).groupBy("program_id", "part").applyInPandas(merged, MOMENT_SCHEMA)


def total_moment(pdf: pd.DataFrame, k: int) -> Moment:
    out = None
    for n, means, products in zip(pdf["n"], pdf["means"], pdf["products"]):
        out = merge(out, (n, np.asarray(means), np.asarray(products).reshape(k, k)))
    return out


def linear_per_program(
    df: DataFrame, features: Sequence[str], target: str, ridge: float = 0.0, group: str | None = "program_id"
) -> DataFrame:
    """Least squares (ridge > 0: ridge on standardised inputs) per program.

    Returns (program_id, features, weights, centers, base_value): raw
    prediction = base_value + sum w * (x - center), so base_value is the mean
    prediction and w * (x - center) the exact attribution.
    """
    feats = list(features)
    k = len(feats)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, products = total_moment(pdf, k + 1)
        cov = products / n
        sxx, sxy = cov[:k, :k], cov[:k, k]
        sd = np.sqrt(np.clip(np.diag(sxx), 0, None))
        live = sd > 1e-14 * np.abs(mean[:k])
        live &= sd > 0
        w = np.zeros(k)
        if live.any():
            z = sd[live]
            corr = sxx[np.ix_(live, live)] / np.outer(z, z)
            rhs = sxy[live] / z
            w[live] = np.linalg.lstsq(corr + np.eye(live.sum()) * ridge / n, rhs, rcond=1e-10)[0] / z
        return pd.DataFrame(
            {"program_id": [int(pdf["program_id"].iloc[0])], "weights": [w.tolist()],
             "centers": [mean[:k].tolist()], "base_value": [float(mean[k])], "n_rows": [int(round(n))]}
        )

    solved = (
        moments(df, [*feats, target], group)
        .groupBy("program_id")
        .applyInPandas(solve, "program_id int, weights array<double>, centers array<double>, base_value double, n_rows bigint")
    )
    return solved.withColumn("features", F.array(*[F.lit(f) for f in feats]))


def score_linear(df: DataFrame, coefs: DataFrame, features: Sequence[str], target_transform: bool = True) -> DataFrame:
    """Raw value, contributions and publishable prediction; programs without a model drop out.

    `coefs` holds one row per program; whether it is broadcast is decided by
    its size at run time.
    """
    joined = df.join(coefs.select("program_id", "weights", "centers", "base_value"), "program_id")
    impact = {
        f: F.col("weights")[i] * (F.col(f).cast("double") - F.col("centers")[i]) for i, f in enumerate(features)
    }
    contribs = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f).alias("feature"),
                F.lit(catalog.PILLAR_OF.get(f, catalog.PILLAR_DRIVER_DEFAULT)).alias("pillar"),
                e.alias("impact"),
            )
            for i, (f, e) in enumerate(impact.items())
        ]
    )
    raw = F.col("base_value") + total(impact.values())
    level = from_target_space("raw_value") if target_transform else F.col("raw_value")
    return (
        joined.withColumns({"contribs": contribs, "raw_value": raw})
        .withColumn("sl_pred", publishable(level, "vol_plan"))
        .drop("weights", "centers")
    )
