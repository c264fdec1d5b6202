"""Roll-ups of additive contributions: pillars, top drivers, waterfall.

A row's contributions travel as one array of (position, feature, pillar,
impact), in model order. Everything here works inside the row, so none of it
needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions.numbers import from_target_space

CONTRIBUTION = "array<struct<position:int,feature:string,pillar:string,impact:double>>"
OTHER_FEATURES = "Outros (demais features)"  # fixed value
TOP_WATERFALL = 15


def pillar_of(df: DataFrame, feature_col: str = "feature", default: str = catalog.PILLAR_DRIVER_DEFAULT) -> DataFrame:
    """Adds the pillar of a feature name; unknown names get the default."""
    return df.withColumn("pillar", pillar_name(F.col(feature_col), default))


def pillar_name(feature: Column, default: str) -> Column:
    pairs = [F.lit(v) for f, p in catalog.PILLAR_OF.items() for v in (f, p)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), feature), F.lit(default))


def contributions(features: Column, impacts: Column) -> Column:
    """Pair names and impacts by position into the contribution array."""
    return F.transform(
        F.arrays_zip(features.alias("feature"), impacts.alias("impact")),
        lambda x, i: F.struct(
            i.cast("int").alias("position"),
            x["feature"].alias("feature"),
            pillar_name(x["feature"], catalog.PILLAR_DRIVER_DEFAULT).alias("pillar"),
            x["impact"].alias("impact"),
        ),
    )


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x["impact"])


def pillar_rollup(df: DataFrame, contribs: str = "contribs") -> DataFrame:
    """Published pillar impacts; the two context pillars are summed."""

    def impact_of(pillars):
        return _sum(F.filter(F.col(contribs), lambda x: x["pillar"].isin(*pillars)))

    return df.withColumns({name: impact_of(ps) for name, ps in catalog.PILLAR_COLUMNS.items()})


def ranked(contribs: Column) -> Column:
    """Largest |impact| first, ties in model order."""
    keyed = F.transform(
        contribs,
        lambda x: F.struct(
            (-F.abs(x["impact"])).alias("key"), x["position"].alias("position"), x["feature"].alias("feature"),
            x["pillar"].alias("pillar"), x["impact"].alias("impact"),
        ),
    )
    return F.array_sort(keyed)


def top_drivers(df: DataFrame, contribs: str = "contribs", n: int = 3, threshold: float = catalog.DRIVER_THRESHOLD) -> DataFrame:
    """The n strongest negative (detractor) and positive (booster) impacts, padded."""
    order = ranked(F.col(contribs))
    name, pillar, impact = catalog.NO_DRIVER
    df = df.withColumns(
        {
            "_neg": F.filter(order, lambda x: x["impact"] < -threshold),
            "_pos": F.filter(order, lambda x: x["impact"] > threshold),
        }
    )
    out = {}
    for side, src in (("detractor", "_neg"), ("booster", "_pos")):
        for i in range(n):
            item = F.get(F.col(src), F.lit(i))
            out[f"{side}_{i + 1}_name"] = F.coalesce(item["feature"], F.lit(name))
            out[f"{side}_{i + 1}_pillar"] = F.coalesce(item["pillar"], F.lit(pillar))
            out[f"{side}_{i + 1}_impact"] = F.coalesce(item["impact"], F.lit(impact))
    return df.withColumns(out).drop("_neg", "_pos")


def top_plus_other(contribs: Column, n: int = TOP_WATERFALL) -> Column:
    """The n strongest contributions, then one bucket with the sum of the rest."""
    order = F.transform(
        ranked(contribs), lambda x: F.struct(x["feature"].alias("feature"), x["impact"].alias("impact"))
    )
    rest = F.slice(order, n + 1, F.greatest(F.size(order) - n, F.lit(1)))
    bucket = F.array(F.struct(F.lit(OTHER_FEATURES).alias("feature"), _sum(rest).alias("impact")))
    return F.when(F.size(order) > n, F.concat(F.slice(order, 1, n), bucket)).otherwise(order)


def waterfall(
    df: DataFrame, keys: Sequence[str] = tuple(catalog.KEYS), contribs: str = "contribs", base: str = "base_value",
    target_transform: bool = True,
) -> DataFrame:
    """One row per step of each interval: running value from the base to the total, and its service level."""
    steps = df.select(*keys, base, top_plus_other(F.col(contribs)).alias("_steps"))
    level = from_target_space if target_transform else (lambda c: c)
    total = F.col(base) + _sum(F.col("_steps"))
    return steps.select(
        *keys, F.posexplode("_steps").alias("_pos", "_step"), "_steps", base, total.alias("total_value")
    ).select(
        *keys,
        (F.col("_pos") + 1).cast("bigint").alias("step"),
        F.col("_step.feature").alias("feature"),
        F.col("_step.impact").alias("impact"),
        (F.col(base) + _sum(F.slice("_steps", F.lit(1), F.col("_pos") + 1))).alias("running_value"),
        "total_value",
        level(F.col("total_value")).alias("sl_total"),
    )


def pillar_means(df: DataFrame) -> DataFrame:
    return df.groupBy("program_id").agg(*[F.avg(c).alias(c) for c in catalog.PILLAR_COLUMNS])


def mean_abs_attribution(df: DataFrame, contribs: str = "contribs") -> DataFrame:
    """Mean |impact| per program and feature."""
    long = df.select("program_id", F.inline(contribs))
    return long.groupBy("program_id", "feature").agg(F.avg(F.abs("impact")).alias("mean_abs"))


def long_contributions(df: DataFrame, keys: Sequence[str] = tuple(catalog.KEYS), contribs: str = "contribs") -> DataFrame:
    return df.select(*keys, F.inline(contribs))
