from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import drivers
from slotwise.operators.reports import feature_sets


def with_contribs(spark, pairs):
    names = F.array(*[F.lit(n) for n, _ in pairs])
    values = F.array(*[F.lit(float(v)) for _, v in pairs])
    return spark.range(1).select(F.lit(0.5).alias("base_value"), drivers.contributions(names, values).alias("contribs"))


def test_thresholds_ties_and_padding(spark):
    df = with_contribs(spark, [("hour", 0.001), ("sl_plan", -0.001), ("vol_plan", 0.2), ("hc_plan", -0.2), ("made_up", 0.2), ("weekday", 0.05)])
    r = drivers.top_drivers(df).first()
    assert [r[f"booster_{i}_name"] for i in (1, 2, 3)] == ["vol_plan", "made_up", "weekday"]
    assert r.booster_2_pillar == "Outros"
    assert [r[f"detractor_{i}_name"] for i in (1, 2, 3)] == ["hc_plan", "Sem Impacto Relevante", "Sem Impacto Relevante"]
    assert (r.detractor_2_pillar, r.detractor_2_impact) == ("N/A", 0.0)


def test_pillars_cover_all_contributions(spark):
    pairs = [(f, (i - 18) / 100) for i, f in enumerate(catalog.FEATURES)] + [("unknown", 3.0)]
    r = drivers.pillar_rollup(with_contribs(spark, pairs)).first()
    known = sum(v for n, v in pairs if n != "unknown")
    assert abs(sum(r[c] for c in catalog.PILLAR_COLUMNS) - known) < 1e-9


def test_waterfall_ends_at_total(spark):
    pairs = [(f, 0.01 * (i + 1) * (-1) ** i) for i, f in enumerate(catalog.FEATURES)]
    steps = drivers.waterfall(with_contribs(spark, pairs), keys=[]).orderBy("step").collect()
    assert len(steps) == 16 and steps[-1].feature == drivers.OTHER_FEATURES
    assert abs(steps[-1].running_value - steps[-1].total_value) < 1e-12
    assert abs(steps[0].total_value - (0.5 + sum(v for _, v in pairs))) < 1e-9
    short = drivers.waterfall(with_contribs(spark, pairs[:3]), keys=[]).orderBy("step").collect()
    assert [s.feature for s in short] == ["aht_plan_total", "hc_plan", "vol_plan"]


def test_every_input_has_one_pillar():
    assert sorted(catalog.PILLAR_OF) == sorted(catalog.FEATURES) and len(catalog.FEATURES) == 37


def test_feature_sets(spark):
    programs = spark.createDataFrame([(1,), (2,)], "program_id int")
    sets = {r.program_id: r.features for r in feature_sets(programs, catalog.FEATURES, {2: ["hour", "sl_lag_2", "vacation"]},
                                                           {"vacation": None, "missed_days": [1]}).collect()}
    assert sets[1][:20] == catalog.GLOBAL_FEATURES and sets[1][20:22] == ["vacation", "missed_days"] and len(sets[1]) == 37
    assert "hour" in sets[2]  # a global feature cannot be excluded
    assert "sl_lag_2" not in sets[2] and "vacation" not in sets[2] and len(sets[2]) == 35
    assert "missed_days" in sets[2]  # not allowed as optional, still a configured input
