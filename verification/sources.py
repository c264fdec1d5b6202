"""Scans, sources and sinks."""

import datetime as dt

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import columns, history, metrics
from slotwise.plans import history as plans
from slotwise.plans import scoring
from slotwise.sources import demo, forecast, stages, stores
from verification import inputs as i
from verification.registry import check
from verification.splits import RUN_SCORES, run_scores
from verification.sqltext import D, metric_select

K = i.KEYS
DRIVERS = " ".join(f"{x}_{k}_name {x}_{k}_pillar:string {x}_{k}_impact:double" for x in ("detractor", "booster") for k in (1, 2, 3))
P5 = " ".join(catalog.PILLAR_COLUMNS)


@check("scan_mart", i.MART_SPEC, ["mart_infer"], "SELECT * FROM mart_infer")
def _(s, d):
    return i.live_mart(s, d)


@check("scan_mart_sql", i.MART_SPEC, ["mart"], """SELECT * FROM mart WHERE ref_date >= DATE '2024-01-10' AND ref_date < DATE '2024-01-25'
 AND channel_id = 3 AND program_id IN (900000, 900004)""")
def _(s, d):
    """The same scan as SQL text with bound parameters."""
    return s.sql(
        "SELECT * FROM {mart} WHERE ref_date >= :first AND ref_date < :stop AND channel_id = :channel "
        "AND array_contains(:programs, program_id)",
        args={"first": dt.date(2024, 1, 10), "stop": dt.date(2024, 1, 25), "channel": 3,
              "programs": F.array(F.lit(900000), F.lit(900004))},
        mart=i.mart(s, d))


@check("scan_log_gap", f"ref_date:date program_id {i.GAP_INTS}", ["gap_infer"], "SELECT * FROM gap_infer")
def _(s, d):
    return plans.scan_log_gap(demo.system_time(s, d), demo.agents(s, d), demo.config())


@check("require_columns", f"{K} vol_plan hour:bigint sl_actual:double", ["clean_train"], "SELECT * FROM clean_train ORDER BY slot_ts")
def _(s, d):
    return columns.require_columns(i.light(s, d, "training"), ["vol_plan", "hour", "sl_actual"]).orderBy("slot_ts")


@check("ensure_columns", f"{K} vol_plan:bigint paid_sec log_gap_sec:double", ["mart_infer"],
       "SELECT *, 0.0 AS paid_sec, 0.0 AS log_gap_sec FROM mart_infer")
def _(s, d):
    return columns.ensure_columns(i.live_mart(s, d), catalog.LOG_GAP_COLUMNS)


@check("stage_sink", f"{K} vol_actual:bigint sl_actual:double", ["clean_train"], "SELECT * FROM clean_train WHERE ref_date >= DATE '2024-01-20'")
def _(s, d):
    """Written by date, read back with the date partitions pruned."""
    df = i.light(s, d, "training")
    path = stages.stage_sink(df, stages.new_stage(s, "clean"), "ref_date")
    return stages.read_stage(s, path, df.schema).where("ref_date >= DATE '2024-01-20'")


NAMES_SQL = """SELECT CASE WHEN s_suppkey % 11 = 3 THEN '' ELSE cast(900000 + s_suppkey % 5 AS varchar) END AS code,
 CASE WHEN s_suppkey % 13 = 5 THEN '' ELSE s_name END AS name, s_suppkey FROM supplier"""


@check("program_dim", "program_id n_rows:bigint program_name:string", ["fx_plan"], f"""
SELECT program_id, count(*) AS n_rows, coalesce(max(name), '') AS program_name FROM fx_plan LEFT JOIN
 (SELECT code, arg_max(name, s_suppkey) AS name FROM ({NAMES_SQL}) AS n WHERE trim(code) <> '' AND trim(name) <> '' GROUP BY 1) AS x
 ON cast(program_id AS varchar) = code GROUP BY 1""")
def _(s, d):
    lines = s.sql(NAMES_SQL.replace("varchar", "string").replace("FROM supplier", "FROM {t}"), t=demo.table(s, d, "supplier"))
    text = lines.orderBy("s_suppkey").select(F.concat(F.lit(" "), "code", F.lit(" ;"), "name", F.lit(" ")).alias("value"))
    path = stages.new_stage(s, "programs")
    text.write.text(path)
    plan = demo.plan(s, d).groupBy("program_id").agg(F.count("*").alias("n_rows"))
    return stores.with_program_name(plan, stores.program_dim(s, path))


def stored_docs(s, d):
    """Metric documents of all runs, written as JSON, next to a corrupt one."""
    root = stages.new_stage(s, "docs")
    runs = demo.runs(s, d)
    scores = metrics.metrics_document(run_scores(s, d), ["suffix"])
    stores.metrics_sink(stores.metric_documents(scores, runs), f"{root}/metrics")
    broken = runs.select(F.concat(F.lit("broken_"), "suffix").alias("suffix"), F.lit('{"overall": {"n_rows": ').alias("value"))
    stores.metrics_sink(broken, f"{root}/broken")
    return root


DOC = "suffix executed_at:string days n_rows n_programs:bigint mae_model r2_model mae_plan uplift_mae_pct:double"


@check("scan_metric_docs", DOC, ["clean_infer", "fx_runs"], f"""
SELECT suffix, strftime(as_of, '%Y-%m-%d') || ' 00:00:00' AS executed_at, days, n_programs, n_rows, mae_model, r2_model, mae_plan, uplift_mae_pct
FROM (SELECT suffix, count(DISTINCT program_id) AS n_programs, {metric_select()} FROM {RUN_SCORES} GROUP BY 1) AS m JOIN fx_runs USING (suffix)""")
def _(s, d):
    docs = stores.scan_metric_docs(s, stored_docs(s, d))
    return docs.select("suffix", "executed_at", "days", F.size("by_program").alias("n_programs"), "overall.*")


@check("metric_document_pillars", f"suffix program_id:string mae_model {' '.join(catalog.PILLAR_COLUMNS)}:double", ["forest_explained_infer"],
       f"SELECT '20240131_000000_30d' AS suffix, cast(program_id AS varchar) AS program_id, {metric_select()}, "
       + ", ".join(f"avg({c}) AS {c}" for c in catalog.PILLAR_COLUMNS) + " FROM forest_explained_infer WHERE vol_actual > 0 GROUP BY 2")
def _(s, d):
    """Mean pillar impacts of each program, stored in the document of a run and read back."""
    rows = scoring.explained(i.fixed_scores(s, d)).withColumn("suffix", F.lit("20240131_000000_30d"))
    runs = demo.runs(s, d).limit(1).select(F.lit("20240131_000000_30d").alias("suffix"), "as_of", "days")
    path = stores.metrics_sink(stores.metric_documents(metrics.metrics_document(rows, ["suffix"], True), runs), stages.new_stage(s, "docs"))
    docs = stores.scan_metric_docs(s, path).select("suffix", F.explode("by_program").alias("program_id", "m"))
    return docs.select("suffix", "program_id", "m.*")


@check("metrics_sink", f"suffix:string program_id:bigint {' '.join(c + ':double' for c in ('mae_model', 'rmse_model', 'mae_plan', 'uplift_mae_pct'))}",
       ["clean_infer", "fx_runs"], f"SELECT suffix, program_id, {metric_select()} FROM {RUN_SCORES} GROUP BY 1, 2")
def _(s, d):
    """Metric rows written per run and read back."""
    scores = metrics.metrics_document(run_scores(s, d), ["suffix"]).where("is_total = 0")
    path = stages.stage_sink(scores, stages.new_stage(s, "metrics"), "suffix")
    return stages.read_stage(s, path, scores.schema)


@check("scan_run_rows", f"{K} suffix:string sl_pred:double", ["clean_infer", "fx_runs"],
       f"SELECT * FROM {RUN_SCORES} WHERE suffix = '20240122_030000_7d'")
def _(s, d):
    rows = run_scores(s, d).select(*catalog.KEYS, "suffix", "sl_pred")
    path = stages.stage_sink(rows, stages.new_stage(s, "runs"), "suffix")
    return stores.scan_run_rows(s, path, "20240122_030000_7d", rows.schema)


@check("encoding_store", "program_id n:bigint enc global_mean:double", ["enc_train"], "SELECT * FROM enc_train")
def _(s, d):
    path = stores.save_encoding(i.stored_encoding(s, d), stages.new_stage(s, "encodings"))
    return stores.load_encoding(s, path, None)


ROLL = f"""
WITH e AS (SELECT ref_date, slot, program_id, channel_id, sl_plan AS sl_pred FROM mart WHERE vol_plan > 0),
b AS (SELECT ref_date, slot, program_id, channel_id, 0.25 AS sl_pred FROM mart WHERE vol_plan > 1 AND slot >= 600 AND program_id <> 900002)"""


def _existing_and_batch(s, d):
    m = i.mart(s, d)
    old = m.where(F.col("vol_plan") > 0).select(*catalog.KEYS, F.col("sl_plan").alias("sl_pred"))
    new = m.where((F.col("vol_plan") > 1) & (F.col("slot") >= 600) & (F.col("program_id") != 900002))
    return old, new.select(*catalog.KEYS, F.lit(0.25).cast("double").alias("sl_pred"))


@check("rolling_overwrite", f"{K} sl_pred:double", ["mart"], ROLL + """
SELECT e.* FROM e LEFT JOIN (SELECT ref_date, min(slot) AS m FROM b GROUP BY 1) AS x USING (ref_date) WHERE m IS NULL OR slot < m
UNION ALL SELECT * FROM b""")
def _(s, d):
    """Published twice: the second time must change nothing."""
    old, new = _existing_and_batch(s, d)
    path = stages.new_stage(s, "forecast")
    for batch in (old, new, new):
        forecast.publish(s, path, batch)
    return forecast.read_forecast(s, path, new.schema)


@check("rolling_overwrite_program", f"{K} sl_pred:double", ["mart"], ROLL + """
SELECT e.* FROM e LEFT JOIN (SELECT ref_date, program_id, min(slot) AS m FROM b GROUP BY 1, 2) AS x USING (ref_date, program_id) WHERE m IS NULL OR slot < m
UNION ALL SELECT * FROM b""")
def _(s, d):
    old, new = _existing_and_batch(s, d)
    return forecast.rolling_overwrite(old, new, "program")


FACT = (f"{K} sl_pred:double vol_plan hc_plan:bigint aht_plan_avg sl_lag_1 avg_wait_lag_1 vol_dev_pct_lag_1 {P5}:double {DRIVERS} updated_at:timestamp")


@check("fact_schema", FACT, ["explained_infer"], "SELECT * REPLACE (" + ", ".join(
    f"cast({c} AS decimal({p})) AS {c}" for c, p in [("sl_pred", "5,4"), ("aht_plan_avg", "10,2"), ("sl_lag_1", "5,4"),
    ("avg_wait_lag_1", "10,4"), ("vol_dev_pct_lag_1", "10,4"), *[(c, "5,4") for c in catalog.PILLAR_COLUMNS],
    *[(f"{x}_{k}_impact", "5,4") for x in ("detractor", "booster") for k in (1, 2, 3)]]) +
    f"), cast({D} AS timestamp) AS updated_at FROM explained_infer")
def _(s, d):
    return forecast.fact_schema(scoring.explained(i.scored(s, d)), i.AS_OF)


@check("result_projection", f"{K} vol_actual vol_plan hc_plan:bigint sl_actual sl_plan_wfm:double", ["clean_infer"],
       "SELECT *, sl_plan AS sl_plan_wfm FROM clean_infer")
def _(s, d):
    return columns.result_projection(i.light(s, d), {"sl_plan": "sl_plan_wfm"}, scoring.RESULT_COLUMNS)


@check("attribution_store", "program_id row_num n_features:bigint first_impact last_impact base_value:double", ["scored_infer"],
       "SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY slot_ts, channel_id) AS row_num, "
       f"{len(demo.LINEAR_MODEL)} AS n_features, " + ", ".join(
           f"{w!r} * ({f} - {c!r}) AS {n}" for n, (f, w, c) in (("first_impact", demo.LINEAR_MODEL[0]), ("last_impact", demo.LINEAR_MODEL[-1])))
       + " FROM scored_infer")
def _(s, d):
    rows = history.row_index(i.scored(s, d).select("program_id", "channel_id", "slot_ts", "contribs", "base_value"))
    path = stores.save_attributions(rows, stages.new_stage(s, "attributions"))
    m = stores.load_attributions(s, path)
    return m.select("program_id", "row_num", F.size("features").alias("n_features"), F.get("impacts", F.lit(0)).alias("first_impact"),
                    F.element_at("impacts", -1).alias("last_impact"), "base_value")
