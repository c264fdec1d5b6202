"""Sort, limit, top-k, splits and set operations."""

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import drivers, metrics, reports, splits
from slotwise.sources import demo
from verification import inputs as i
from verification.registry import check
from verification.sqltext import D, metric_select

K = i.KEYS


@check("order_keys", f"{K} vol_plan vol_actual:bigint", ["mart"], "SELECT * FROM mart ORDER BY ref_date, slot, program_id")
def _(s, d):
    return reports.order_keys(i.mart(s, d))


@check("topn_plus_other", f"{K} step:bigint feature:string impact:double", ["long_infer"], """
SELECT ref_date, slot, program_id, channel_id, least(rk, 16) AS step,
 CASE WHEN rk > 15 THEN 'Outros (demais features)' ELSE feature END AS feature, sum(impact) AS impact
FROM (SELECT *, row_number() OVER (PARTITION BY ref_date, slot, program_id, channel_id ORDER BY abs(impact) DESC, position) AS rk FROM long_infer) AS r GROUP BY ALL""")
def _(s, d):
    steps = F.posexplode(drivers.top_plus_other(F.col("contribs"))).alias("p", "x")
    return i.scored(s, d).select(*catalog.KEYS, steps).select(
        *catalog.KEYS, (F.col("p") + 1).alias("step"), "x.feature", "x.impact")


@check("uplift_rank", "program_id:bigint uplift_mae_pct mae_model mae_plan:double", ["scored_infer"],
       f"SELECT program_id, {metric_select()} FROM scored_infer WHERE vol_actual > 0 GROUP BY 1 ORDER BY uplift_mae_pct DESC")
def _(s, d):
    return reports.uplift_rank(metrics.metrics_by_program(i.scored(s, d)))


@check("extreme_rows", f"which:string {K} sl_pred:double", ["scored_infer"], """
SELECT 'lowest' AS which, * FROM (SELECT * FROM scored_infer
 QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY sl_pred, ref_date, slot, channel_id) = 1) AS a
UNION ALL SELECT 'highest', * FROM (SELECT * FROM scored_infer
 QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY sl_pred DESC, ref_date, slot, channel_id) = 1) AS b""")
def _(s, d):
    return reports.extreme_rows(i.scored(s, d))


@check("bounded_sample", f"{K} vol_actual vol_plan:bigint sl_actual:double", ["clean_train"],
       "SELECT * FROM clean_train ORDER BY md5(concat_ws('|', strftime(ref_date, '%Y-%m-%d'), slot, program_id, channel_id, '42')) LIMIT 1000")
def _(s, d):
    """At most 1000 rows for a plot, the same ones on every run."""
    return splits.bounded_sample(i.light(s, d, "training"), catalog.KEYS, 1000, 42)


@check("latest_run", "suffix:string as_of:date", ["fx_runs"], "SELECT arg_max(suffix, as_of) AS suffix, max(as_of) AS as_of FROM fx_runs")
def _(s, d):
    return reports.latest_run(demo.runs(s, d), "as_of")


@check("head_tail_split", f"{K} row_num:bigint is_validation:boolean", ["clean_train"], """
SELECT *, row_num > n - ceil(n * 0.2::double) AS is_validation FROM (SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY slot_ts, channel_id) AS row_num,
 count(*) OVER (PARTITION BY program_id) AS n FROM clean_train) AS t""")
def _(s, d):
    return splits.head_tail_split(i.light(s, d, "training"), 0.2)


@check("date_split", f"{K} is_test:boolean", ["clean_train"], """
SELECT *, ref_date >= (SELECT min(ref_date) FROM (SELECT ref_date, row_number() OVER (ORDER BY ref_date DESC) AS rk, count(*) OVER () AS n
 FROM (SELECT DISTINCT ref_date FROM clean_train) AS u) AS x WHERE rk <= greatest(1, floor(n * 0.2))) AS is_test FROM clean_train""")
def _(s, d):
    return splits.date_split(i.light(s, d, "training"), 0.2)


@check("future_split", f"{K} is_future:boolean", ["clean_infer"], f"""
SELECT *, slot_ts > coalesce((SELECT max(slot_ts) FROM clean_infer WHERE vol_actual > 0), cast({D} AS timestamp)) AND slot_ts >= cast({D} AS timestamp) AS is_future FROM clean_infer""")
def _(s, d):
    return splits.future_split(i.light(s, d), i.AS_OF)


def run_dates(runs):
    """One row per run and evaluated date (at most the run's days)."""
    back = F.explode(F.sequence(F.lit(1), F.col("days")))
    return runs.select("suffix", "as_of", "days", back.alias("b")).select(
        "suffix", F.date_sub("as_of", F.col("b")).alias("ref_date"))


def run_scores(s, d):
    """Operational rows of every benchmark run, with run suffix; pred is a fixed rule."""
    rows = i.light(s, d).where("vol_actual > 0").withColumn("sl_pred", F.expr("0.5 * sl_plan + 0.4"))
    return rows.join(run_dates(demo.runs(s, d)), "ref_date")


RUN_SCORES = """(SELECT c.*, r.suffix, 0.5 * c.sl_plan + 0.4 AS sl_pred FROM clean_infer c JOIN fx_runs r
 ON c.ref_date >= r.as_of - cast(r.days AS int) AND c.ref_date < r.as_of WHERE vol_actual > 0) AS z"""


@check("programs_in_all_runs", "program_id:bigint", ["clean_infer", "fx_runs"],
       f"SELECT program_id FROM {RUN_SCORES} GROUP BY 1 HAVING count(DISTINCT suffix) = (SELECT count(DISTINCT suffix) FROM {RUN_SCORES})")
def _(s, d):
    return reports.programs_in_all_runs(run_scores(s, d).select("suffix", "program_id"))


@check("union_programs", "program_id n_rows vol_actual:bigint sl_pred:double", ["clean_infer"], """
SELECT program_id, count(*) AS n_rows, sum(vol_actual) AS vol_actual, avg(CASE WHEN program_id % 2 = 0 THEN sl_plan END) AS sl_pred FROM clean_infer GROUP BY 1""")
def _(s, d):
    rows = i.light(s, d)
    even = rows.where("program_id % 2 = 0").withColumn("sl_pred", F.col("sl_plan"))
    both = reports.union_programs([even, rows.where("program_id % 2 = 1")])
    return both.groupBy("program_id").agg(
        F.count("*").alias("n_rows"), F.sum("vol_actual").alias("vol_actual"), F.avg("sl_pred").alias("sl_pred"))


EXCLUDE = {900001: ["new_hire_pct_daily", "agent_issue_rate_daily", "program_enc", "vacation", "sl_lag_2", "is_weekend", "hour"]}


@check("feature_sets", "program_id position:bigint feature:string", ["fx_plan"], f"""
WITH g AS (SELECT unnest(range(0, {len(catalog.FEATURES)})) AS p, unnest({list(catalog.FEATURES)}) AS feature),
r AS (SELECT feature, p, CASE WHEN list_contains({catalog.GLOBAL_FEATURES}, feature) THEN list_position({catalog.GLOBAL_FEATURES}, feature)
 WHEN list_contains({catalog.OPTIONAL_FEATURES}, feature) THEN 100 + list_position({catalog.OPTIONAL_FEATURES}, feature) ELSE 200 + p END AS o FROM g)
SELECT program_id, row_number() OVER (PARTITION BY program_id ORDER BY o) - 1 AS position, feature
FROM (SELECT DISTINCT program_id FROM fx_plan) AS pr, r
WHERE o < 100 OR NOT (program_id = 900001 AND list_contains({EXCLUDE[900001]}, feature))""")
def _(s, d):
    sets = reports.feature_sets(demo.plan(s, d).select("program_id").distinct(), catalog.FEATURES, EXCLUDE)
    return sets.select("program_id", F.posexplode("features").alias("position", "feature"))
