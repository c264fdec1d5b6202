"""Joins."""

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.operators import cleaning, daily, encoding, reports
from slotwise.operators import mart as mart_ops
from slotwise.sources import demo, forecast
from verification import inputs as i
from verification.registry import check
from verification.sqltext import D

K = i.KEYS


@check("full_outer_actual_plan", f"{K} vol_actual idle_sec pause_3 vol_plan sla_weighted:bigint", ["slots"], "SELECT * FROM slots")
def _(s, d):
    return mart_ops.full_outer_actual_plan(
        mart_ops.intraday_agg(demo.intraday(s, d), i.AS_OF), mart_ops.plan_agg(demo.plan(s, d), i.AS_OF))


@check("left_daily_people", f"{K} vol_plan absence_sec turnover_active remote:bigint", ["planned", "people"],
       "SELECT * FROM planned LEFT JOIN people USING (ref_date, program_id)")
def _(s, d):
    slots = mart_ops.plan_agg(demo.plan(s, d), i.AS_OF)
    return mart_ops.left_daily_people(slots, mart_ops.people_two_level(demo.agents(s, d), i.AS_OF))


FAN = "work_date:date program_id agent_id joined_rows log_gap_sec paid_sec tech_issue_sec new_hires:bigint"


@check("left_new_hire_fanout", FAN, ["fx_system", "fx_agents"], """
SELECT f.work_date, f.program_id, f.agent_id, count(*) AS joined_rows,
 sum(coalesce(crm_logged_sec, 0) - coalesce(paid_sec, 0)) AS log_gap_sec, sum(paid_sec) AS paid_sec,
 sum(sys_fail_sec + client_fail_sec + seat_sec) AS tech_issue_sec, sum(CASE WHEN is_new_hire = 1 THEN 1 ELSE 0 END) AS new_hires
FROM fx_system f LEFT JOIN fx_agents a ON f.work_date = a.work_date AND f.agent_id = a.agent_id GROUP BY ALL""")
def _(s, d):
    return daily.left_new_hire_fanout(demo.system_time(s, d), demo.agents(s, d))


@check("left_new_hire_dedupe", FAN, ["fx_system", "fx_agents"], """
SELECT f.work_date, f.program_id, f.agent_id, count(*) AS joined_rows,
 sum(coalesce(crm_logged_sec, 0) - coalesce(paid_sec, 0)) AS log_gap_sec, sum(paid_sec) AS paid_sec,
 sum(sys_fail_sec + client_fail_sec + seat_sec) AS tech_issue_sec, sum(CASE WHEN is_new_hire = 1 THEN 1 ELSE 0 END) AS new_hires
FROM fx_system f LEFT JOIN (SELECT work_date, agent_id, max(is_new_hire) AS is_new_hire FROM fx_agents GROUP BY 1, 2) a
  ON f.work_date = a.work_date AND f.agent_id = a.agent_id GROUP BY ALL""")
def _(s, d):
    return daily.left_new_hire_fanout(demo.system_time(s, d), demo.agents(s, d), dedupe=True)


@check("daily_broadcast_merge", f"{K} vol_actual {i.GAP_INTS}", ["raw_train"], "SELECT * FROM raw_train")
def _(s, d):
    return i.raw(s, d, "training")


PRED = "0.4 + 0.001 * (slot / 30)"


def demo_forecast(s, d):
    """A forecast for every planned slot from today on, derived from the mart."""
    m = i.mart(s, d).where((F.col("ref_date") >= F.lit(i.AS_OF.date())) & (F.col("vol_plan") > 1))
    return m.select(*catalog.KEYS, F.expr(PRED).alias("sl_pred"))


FC = f"(SELECT ref_date, slot, program_id, channel_id, {PRED} AS sl_pred FROM mart WHERE ref_date >= {D} AND vol_plan > 1) AS f"


@check("left_forecast", f"{K} vol_actual vol_plan:bigint sl_pred:double", ["mart"],
       f"SELECT mart.*, f.sl_pred FROM mart LEFT JOIN {FC} USING (ref_date, slot, program_id, channel_id)")
def _(s, d):
    return reports.left_forecast(i.mart(s, d), demo_forecast(s, d))


@check("inner_forecast_actual", f"{K} vol_actual vol_plan:bigint sl_pred:double", ["mart"],
       f"SELECT mart.*, f.sl_pred FROM mart JOIN {FC} USING (ref_date, slot, program_id, channel_id)")
def _(s, d):
    return reports.inner_forecast_actual(demo_forecast(s, d), i.mart(s, d))


@check("encoding_lookup", f"{K} program_enc:double", ["clean_infer", "enc_train"],
       "SELECT c.*, coalesce(enc, (SELECT max(global_mean) FROM enc_train), 0.5) AS program_enc "
       "FROM clean_infer c LEFT JOIN enc_train USING (program_id)")
def _(s, d):
    return encoding.encoding_lookup(i.light(s, d), i.stored_encoding(s, d))


@check("encoding_override", f"{K} program_enc:double enc_mismatch:boolean", ["clean_infer", "enc_train"], """
SELECT c.*, coalesce(enc, 0.5) AS program_enc, coalesce(abs(0.5 - enc) > 1e-6, false) AS enc_mismatch
FROM clean_infer c LEFT JOIN enc_train USING (program_id)""")
def _(s, d):
    return encoding.encoding_override(i.light(s, d).withColumn("program_enc", F.lit(0.5)), i.stored_encoding(s, d))


@check("active_semi", f"{K} vol_actual:bigint", ["mart_train"],
       "SELECT * FROM mart_train WHERE program_id IN (SELECT program_id FROM mart_train GROUP BY 1 HAVING sum(vol_actual) > 0)")
def _(s, d):
    return cleaning.active_semi(i.live_mart(s, d, "training"))


@check("stale_anti", f"{K} vol_plan:bigint", ["mart"], """
SELECT m.* FROM mart m LEFT JOIN (SELECT ref_date, min(slot) AS min_slot FROM mart
  WHERE vol_plan > 3 AND slot >= 600 GROUP BY 1) b USING (ref_date)
WHERE min_slot IS NULL OR slot < min_slot""")
def _(s, d):
    m = i.mart(s, d)
    return forecast.stale_anti(m, m.where("vol_plan > 3 AND slot >= 600"))


@check("validity_range_join", "ref_date:date program_id specialists n_rows:bigint", ["fx_system", "fx_validity"], """
SELECT f.work_date AS ref_date, f.program_id, sum(CASE WHEN position_code = 140468 THEN 1 ELSE 0 END) AS specialists, count(*) AS n_rows
FROM fx_system f LEFT JOIN fx_validity v ON f.agent_id = v.agent_id AND f.work_date >= v.valid_from
 AND f.work_date < v.valid_to AND v.excluded = 0 GROUP BY 1, 2""")
def _(s, d):
    return daily.validity_range_join(demo.system_time(s, d), demo.validity(s, d))
