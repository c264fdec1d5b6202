import datetime as dt

from pyspark.sql import functions as F

from slotwise.operators import daily
from slotwise.operators import mart as m
from slotwise.operators.columns import grain_check
from slotwise import catalog

AS_OF = dt.datetime(2024, 1, 31)
DAY = dt.date(2024, 1, 10)


def intraday(spark, rows):
    """rows: (program, minute, offered, in_sla, idle)"""
    df = spark.createDataFrame([(DAY, *r) for r in rows], "row_date date, program_id int, raw_minute int, offered int, answered_in_sla int, idle_sec int")
    df = df.withColumns({"channel_id": F.lit(7), "answered": F.col("offered"), "abandoned": F.lit(0)})
    rest = ["service_sec", "talk_sec", "wrap_sec", "hold_sec", "queue_sec", *m.PAUSES]
    return df.withColumns({c: F.lit(1) for c in rest})


def plan(spark, rows):
    """rows: (program, minute, calls, hc, sla, aht)"""
    df = spark.createDataFrame([(DAY, *r) for r in rows], "plan_date date, program_id int, raw_minute int, calls int, hc int, sla double, aht_sec int")
    return df.withColumn("channel_id", F.lit(7))


def agents(spark, rows):
    """rows: (program, agent, status, turnover, remote)"""
    df = spark.createDataFrame([(DAY, *r) for r in rows], "work_date date, program_id int, agent_id int, status_code int, turnover_type int, is_remote int")
    return df.withColumns({"absent_sec": F.lit(60), "scheduled_sec": F.lit(100), "missed_day": F.lit(1), "is_new_hire": F.lit(0)})


def test_mart_edges(spark):
    mart = m.interval_mart(
        intraday(spark, [(1, 449, 2, 1, 900), (1, 450, 3, 3, 1800), (1, 479, 1, 1, 600)]),
        plan(spark, [(1, 420, 0, 4, 0.9, 100), (1, 455, 2, 1, 0.8, 100), (1, 470, 6, 1, 0.4, 50), (2, 0, 5, 0, 0.5, 10)]),
        agents(spark, [(1, 10, 1, 0, 1), (1, 10, 1, 2, 0), (1, 11, 2, 0, 0), (3, 9, 1, 0, 0)]),
        AS_OF,
    )
    got = {(r.program_id, r.slot): r for r in mart.collect()}
    assert set(got) == {(1, 420), (1, 450), (2, 0)}
    a, b, c = got[1, 420], got[1, 450], got[2, 0]
    assert (a.vol_actual, a.vol_plan, a.hc_plan, a.sl_plan, float(a.hc_equiv)) == (2, 0, 4, 0.0, 0.5)
    assert (b.vol_actual, b.vol_in_sla, b.vol_plan, b.aht_plan_total, float(b.hc_equiv)) == (4, 4, 8, 500, 1.33)
    assert abs(b.sl_plan - (0.8 * 2 + 0.4 * 6) / 8) < 1e-12
    assert (c.vol_actual, c.vol_plan, c.absence_sec, float(c.hc_equiv)) == (0, 5, 0, 0.0)
    # two agents, one of them in two segments of the day
    assert (a.turnover_active, a.turnover_left, a.vacation, a.remote, a.absence_sec, a.missed_days) == (1, 1, 1, 1, 180, 3)
    assert (b.pause_tech_sec, b.pause_personal_sec, b.pause_mgmt_sec, b.aht_actual_total) == (4, 10, 6, 6)
    assert grain_check(mart, catalog.KEYS).count() == 0


def test_window_is_by_calendar_day(spark):
    old = intraday(spark, [(1, 0, 1, 1, 0)]).withColumn("row_date", F.lit(dt.date(2023, 11, 2)))
    older = old.withColumn("row_date", F.lit(dt.date(2023, 11, 1)))
    at_ten = AS_OF.replace(hour=10)
    assert m.intraday_agg(old, at_ten).count() == 1 and m.intraday_agg(older, at_ten).count() == 0


def system_time(spark, rows):
    """rows: (program, agent, crm, paid)"""
    df = spark.createDataFrame([(DAY, *r) for r in rows], "work_date date, program_id int, agent_id int, crm_logged_sec int, paid_sec int")
    return df.withColumns({c: F.lit(5) for c in ("sys_fail_sec", "client_fail_sec", "seat_sec", "agent_issue_sec")})


def test_fanout_keeps_sql_sums(spark):
    work = system_time(spark, [(1, 10, 100, 50), (1, 10, 30, None), (1, 99, 7, None), (2, 10, 1, 1), (3, 99, 2, None)])
    hr = agents(spark, [(1, 10, 1, 0, 0)] * 3).withColumn("is_new_hire", F.lit(1))
    naive = work.join(hr.drop("program_id"), ["work_date", "agent_id"], "left").groupBy("program_id").agg(
        F.sum(F.coalesce("crm_logged_sec", F.lit(0)) - F.coalesce("paid_sec", F.lit(0))).alias("log_gap_sec"),
        F.sum("paid_sec").alias("paid_sec"), F.count_if(F.col("is_new_hire") == 1).alias("new_hires"),
        F.count_distinct("agent_id").alias("hc_logged"))
    cols = ["program_id", "log_gap_sec", "paid_sec", "new_hires", "hc_logged"]
    got = sorted(tuple(r) for r in daily.log_gap_agg(work, hr).select(cols).collect())
    assert got == sorted(tuple(r) for r in naive.select(cols).collect())
    assert dict((g[0], g[2]) for g in got)[3] is None  # all null stays null
    deduped = {r.program_id: r.new_hires for r in daily.log_gap_agg(work, hr, dedupe=True).collect()}
    assert deduped == {1: 2, 2: 1, 3: 0}


def test_range_join_edges(spark):
    work = system_time(spark, [(1, 10, 0, 0), (1, 11, 0, 0), (1, 12, 0, 0)])
    versions = spark.createDataFrame([
        (10, DAY, DAY + dt.timedelta(days=1), 140468, 0), (11, DAY - dt.timedelta(days=5), DAY, 140468, 0),
        (12, DAY, DAY + dt.timedelta(days=9), 140468, 1)],
        "agent_id int, valid_from date, valid_to date, position_code int, excluded int")
    r = daily.validity_range_join(work, versions).first()
    assert (r.specialists, r.n_rows) == (1, 3)


def test_hot_program_does_not_change_the_result(spark):
    """A third of all calls in one slot: partial sums leave one row for it."""
    hot = spark.range(30_000).select(F.lit(1).alias("program_id"), F.lit(600).alias("raw_minute"))
    rest = spark.range(60_000).select((F.col("id") % 50 + 2).cast("int").alias("program_id"), (F.col("id") % 1440).cast("int").alias("raw_minute"))
    base = intraday(spark, [(1, 0, 1, 1, 0)]).drop("program_id", "raw_minute")
    rows = hot.union(rest).join(base)
    out = m.intraday_agg(rows, AS_OF)
    assert out.where("program_id = 1").first().vol_actual == 30_000
    assert out.agg(F.sum("vol_actual")).first()[0] == 90_000
