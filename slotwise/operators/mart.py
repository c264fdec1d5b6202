"""Interval mart: actuals and plan at 30-minute grain, with daily people facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions.clock import slot_floor
from slotwise.functions.numbers import zero_if_null

PAUSES = [f"pause_{i}" for i in range(10)]

# Pause codes of each group.
PAUSE_GROUPS = {
    "pause_tech_sec": [0, 7],
    "pause_personal_sec": [1, 2, 4, 8, 9],
    "pause_mgmt_sec": [3, 5, 6],
}

INTRADAY_SUMS = {
    "vol_actual": "offered",
    "vol_answered": "answered",
    "vol_in_sla": "answered_in_sla",
    "vol_abandoned": "abandoned",
    "service_sec": "service_sec",
    "talk_sec": "talk_sec",
    "wrap_sec": "wrap_sec",
    "hold_sec": "hold_sec",
    "queue_sec": "queue_sec",
    "idle_sec": "idle_sec",
    **{p: p for p in PAUSES},
}


def since(date_col: str, as_of: dt.datetime, days: int = 90):
    """Rows from `days` calendar days before as_of on (that day included)."""
    return F.col(date_col) >= F.lit(as_of.date() - dt.timedelta(days=days))


def intraday_agg(intraday: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    """Sum the 20 intraday measures per program, date, slot and channel.

    Partial sums run before the only exchange, so a hot program costs its
    slots, not its calls.
    """
    return (
        intraday.where(since("row_date", as_of, days))
        .groupBy(
            F.col("row_date").alias("ref_date"),
            slot_floor("raw_minute").alias("slot"),
            "program_id",
            "channel_id",
        )
        .agg(*[F.sum(src).alias(name) for name, src in INTRADAY_SUMS.items()])
    )


def plan_agg(plan: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    """Planned calls, headcount and the call-weighted SLA / handle time."""
    return (
        plan.where(since("plan_date", as_of, days))
        .groupBy(
            F.col("plan_date").alias("ref_date"),
            slot_floor("raw_minute").alias("slot"),
            "program_id",
            "channel_id",
        )
        .agg(
            F.sum("calls").alias("vol_plan"),
            F.sum("hc").alias("hc_plan"),
            F.sum(F.col("sla") * F.col("calls")).alias("sla_weighted"),
            F.sum(F.col("aht_sec") * F.col("calls")).alias("aht_weighted"),
        )
    )


def people_by_agent(agents: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    def flag(cond):
        return F.max(F.when(cond, 1).otherwise(0))

    return (
        agents.where(since("work_date", as_of, days))
        .groupBy("program_id", F.col("work_date").alias("ref_date"), "agent_id")
        .agg(
            F.sum("absent_sec").alias("absence_sec"),
            F.sum("scheduled_sec").alias("scheduled_sec"),
            F.sum("missed_day").alias("missed_days"),
            flag(F.col("status_code") == 1).alias("turnover_active"),
            flag(F.col("turnover_type") > 0).alias("turnover_left"),
            flag(F.col("status_code") == 2).alias("vacation"),
            flag(F.col("is_remote") == 1).alias("remote"),
        )
    )


PEOPLE_MEASURES = [
    "absence_sec",
    "scheduled_sec",
    "missed_days",
    "turnover_active",
    "turnover_left",
    "vacation",
    "remote",
]


def people_two_level(agents: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    """Agent-day flags first, then their sum: distinct agents without a distinct count."""
    return (
        people_by_agent(agents, as_of, days)
        .groupBy("program_id", "ref_date")
        .agg(*[F.sum(m).alias(m) for m in PEOPLE_MEASURES])
    )


def people_distinct(agents: DataFrame, as_of: dt.datetime, days: int = 90) -> DataFrame:
    """The same table with COUNT(DISTINCT); kept as a cross-check of the two-level form."""

    def agents_where(cond):
        return F.count_distinct(F.when(cond, F.col("agent_id")))

    return (
        agents.where(since("work_date", as_of, days))
        .groupBy("program_id", F.col("work_date").alias("ref_date"))
        .agg(
            F.sum("absent_sec").alias("absence_sec"),
            F.sum("scheduled_sec").alias("scheduled_sec"),
            F.sum("missed_day").alias("missed_days"),
            agents_where(F.col("status_code") == 1).alias("turnover_active"),
            agents_where(F.col("turnover_type") > 0).alias("turnover_left"),
            agents_where(F.col("status_code") == 2).alias("vacation"),
            agents_where(F.col("is_remote") == 1).alias("remote"),
        )
    )


def full_outer_actual_plan(actual: DataFrame, plan: DataFrame) -> DataFrame:
    """Keep overtime slots (actual only) and outage slots (plan only).

    Both sides are already at slot grain, so the key is unique on each side and
    no key can be hot.
    """
    return actual.join(plan, catalog.KEYS, "full_outer")


def left_daily_people(slots: DataFrame, people: DataFrame) -> DataFrame:
    """One people row per program-day fans out to that day's slots.

    No broadcast hint: the people table grows with programs and days, so the
    choice is left to the runtime size check of adaptive execution.
    """
    return slots.join(people, ["ref_date", "program_id"], "left")


def null_to_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or [c for c in df.columns if c not in catalog.KEYS]
    return df.withColumns({c: zero_if_null(c) for c in cols})


def hc_equiv(df: DataFrame) -> DataFrame:
    """Idle seconds as full-slot agents."""
    return df.withColumn(
        "hc_equiv",
        (zero_if_null("idle_sec") / F.lit(float(catalog.SLOT_SECONDS))).cast("decimal(10,2)"),
    )


def weighted_plan(df: DataFrame, sla_scale: float = 1.0) -> DataFrame:
    """Call-weighted plan SLA (0 without calls) and total planned handle time."""
    vol = zero_if_null("vol_plan")
    sla = F.col("sla_weighted").cast("double") / F.when(vol > 0, vol) / F.lit(float(sla_scale))
    return df.withColumns(
        {
            "sl_plan": F.coalesce(F.when(vol > 0, sla), F.lit(0.0)),
            "aht_plan_total": zero_if_null("aht_weighted"),
        }
    )


def time_groups(df: DataFrame) -> DataFrame:
    def add(cols):
        out = zero_if_null(cols[0])
        for c in cols[1:]:
            out = out + zero_if_null(c)
        return out

    return df.withColumns(
        {
            "aht_actual_total": add(["talk_sec", "hold_sec", "wrap_sec"]),
            "wait_total": zero_if_null("queue_sec"),
            **{g: add([f"pause_{i}" for i in codes]) for g, codes in PAUSE_GROUPS.items()},
        }
    )


def interval_mart(
    intraday: DataFrame,
    plan: DataFrame,
    agents: DataFrame,
    as_of: dt.datetime,
    days: int = 90,
    sla_scale: float = 1.0,
) -> DataFrame:
    """One row per program, channel, date and slot; see catalog.MART_COLUMNS."""
    slots = full_outer_actual_plan(intraday_agg(intraday, as_of, days), plan_agg(plan, as_of, days))
    wide = left_daily_people(slots, people_two_level(agents, as_of, days))
    wide = wide.transform(hc_equiv).transform(weighted_plan, sla_scale).transform(time_groups)
    volumes = ["vol_plan", "vol_actual", "vol_answered", "vol_in_sla", "vol_abandoned", "hc_plan"]
    return null_to_zero(wide, volumes + PEOPLE_MEASURES).select(*catalog.MART_COLUMNS)
