"""Agent-day system time: log gap, technical issues and new hires per program-day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.numbers import zero_if_null


def new_hire_rows(agents: DataFrame, dedupe: bool = False) -> DataFrame:
    """HR rows and new-hire rows per agent-day, the fan-out factor of the join below."""
    if dedupe:
        agents = agents.groupBy("work_date", "agent_id").agg(F.max("is_new_hire").alias("is_new_hire"))
    return agents.groupBy("work_date", "agent_id").agg(
        F.count("*").alias("hr_rows"),
        F.count_if(F.col("is_new_hire") == 1).alias("hire_rows"),
    )


def _sums() -> dict:
    z = zero_if_null
    return {
        "log_gap_sec": z("crm_logged_sec") - z("paid_sec"),
        "paid_sec": F.col("paid_sec"),
        "sys_fail_sec": z("sys_fail_sec"),
        "client_fail_sec": z("client_fail_sec"),
        "seat_sec": z("seat_sec"),
        "tech_issue_sec": z("sys_fail_sec") + z("client_fail_sec") + z("seat_sec"),
        "agent_issue_sec": z("agent_issue_sec"),
    }


def left_new_hire_fanout(system_time: DataFrame, agents: DataFrame, dedupe: bool = False) -> DataFrame:
    """Agent-day totals of the left join system time x HR rows.

    The join multiplies every system-time row by the HR rows of that agent-day.
    Instead of producing those copies, both sides are pre-aggregated to the
    agent-day and the sums are scaled by the fan-out factor: same integers,
    and no agent-day can blow up a task.
    """
    work = system_time.groupBy("work_date", "program_id", "agent_id").agg(
        F.count("*").alias("n_rows"), *[F.sum(e).alias(n) for n, e in _sums().items()]
    )
    hr = new_hire_rows(agents, dedupe)
    times = F.coalesce(F.col("hr_rows"), F.lit(1))
    joined = work.join(hr, ["work_date", "agent_id"], "left")
    return joined.select(
        "work_date",
        "program_id",
        "agent_id",
        (F.col("n_rows") * times).alias("joined_rows"),
        *[(F.col(n) * times).alias(n) for n in _sums()],
        (F.col("n_rows") * F.coalesce("hire_rows", F.lit(0))).alias("new_hires"),
    )


def log_gap_agg(system_time: DataFrame, agents: DataFrame, dedupe: bool = False) -> DataFrame:
    """Per program-day; paid_sec keeps SQL's null (all null -> null).

    Agent-days are unique after the pre-aggregation, so the distinct agent
    count is a plain count.
    """
    measures = [*_sums(), "new_hires"]
    return (
        left_new_hire_fanout(system_time, agents, dedupe)
        .groupBy(F.col("work_date").alias("ref_date"), "program_id")
        .agg(*[F.sum(m).alias(m) for m in measures], F.count("agent_id").alias("hc_logged"))
    )


def daily_merge(slots: DataFrame, daily: DataFrame) -> DataFrame:
    """Fan daily facts out to slots; an empty daily table simply gives nulls."""
    key_types = {f.name: f.dataType for f in slots.schema.fields}
    daily = daily.withColumns({k: F.col(k).cast(key_types[k]) for k in ("program_id", "ref_date")})
    return slots.join(daily, ["program_id", "ref_date"], "left")


def validity_range_join(
    system_time: DataFrame, versions: DataFrame, position: int = 140468, bucket_days: int = 28
) -> DataFrame:
    """Rows per program-day whose agent held a position on that day.

    Work rows are first reduced to agent-days. A version is then repeated for
    every time bucket its validity touches inside the span of the work days, so
    the join is an equality on (agent, bucket) and the range is only tested
    within one bucket, however many versions an agent has.
    """
    days = system_time.groupBy("work_date", "program_id", "agent_id").agg(F.count("*").alias("n_rows"))

    def bucket(c):
        return F.floor(F.unix_date(c) / bucket_days).cast("int")

    span = days.agg(F.struct(F.min("work_date").alias("first"), F.max("work_date").alias("last"))).scalar()
    v = (
        versions.where("excluded = 0 AND valid_from < valid_to")
        .withColumn("_span", span)
        .withColumns({"_lo": F.greatest("valid_from", "_span.first"), "_hi": F.least(F.date_sub("valid_to", 1), "_span.last")})
        .where(F.col("_lo") <= F.col("_hi"))
        .withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_lo")), bucket(F.col("_hi")))))
        .select("agent_id", "_bucket", "valid_from", "valid_to", "position_code")
    )
    d, v = days.withColumn("_bucket", bucket(F.col("work_date"))).alias("d"), v.alias("v")
    joined = d.join(
        v,
        (F.col("d.agent_id") == F.col("v.agent_id"))
        & (F.col("d._bucket") == F.col("v._bucket"))
        & (F.col("work_date") >= F.col("valid_from"))
        & (F.col("work_date") < F.col("valid_to")),
        "left",
    )
    return joined.groupBy(F.col("work_date").alias("ref_date"), "program_id").agg(
        F.sum(F.when(F.col("position_code") == position, F.col("n_rows")).otherwise(0)).alias("specialists"),
        F.sum("n_rows").alias("n_rows"),
    )
