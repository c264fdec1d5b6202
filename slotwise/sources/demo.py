"""Contact-centre tables derived from the generic test tables.

Every measure is an integer, so sums are exact in any engine. Program 900005
has a plan but never any actuals; channel 7 is the modelled one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.config import EngineConfig, ModelConfig

AS_OF = dt.datetime(2024, 1, 31)
PROGRAMS = tuple(range(900000, 900006))

INTRADAY_SQL = """
SELECT event_id,
       cast(ts AS date) AS row_date,
       cast(hour(ts) * 60 + minute(ts) AS int) AS raw_minute,
       cast(900000 + user_id % 5 AS int) AS program_id,
       CASE WHEN event_id % 10 < 8 THEN 7 ELSE 3 END AS channel_id,
       1 AS offered,
       CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS answered,
       CASE WHEN event_type <> 'error'
             AND cast(regexp_extract(props, '([0-9]+)', 1) AS int) < 80 THEN 1 ELSE 0 END AS answered_in_sla,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS abandoned,
       cast(CASE WHEN event_type <> 'error' THEN floor(value) ELSE 0 END AS bigint) AS talk_sec,
       cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS hold_sec,
       cast(event_id % 45 AS int) AS wrap_sec,
       cast(event_id % 90 AS int) AS queue_sec,
       cast(600 * (1 + user_id % 4) AS int) AS idle_sec,
       cast(event_id % 45 AS int) + cast(600 * (1 + user_id % 4) AS int) AS service_sec,
       {pauses}
FROM events
""".format(
    pauses=",\n       ".join(
        f"CASE WHEN event_id % 10 = {i} THEN cast(event_id % 240 AS int) ELSE 0 END AS pause_{i}"
        for i in range(10)
    )
)

PLAN_SQL = """
SELECT DATE '2024-01-01' + cast(o_orderkey % 37 AS int) AS plan_date,
       cast(30 * (cast(floor(o_orderkey / 37) AS int) % 48) + 10 * (o_orderkey % 3) AS int) AS raw_minute,
       cast(900000 + o_custkey % 6 AS int) AS program_id,
       7 AS channel_id,
       cast(o_orderkey % 5 AS int) AS calls,
       cast(o_custkey % 4 AS int) AS hc,
       cast(50 + o_orderkey % 50 AS int) AS sla,
       cast(60 + o_custkey % 240 AS int) AS aht_sec
FROM orders
"""

AGENTS_SQL = """
SELECT DATE '2024-01-01' + cast(l_orderkey % 37 AS int) AS work_date,
       cast(900000 + l_suppkey % 6 AS int) AS program_id,
       cast(l_suppkey AS int) AS agent_id,
       cast(l_quantity AS int) * 60 AS absent_sec,
       21600 AS scheduled_sec,
       CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS missed_day,
       cast(1 + l_orderkey % 3 AS int) AS status_code,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 2 ELSE 0 END AS turnover_type,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_remote,
       CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END AS is_new_hire
FROM lineitem
"""

SYSTEM_TIME_SQL = """
SELECT DATE '2024-01-01' + cast(o_orderkey % 37 AS int) AS work_date,
       cast(900000 + o_custkey % 6 AS int) AS program_id,
       cast(o_custkey % 100 AS int) AS agent_id,
       cast(20000 + o_orderkey % 3000 AS int) AS crm_logged_sec,
       CASE WHEN o_orderkey % 11 = 0 THEN null ELSE 21600 END AS paid_sec,
       cast(o_orderkey % 300 AS int) AS sys_fail_sec,
       CASE WHEN o_orderstatus = 'F' THEN 120 ELSE 0 END AS client_fail_sec,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 300 ELSE 0 END AS seat_sec,
       cast(o_orderkey % 200 AS int) AS agent_issue_sec
FROM orders
"""

# Agent attribute history: one weekly version per distinct line number an agent has.
VALIDITY_SQL = """
SELECT agent_id,
       DATE '2024-01-01' + cast(7 * (k - 1) + agent_id % 5 AS int) AS valid_from,
       DATE '2024-01-01' + cast(7 * k + agent_id % 5 AS int) AS valid_to,
       CASE WHEN (agent_id + k) % 4 = 0 THEN 140468 ELSE 1 END AS position_code,
       CASE WHEN (agent_id + k) % 9 = 0 THEN 1 ELSE 0 END AS excluded
FROM (SELECT DISTINCT cast(l_suppkey AS int) AS agent_id, cast(l_linenumber AS int) AS k
      FROM lineitem) AS versions
"""

# Benchmark runs: one per week that has events, evaluated over 7 or 14 days.
RUNS_SQL = """
SELECT concat(suffix_date, '_030000_', cast(days AS {text}), 'd') AS suffix, as_of, days
FROM (SELECT as_of, CASE WHEN k % 2 = 0 THEN 7 ELSE 14 END AS days,
             replace(cast(as_of AS {text}), '-', '') AS suffix_date
      FROM (SELECT DISTINCT cast(floor((day(ts) - 1) / 7) AS int) AS k,
                   DATE '2024-01-08' + 7 * cast(floor((day(ts) - 1) / 7) AS int) AS as_of
            FROM events) AS weeks) AS dated
"""


# Declared schemas: reading then needs no job that looks into file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    """Run a derivation over one test table, bound as a DataFrame argument."""
    return spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: table(spark, sf_dir, source)})


def intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, INTRADAY_SQL, "events")


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PLAN_SQL, "orders")


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, AGENTS_SQL, "lineitem")


def system_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SYSTEM_TIME_SQL, "orders")


def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, VALIDITY_SQL, "lineitem")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RUNS_SQL.format(text="string"), "events")


def config(mode: str = "inference", **kw) -> EngineConfig:
    kw.setdefault("model", ModelConfig())
    return EngineConfig(as_of=AS_OF, programs=PROGRAMS, mode=mode, plan_sla_scale=100.0, **kw)


# A fixed linear model in target space: (feature, weight, center). It covers every
# pillar with both signs, and has more than 15 inputs so that a waterfall has a rest.
LINEAR_BASE = 0.4
LINEAR_MODEL = [
    ("vol_plan", 0.01217339171, 3.0),
    ("hc_plan", -0.01517339171, 2.0),
    ("aht_plan_total", 0.0000217339171, 400.0),
    ("hour", 0.00217339171, 11.0),
    ("absence_rate_daily", 0.317339171, 0.07),
    ("vacation", -0.000417339171, 15.0),
    ("avg_wait_lag_1", 0.001517339171, 20.0),
    ("vol_dev_pct_lag_1", 0.0317339171, -0.5),
    ("strain_index", 0.1117339171, 0.1),
    ("capacity_margin", -0.0717339171, 0.6),
    ("log_gap_rate_daily", 0.0517339171, 0.1),
    ("sl_mean_3", -0.2517339171, 0.4),
    ("sl_lag_1", -0.1217339171, 0.4),
    ("sl_accel", -0.0617339171, 0.0),
    ("program_enc", -0.217339171, 0.6),
    ("is_peak_hour", 0.0117339171, 0.2),
    ("is_weekend", -0.000517339171, 0.3),
    ("sl_plan", -0.0817339171, 0.5),
]
LINEAR_FEATURES = [f for f, _, _ in LINEAR_MODEL]


def linear_coefs(programs: DataFrame) -> DataFrame:
    """The fixed model for every program of the given one-column table."""
    return programs.select(
        "program_id",
        F.array(*[F.lit(w) for _, w, _ in LINEAR_MODEL]).alias("weights"),
        F.array(*[F.lit(c) for _, _, c in LINEAR_MODEL]).alias("centers"),
        F.lit(LINEAR_BASE).alias("base_value"),
        F.array(*[F.lit(f) for f in LINEAR_FEATURES]).alias("features"),
    )


# A fixed forest in target space, as nested cuts: (feature, threshold, cover, left, right) or a leaf (value, cover). Paths
# ask a feature again, and trees differ in weight.
FOREST = [
    (1.0, ("sl_lag_1", 0.45171, 1000.0,
           ("vol_plan", 2.0, 600.0, (0.3121339171, 350.0), (0.2217339171, 250.0)), ("hour", 12.0, 400.0, (0.1217339171, 180.0), (0.0517339171, 220.0)))),
    (0.5, ("vol_plan", 1.0, 1000.0,
           (-0.0417339171, 300.0), ("vol_plan", 3.0, 700.0, (0.0611339171, 420.0), ("sl_lag_1", 0.70173, 280.0, (0.1013339171, 200.0), (-0.0231339171, 80.0))))),
    (0.5, ("capacity_margin", 0.50171, 1000.0,
           ("hour", 9.0, 450.0, (0.0819339171, 150.0), (-0.0317339171, 300.0)), ("capacity_margin", 0.90171, 550.0, (0.0117339171, 350.0), (0.0413339171, 200.0)))),
]
FOREST_FEATURES = ["sl_lag_1", "vol_plan", "hour", "capacity_margin"]


def forest_nodes(programs: DataFrame) -> DataFrame:
    """The fixed forest as a node table, for every program of the given one-column table."""
    rows: list[tuple] = []
    for tree, (weight, top) in enumerate(FOREST):
        todo = [(0, top)]
        while todo:
            node, own = todo.pop()
            if len(own) == 2:
                rows.append((tree, weight, node, -1, -1, None, None, *own))
                continue
            feature, threshold, cover, left, right = own
            rows.append((tree, weight, node, 2 * node + 1, 2 * node + 2, feature, threshold, 0.0, cover))
            todo += [(2 * node + 1, left), (2 * node + 2, right)]
    schema = "tree int, weight double, node int, left int, right int, feature string, threshold double, value double, cover double"
    fields = [f.split() for f in schema.split(", ")]
    every = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, fields)]) for r in rows])
    return programs.select("program_id", F.lit("fixed").alias("member"), F.inline(every))
