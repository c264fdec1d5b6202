"""Common table expressions for the SQL side of the checks.

Written against the test tables in plain SQL (DuckDB dialect), independently of
the Spark operators.
"""

from __future__ import annotations

from math import factorial

from slotwise import catalog
from slotwise.sources import demo

D = "DATE '2024-01-31'"  # as_of


def div(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) > 0 THEN cast(({num}) AS double) / ({den}) ELSE 0.0 END"


def _sum(expr: str, name: str) -> str:
    return f"cast(sum({expr}) AS bigint) AS {name}"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql.strip())


def with_ctes(needs: list[str], select: str) -> str:
    """Prefix a SELECT with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return select.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select.strip()}"


cte("fx_intraday", [], demo.INTRADAY_SQL)
cte("fx_plan", [], demo.PLAN_SQL)
cte("fx_agents", [], demo.AGENTS_SQL)
cte("fx_system", [], demo.SYSTEM_TIME_SQL)
cte("fx_validity", [], demo.VALIDITY_SQL)
cte("fx_runs", [], demo.RUNS_SQL.format(text="varchar"))

ACTUAL_SUMS = {
    "vol_actual": "offered", "vol_answered": "answered", "vol_in_sla": "answered_in_sla",
    "vol_abandoned": "abandoned", "service_sec": "service_sec", "talk_sec": "talk_sec",
    "wrap_sec": "wrap_sec", "hold_sec": "hold_sec", "queue_sec": "queue_sec", "idle_sec": "idle_sec",
    **{f"pause_{i}": f"pause_{i}" for i in range(10)},
}
cte("actual", ["fx_intraday"], f"""
SELECT row_date AS ref_date, cast(raw_minute - raw_minute % 30 AS int) AS slot, program_id, channel_id,
       {", ".join(_sum(s, n) for n, s in ACTUAL_SUMS.items())}
FROM fx_intraday WHERE row_date >= {D} - 90 GROUP BY ALL
""")
cte("planned", ["fx_plan"], f"""
SELECT plan_date AS ref_date, cast(raw_minute - raw_minute % 30 AS int) AS slot, program_id, channel_id,
       {_sum("calls", "vol_plan")}, {_sum("hc", "hc_plan")},
       {_sum("sla * calls", "sla_weighted")}, {_sum("aht_sec * calls", "aht_weighted")}
FROM fx_plan WHERE plan_date >= {D} - 90 GROUP BY ALL
""")
cte("people", ["fx_agents"], f"""
SELECT program_id, work_date AS ref_date,
       {_sum("absent_sec", "absence_sec")}, {_sum("scheduled_sec", "scheduled_sec")}, {_sum("missed_day", "missed_days")},
       count(DISTINCT CASE WHEN status_code = 1 THEN agent_id END) AS turnover_active,
       count(DISTINCT CASE WHEN turnover_type > 0 THEN agent_id END) AS turnover_left,
       count(DISTINCT CASE WHEN status_code = 2 THEN agent_id END) AS vacation,
       count(DISTINCT CASE WHEN is_remote = 1 THEN agent_id END) AS remote
FROM fx_agents WHERE work_date >= {D} - 90 GROUP BY ALL
""")


def _c(*names: str) -> str:
    return " + ".join(f"coalesce({n}, 0)" for n in names)


cte("slots", ["actual", "planned"], "SELECT * FROM actual FULL OUTER JOIN planned USING (ref_date, slot, program_id, channel_id)")
cte("mart", ["slots", "people"], f"""
SELECT s.ref_date, s.slot, s.program_id, s.channel_id,
       coalesce(vol_plan, 0) AS vol_plan, coalesce(vol_actual, 0) AS vol_actual,
       coalesce(vol_answered, 0) AS vol_answered, coalesce(vol_in_sla, 0) AS vol_in_sla,
       coalesce(vol_abandoned, 0) AS vol_abandoned,
       CASE WHEN coalesce(vol_plan, 0) > 0 THEN cast(sla_weighted AS double) / vol_plan / 100.0 ELSE 0.0 END AS sl_plan,
       coalesce(hc_plan, 0) AS hc_plan,
       cast(coalesce(idle_sec, 0) / 1800.0 AS decimal(10,2)) AS hc_equiv,
       coalesce(aht_weighted, 0) AS aht_plan_total,
       {_c("talk_sec", "hold_sec", "wrap_sec")} AS aht_actual_total,
       coalesce(queue_sec, 0) AS wait_total,
       {_c("pause_0", "pause_7")} AS pause_tech_sec,
       {_c("pause_1", "pause_2", "pause_4", "pause_8", "pause_9")} AS pause_personal_sec,
       {_c("pause_3", "pause_5", "pause_6")} AS pause_mgmt_sec,
       coalesce(absence_sec, 0) AS absence_sec, coalesce(scheduled_sec, 0) AS scheduled_sec,
       coalesce(turnover_active, 0) AS turnover_active, coalesce(turnover_left, 0) AS turnover_left,
       coalesce(vacation, 0) AS vacation, coalesce(missed_days, 0) AS missed_days, coalesce(remote, 0) AS remote
FROM slots s LEFT JOIN people p ON s.ref_date = p.ref_date AND s.program_id = p.program_id
""")
# The naive fan-out join; Spark computes the same numbers from pre-aggregates.
LOG_GAP_SELECT = """
       cast(sum(coalesce(crm_logged_sec, 0) - coalesce(paid_sec, 0)) AS bigint) AS log_gap_sec,
       cast(sum(paid_sec) AS bigint) AS paid_sec,
       cast(sum(coalesce(sys_fail_sec, 0)) AS bigint) AS sys_fail_sec,
       cast(sum(coalesce(client_fail_sec, 0)) AS bigint) AS client_fail_sec,
       cast(sum(coalesce(seat_sec, 0)) AS bigint) AS seat_sec,
       cast(sum(coalesce(sys_fail_sec, 0) + coalesce(client_fail_sec, 0) + coalesce(seat_sec, 0)) AS bigint) AS tech_issue_sec,
       cast(sum(coalesce(agent_issue_sec, 0)) AS bigint) AS agent_issue_sec,
       cast(sum(CASE WHEN is_new_hire = 1 THEN 1 ELSE 0 END) AS bigint) AS new_hires"""


def log_gap(lower: str, upper: str) -> str:
    return f"""
SELECT f.work_date AS ref_date, f.program_id, {LOG_GAP_SELECT}, count(DISTINCT f.agent_id) AS hc_logged
FROM fx_system f LEFT JOIN fx_agents a ON f.work_date = a.work_date AND f.agent_id = a.agent_id
WHERE f.work_date >= {lower} AND f.work_date <= {upper} GROUP BY ALL
"""


# Windows seen from as_of: inference looks 30 days back and 7 ahead, training 90 back without bound.
WINDOW = {
    "inference": (f"{D} - 30", f"{D} + 7"),
    "training": (f"{D} - 90", "DATE '2999-12-31'"),
    "benchmark": (f"{D} - 22", f"{D} - 1"),  # 7 evaluated + 15 warm-up days
}


def _clean(raw: str, training: bool) -> str:
    keep = """
 AND vol_actual >= 1
 AND program_id IN (SELECT program_id FROM {raw} GROUP BY program_id HAVING sum(vol_actual) > 0)""".format(raw=raw)
    measures = ["paid_sec", "log_gap_sec", "sys_fail_sec", "client_fail_sec", "seat_sec", "tech_issue_sec",
                "agent_issue_sec", "new_hires", "hc_logged"]
    return f"""
SELECT * REPLACE ({", ".join(f"coalesce({m}, 0) AS {m}" for m in measures)},
                  greatest(0.0, least(1.0, sl_plan)) AS sl_plan),
       cast(ref_date AS timestamp) + to_minutes(slot) AS slot_ts,
       cast(floor(slot / 60) AS int) AS hour, cast(isodow(ref_date) - 1 AS int) AS weekday,
       greatest(0.0, least(1.0, {div("vol_in_sla", "vol_actual")})) AS sl_actual
FROM {raw} WHERE (vol_plan > 0 OR vol_actual > 0 OR hc_plan > 0) {keep if training else ""}
"""


HC = "cast(hc_equiv AS double)"
CAP = "(hc_plan * 1800)"
LOGGED = f"({HC} * 1800)"
DERIVED = {
    "vol_delta": "vol_actual - vol_plan",
    "hc_delta": f"{HC} - hc_plan",
    "aht_actual_avg": div("aht_actual_total", "vol_answered"),
    "aht_plan_avg": div("aht_plan_total", "vol_plan"),
    "pressure_vol_hc": div("vol_plan", "hc_plan"),
    "strain_index": div("aht_plan_total", CAP),
    "vol_per_agent": div("vol_plan", "hc_plan"),
    "occupancy_synth": div("vol_plan * aht_plan_total", CAP),
    "capacity_margin": div(f"{CAP} - vol_plan", CAP),
    "staffing_dev_pct": div(f"{HC} - hc_plan", "hc_plan"),
    "staffing_ratio": div(HC, "hc_plan"),
    "overload_rate": div("vol_actual", LOGGED),
    "absence_rate_daily": div("absence_sec", "scheduled_sec"),
    "turnover_rate_daily": div("turnover_left", "turnover_active"),
    "abandon_rate": div("vol_abandoned", "vol_actual"),
    "avg_wait": div("wait_total", "vol_actual"),
    "occupancy": div("aht_actual_total", LOGGED),
    "pause_tech_rate": div("pause_tech_sec", LOGGED),
    "pause_personal_rate": div("pause_personal_sec", LOGGED),
    "pause_mgmt_rate": div("pause_mgmt_sec", LOGGED),
    "hc_dev_pct": div(f"{HC} - hc_plan", "hc_plan"),
    "vol_dev_pct": div("vol_actual - vol_plan", "vol_plan"),
    "log_gap_rate_daily": div("log_gap_sec", "paid_sec"),
    "tech_issue_rate_daily": div("tech_issue_sec", "paid_sec"),
    "new_hire_pct_daily": div("new_hires", "hc_logged"),
    "agent_issue_rate_daily": div("agent_issue_sec", "paid_sec"),
    "day_of_month": "cast(day(ref_date) AS int)",
    "week_of_month": "cast(floor((day(ref_date) - 1) / 7) AS int) + 1",
    "day_of_week": "cast(isodow(ref_date) - 1 AS int)",
    "is_month_edge": "CASE WHEN day(ref_date) <= 5 OR day(ref_date) >= 26 THEN 1.0 ELSE 0.0 END::double",
    "is_mon_fri": "CASE WHEN isodow(ref_date) IN (1, 5) THEN 1.0 ELSE 0.0 END::double",
    "is_weekend": "CASE WHEN isodow(ref_date) >= 6 THEN 1.0 ELSE 0.0 END::double",
    "hour_cycle": "hour % 8",
    "is_peak_hour": "CASE WHEN hour BETWEEN 10 AND 14 THEN 1.0 ELSE 0.0 END::double",
}
LAG1 = ["abandon_rate", "avg_wait", "occupancy", "pause_tech_rate", "pause_personal_rate", "pause_mgmt_rate",
        "hc_dev_pct", "vol_dev_pct", "aht_delta"]


def _rows(clean: str) -> str:
    return f"""
SELECT *, aht_actual_avg - aht_plan_avg AS aht_delta FROM (
  SELECT *, {", ".join(f"{e} AS {n}" for n, e in DERIVED.items())} FROM {clean})
"""


def _history(rows: str) -> str:
    w = "OVER (PARTITION BY program_id, channel_id ORDER BY slot_ts"
    mean = f"(SELECT avg(sl_actual) FROM {rows})"
    return f"""
SELECT *, sl_lag_1 - sl_lag_2 AS sl_accel FROM (
  SELECT *,
    {", ".join(f"coalesce(lag(sl_actual, {k}) {w}), {mean}) AS sl_lag_{k}" for k in (1, 2, 3))},
    {", ".join(f"coalesce(lag({m}, 1) {w}), 0.0) AS {m}_lag_1" for m in LAG1)},
    coalesce(avg(sl_actual) {w} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), {mean}) AS sl_mean_3,
    coalesce(avg(sl_actual) {w} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), {mean}) AS sl_mean_6,
    coalesce(stddev_samp(sl_actual) {w} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0.0) AS sl_std_6
  FROM {rows})
"""


def _encoding(rows: str) -> str:
    return f"""
SELECT program_id, n / (n + 30.0) * m + (1 - n / (n + 30.0)) * g AS enc, g AS global_mean, n
FROM (SELECT program_id, avg(sl_actual) AS m, count(*) AS n, (SELECT avg(sl_actual) FROM {rows}) AS g
      FROM {rows} GROUP BY program_id)
"""


for m in ("inference", "training", "benchmark"):
    lo, hi = WINDOW[m]
    s = m[:5]  # infer / train / bench
    cte(f"mart_{s}", ["mart"], f"SELECT * FROM mart WHERE ref_date >= {lo} AND ref_date <= {hi} AND channel_id = 7 "
        "AND program_id BETWEEN 900000 AND 900005")
    cte(f"gap_{s}", ["fx_system", "fx_agents"], log_gap(lo, hi))
    cte(f"raw_{s}", [f"mart_{s}", f"gap_{s}"], f"SELECT * FROM mart_{s} LEFT JOIN gap_{s} USING (ref_date, program_id)")
    cte(f"clean_{s}", [f"raw_{s}"], _clean(f"raw_{s}", m == "training"))
    cte(f"rows_{s}", [f"clean_{s}"], _rows(f"clean_{s}"))
    cte(f"hist_{s}", [f"rows_{s}"], _history(f"rows_{s}"))
    cte(f"enc_{s}", [f"rows_{s}"], _encoding(f"rows_{s}"))
# Training fits the encoding; scoring uses the one training stored.
cte("feat_train", ["hist_train", "enc_train"],
    "SELECT h.*, e.enc AS program_enc FROM hist_train h LEFT JOIN enc_train e USING (program_id)")
for s in ("infer", "bench"):
    cte(f"feat_{s}", [f"hist_{s}", "enc_train"],
        f"SELECT h.*, coalesce(e.enc, (SELECT max(global_mean) FROM enc_train), 0.5) AS program_enc "
        f"FROM hist_{s} h LEFT JOIN enc_train e USING (program_id)")


def linear_terms() -> list[tuple[str, str]]:
    return [(f, f"({w!r} * (cast({f} AS double) - {c!r}))") for f, w, c in demo.LINEAR_MODEL]


_RAW = " + ".join([f"{demo.LINEAR_BASE!r} + ({linear_terms()[0][1]}", *[t for _, t in linear_terms()[1:]]]) + ")"


def forest_leaves() -> list[tuple[float, dict[str, tuple[float, float, float]]]]:
    """Leaves of the fixed forest: (weighted value, feature -> (above, up to, share of the training rows that follow))."""
    out = []
    for weight, top in demo.FOREST:
        todo = [(top, {})]
        while todo:
            own, path = todo.pop()
            if len(own) == 2:
                out.append((weight * own[0], path))
                continue
            f, at, cover, left, right = own
            low, high, share = path.get(f, (float("-inf"), float("inf"), 1.0))
            todo += [(left, {**path, f: (low, min(high, at), share * left[-1 if len(left) == 2 else 2] / cover)}),
                     (right, {**path, f: (max(low, at), high, share * right[-1 if len(right) == 2 else 2] / cover)})]
    return out


def forest_value(known: set[str]) -> str:
    """Expected output of the fixed forest if only some features are known."""
    terms = []
    for value, path in forest_leaves():
        factors = [repr(value)]
        for f, (low, high, share) in path.items():
            tests = [f"{f} > {low!r}"] * (low > float("-inf")) + [f"{f} <= {high!r}"] * (high < float("inf"))
            factors.append(f"CASE WHEN {' AND '.join(tests)} THEN 1.0::double ELSE 0.0::double END" if f in known else f"{share!r}::double")
        terms.append("(" + " * ".join(factors) + ")")
    return " + ".join(terms)


def forest_terms() -> list[tuple[str, str]]:
    """Shapley values of the fixed forest by their definition: all subsets of the other features, as columns v<bits>."""
    names, out = demo.FOREST_FEATURES, []
    k = len(names)
    for i, f in enumerate(names):
        parts = []
        for bits in range(1 << k):
            if not bits >> i & 1:
                size = bits.bit_count()
                parts.append(f"{factorial(size) * factorial(k - size - 1)}.0::double / {factorial(k)}.0 * (v{bits | 1 << i} - v{bits})")
        out.append((f, "(" + " + ".join(parts) + ")"))
    return out


def _explained(prefix: str, s: str, source: str, raw: str, base: str, terms: list[tuple[str, str]]) -> None:
    """Statements of scored, long, pillar, driver and explained rows of one model."""
    cte(f"{prefix}scored_{s}", [source, "mart_train"], f"""
SELECT *, CASE WHEN vol_plan = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, 1 - (exp(raw_value) - 1))) END AS sl_pred
FROM (SELECT *, {raw} AS raw_value, {base} AS base_value FROM {source}
      WHERE program_id IN (SELECT program_id FROM mart_train GROUP BY 1 HAVING sum(vol_actual) > 0)) AS f
""")
    # Long form: one row per interval and model input.
    cte(f"{prefix}long_{s}", [f"{prefix}scored_{s}"], "\nUNION ALL\n".join(
        f"SELECT ref_date, slot, program_id, channel_id, base_value, {i} AS position, '{f}' AS feature, "
        f"'{p}' AS pillar, {t} AS impact FROM {prefix}scored_{s}"
        for i, (f, t) in enumerate(terms) for p in [catalog.PILLAR_OF[f]]))
    cte(f"{prefix}pillars_{s}", [f"{prefix}long_{s}"], f"""
SELECT ref_date, slot, program_id, channel_id,
  coalesce(sum(impact) FILTER (pillar = 'volume'), 0) AS impact_volume,
  coalesce(sum(impact) FILTER (pillar = 'people'), 0) AS impact_people,
  coalesce(sum(impact) FILTER (pillar = 'handle_time'), 0) AS impact_handle_time,
  coalesce(sum(impact) FILTER (pillar = 'operational_health'), 0) AS impact_health,
  coalesce(sum(impact) FILTER (pillar LIKE '%_context'), 0) AS impact_context
FROM {prefix}long_{s} GROUP BY ALL
""")
    _side = """
  coalesce(max({what}) FILTER (sign_ = {sign} AND rk = {i}), {pad}) AS {side}_{i}_{col}"""
    _cols = ",".join(
        _side.format(what=w, sign=g, i=i, pad=pad, side=side, col=c)
        for side, g in (("detractor", -1), ("booster", 1)) for i in (1, 2, 3)
        for w, c, pad in (("feature", "name", "'Sem Impacto Relevante'"), ("pillar", "pillar", "'N/A'"), ("impact", "impact", "0.0")))
    cte(f"{prefix}drivers_{s}", [f"{prefix}long_{s}"], f"""
SELECT ref_date, slot, program_id, channel_id, {_cols}
FROM (SELECT *, row_number() OVER (PARTITION BY ref_date, slot, program_id, channel_id, sign_
                                   ORDER BY abs(impact) DESC, position) AS rk
      FROM (SELECT *, CASE WHEN impact < -0.001 THEN -1 WHEN impact > 0.001 THEN 1 ELSE 0 END AS sign_ FROM {prefix}long_{s}) AS a) AS b
GROUP BY ref_date, slot, program_id, channel_id
""")
    cte(f"{prefix}explained_{s}", [f"{prefix}scored_{s}", f"{prefix}pillars_{s}", f"{prefix}drivers_{s}"], f"""
SELECT * FROM {prefix}scored_{s} JOIN {prefix}pillars_{s} USING (ref_date, slot, program_id, channel_id)
JOIN {prefix}drivers_{s} USING (ref_date, slot, program_id, channel_id)
""")


_ALL = (1 << len(demo.FOREST_FEATURES)) - 1
for s in ("infer", "bench", "train"):
    _explained("", s, f"feat_{s}", _RAW, repr(demo.LINEAR_BASE), linear_terms())
    cte(f"forest_{s}", [f"feat_{s}"], "SELECT *, " + ", ".join(
        f"{forest_value({f for i, f in enumerate(demo.FOREST_FEATURES) if bits >> i & 1})} AS v{bits}" for bits in range(_ALL + 1)) + f" FROM feat_{s}")
    _explained("forest_", s, f"forest_{s}", f"v{_ALL}", "v0", forest_terms())

R2 = ("CASE WHEN count(*) < 2 THEN 0.0 WHEN max({y}) = min({y}) THEN CASE WHEN sum(({y}-{p})*({y}-{p})) = 0 THEN 1.0 ELSE 0.0 END "
      "ELSE 1 - sum(({y}-{p})*({y}-{p})) / (var_pop({y}) * count(*)) END")


def metric_select(y: str = "sl_actual", p: str = "sl_pred", plan: str = "sl_plan") -> str:
    return f"""count(*) AS n_rows, avg({y}) AS sl_actual_mean, avg({p}) AS sl_pred_mean, avg({plan}) AS sl_plan_mean,
  avg(abs({y}-{p})) AS mae_model, avg(({y}-{p})*({y}-{p})) AS mse_model, sqrt(avg(({y}-{p})*({y}-{p}))) AS rmse_model,
  {R2.format(y=y, p=p)} AS r2_model,
  avg(abs({y}-{plan})) AS mae_plan, avg(({y}-{plan})*({y}-{plan})) AS mse_plan,
  sqrt(avg(({y}-{plan})*({y}-{plan}))) AS rmse_plan, {R2.format(y=y, p=plan)} AS r2_plan,
  CASE WHEN avg(abs({y}-{plan})) > 0 THEN (avg(abs({y}-{plan})) - avg(abs({y}-{p}))) / avg(abs({y}-{plan})) * 100 ELSE 0 END AS uplift_mae_pct,
  CASE WHEN avg(abs({y}-{plan})) > 0 THEN (sqrt(avg(({y}-{plan})*({y}-{plan}))) - sqrt(avg(({y}-{p})*({y}-{p})))) / sqrt(avg(({y}-{plan})*({y}-{plan}))) * 100 ELSE 0 END AS uplift_rmse_pct"""


METRIC_SPEC = ("n_rows:bigint sl_actual_mean sl_pred_mean sl_plan_mean mae_model mse_model rmse_model r2_model mae_plan "
               "mse_plan rmse_plan r2_plan uplift_mae_pct uplift_rmse_pct:double")
