"""Window features, drivers and folds."""

import datetime as dt

from slotwise.operators import drivers, history
from verification import inputs as i
from verification.registry import check

K = i.KEYS
LAGS = [f"{m}_lag_1" for m in ("abandon_rate", "avg_wait", "occupancy", "pause_tech_rate", "pause_personal_rate",
                               "pause_mgmt_rate", "hc_dev_pct", "vol_dev_pct", "aht_delta")]


def _history(name, mode, cols):
    @check(name, f"{K} {' '.join(cols)}:double", [f"hist_{mode[:5]}"], f"SELECT * FROM hist_{mode[:5]}")
    def _(s, d):
        return i.feats(s, d, mode)


_history("lag_features", "inference", ["sl_lag_1", "sl_lag_2", "sl_lag_3", *LAGS])
_history("acceleration", "training", ["sl_lag_1", "sl_lag_2", "sl_accel"])
_history("rolling_mean", "inference", ["sl_mean_3", "sl_mean_6"])
_history("rolling_std", "training", ["sl_std_6"])


@check("lag_last_observed", f"{K} sl_lag_1 sl_lag_2 sl_lag_3 sl_mean_3 sl_mean_6:double", ["hist_infer"], """
WITH o AS (SELECT program_id, channel_id, sl_actual, row_number() OVER (PARTITION BY program_id, channel_id ORDER BY slot_ts DESC) AS rk
  FROM hist_infer WHERE slot_ts < TIMESTAMP '2024-01-29 00:00:00' AND vol_actual > 0),
l AS (SELECT program_id, channel_id, max(sl_actual) FILTER (rk = 1) AS a, max(sl_actual) FILTER (rk = 2) AS b, max(sl_actual) FILTER (rk = 3) AS c,
  avg(sl_actual) FILTER (rk <= 3) AS m3, avg(sl_actual) FILTER (rk <= 6) AS m6 FROM o GROUP BY 1, 2)
SELECT ref_date, slot, program_id, channel_id,
 CASE WHEN late THEN coalesce(a, sl_lag_1) ELSE sl_lag_1 END AS sl_lag_1, CASE WHEN late THEN coalesce(b, a, sl_lag_2) ELSE sl_lag_2 END AS sl_lag_2,
 CASE WHEN late THEN coalesce(c, b, a, sl_lag_3) ELSE sl_lag_3 END AS sl_lag_3, CASE WHEN late THEN coalesce(m3, sl_mean_3) ELSE sl_mean_3 END AS sl_mean_3,
 CASE WHEN late THEN coalesce(m6, sl_mean_6) ELSE sl_mean_6 END AS sl_mean_6
FROM (SELECT *, slot_ts >= TIMESTAMP '2024-01-29 00:00:00' AS late FROM hist_infer) AS h LEFT JOIN l USING (program_id, channel_id)""")
def _(s, d):
    """Alternative history of future rows: the last observed values instead of zeros."""
    return history.lag_and_rolling(i.rows(s, d), future_from=dt.datetime(2024, 1, 29))


DRIVERS = " ".join(f"{x}_{k}_name {x}_{k}_pillar:string {x}_{k}_impact:double" for x in ("detractor", "booster") for k in (1, 2, 3))


@check("top3_drivers", f"{K} {DRIVERS}", ["drivers_infer"], "SELECT * FROM drivers_infer")
def _(s, d):
    return drivers.top_drivers(i.scored(s, d))


@check("row_index", f"{K} row_num:bigint", ["clean_infer"],
       "SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY slot_ts, channel_id) AS row_num FROM clean_infer")
def _(s, d):
    return history.row_index(i.light(s, d))


@check("time_folds", f"{K} fold row_num:bigint role:string", ["clean_train"], """
SELECT * FROM (SELECT *, CASE WHEN k < n - (5 - fold) * t THEN 'train' WHEN k < n - (4 - fold) * t THEN 'test' END AS role
 FROM (SELECT *, row_num - 1 AS k, n // 6 AS t FROM (SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY slot_ts, channel_id) AS row_num,
   count(*) OVER (PARTITION BY program_id) AS n FROM clean_train) AS a) AS b, (SELECT unnest(range(0, 5)) AS fold) AS f) AS c WHERE role IS NOT NULL""")
def _(s, d):
    return history.time_folds(i.light(s, d, "training"), 5)
