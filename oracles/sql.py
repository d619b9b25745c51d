"""SQL counterparts, run by DuckDB.

They follow the plain reading of each report: days are gone through one by one (table
``days`` joined in), assignments are numbered with ROW_NUMBER, distinct things are counted
with COUNT(DISTINCT) and horizons are looked up with a join each. The Spark plans do none
of that, so an error in a restructuring shows.
"""

from __future__ import annotations

import re
from math import exp, factorial

from oracles.views import on_hard_events, with_views

S, E = "DATE '2024-01-02'", "DATE '2024-01-28'"
TS, TE = "TIMESTAMP '2024-01-02 06:00:00'", "TIMESTAMP '2024-01-28 18:00:00'"


def days(first: int, last: int) -> str:
    """Days from ``first`` days after the phase's first day to ``last`` days after its last."""
    return f"SELECT CAST(d AS DATE) AS d FROM generate_series({S} + {first}, {E} + {last}, INTERVAL 1 DAY) g(d)"


WHOLE, AFTER_FIRST, INNER, BEFORE_LAST, EXPLORE = days(0, 0), days(1, 0), days(1, -1), days(0, -1), days(1, -2)


def chosen(partition: str, order: str, where: str = "TRUE") -> str:
    return f"""SELECT user_id, event_date, timestamp_assigned, variation_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY {partition} ORDER BY {order}) AS rn
        FROM v_assignment WHERE experiment_id = 'exp_a' AND {where}) WHERE rn = 1"""


# The warehouse sorts NULL before all values.
USER_FIRST = chosen("user_id", "timestamp_assigned, variation_id NULLS FIRST")
IN_PHASE = chosen("user_id", "timestamp_assigned, variation_id NULLS FIRST", f"timestamp_assigned BETWEEN {TS} AND {TE}")
LATEST_DAY = chosen("user_id", "event_date DESC, timestamp_assigned, variation_id NULLS FIRST")
FIRST_DAY = chosen("user_id", "event_date, timestamp_assigned, variation_id NULLS FIRST")
DAILY_FIRST = chosen("user_id, event_date", "timestamp_assigned, variation_id NULLS FIRST")
DAILY_LOWEST = chosen("user_id, event_date", "variation_id NULLS FIRST")


def rounded(sql: str, columns: str, digits: int = 6) -> str:
    """Sums of doubles differ in the last bits with the order of addition."""
    replaced = ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def half_up(sql: str) -> str:
    """Round as decimals: on doubles DuckDB scales first, which turns 163.045 into 163.04."""
    start = sql.find("ROUND(")
    if start < 0:
        return sql
    depth, at, comma = 1, start + len("ROUND("), 0
    while depth:
        depth += {"(": 1, ")": -1}.get(sql[at], 0)
        comma = at if sql[at] == "," and depth == 1 else comma
        at += 1
    value, digits = half_up(sql[start + len("ROUND("):comma]), sql[comma + 1:at - 1].strip()
    return f"{sql[:start]}CAST(round(CAST({value} AS DECIMAL(38, 12)), {digits}) AS DOUBLE){half_up(sql[at:])}"


def _assignments() -> dict[str, str]:
    def query(text: str, columns: str) -> str:
        return with_views(f"SELECT {columns} FROM ({text})")

    in_phase = f"event_date BETWEEN {S} AND {E}"
    return {
        "a1_first_in_phase": query(IN_PHASE, "user_id, variation_id"),
        "a2_first_ever": query(USER_FIRST, "user_id, variation_id"),
        "a3_latest_day": query(LATEST_DAY, "user_id, variation_id"),
        "a4_daily_in_phase": query(chosen("user_id, event_date", "timestamp_assigned, variation_id NULLS FIRST", in_phase),
                                   "user_id, event_date, variation_id"),
        "a5_daily_first": query(DAILY_FIRST, "user_id, event_date, variation_id"),
        "a6_daily_lowest": query(DAILY_LOWEST, "user_id, event_date, variation_id"),
        "a7_first_day": query(FIRST_DAY, "user_id, variation_id"),
        "a8_one_day": query(chosen("user_id", "timestamp_assigned, variation_id", "event_date = DATE '2024-01-15'"),
                            "user_id, event_date, variation_id"),
        "a9_any_in_phase": with_views(f"SELECT DISTINCT user_id, variation_id FROM v_assignment WHERE {in_phase}"),
        "a10_any_daily": with_views("SELECT DISTINCT user_id, event_date, variation_id FROM v_assignment"),
    }


def _windows() -> dict[str, str]:
    def part(name: str, first: int, last: int) -> str:
        return f"""SELECT '{name}' AS days, MIN(event_date) AS first_day, MAX(event_date) AS last_day,
            COUNT(*) AS sessions FROM v_session WHERE event_date >= {S} + {first} AND event_date <= {E} + {last}"""

    parts = [part("w1_whole", 0, 0), part("w2_without_first", 1, 0), part("w3_inner", 1, -1),
             part("w4_without_last", 0, -1), part("w5_explore", 1, -2), part("w6_inner_if_long", 1, -1),
             part("w8_bounds_as_days", 0, 0), part("w8_bounds_as_times", 1, 0)]
    ingest = f"""SELECT CAST(ingest_timestamp AS DATE) AS day, COUNT(*) AS chats FROM v_chat, days
        WHERE ingest_timestamp >= d AND ingest_timestamp < CAST(d AS TIMESTAMP) + INTERVAL '23:59:59' GROUP BY 1"""
    long = with_views(RATES + " ", **R1_PARTS)
    return {
        "w_phase_days": with_views(" UNION ALL ".join(parts)),
        "w7_ingest_days": with_views(ingest, days=WHOLE),
        "w9_trimmed_dates": f"""SELECT dt, variation, day, users, retained FROM ({long}) r
            WHERE (SELECT COUNT(DISTINCT dt) FROM ({long})) <= 2
               OR dt NOT IN (SELECT MIN(dt) FROM ({long}) UNION ALL SELECT MAX(dt) FROM ({long}))""",
        "w10_matured_dates": f"""SELECT dt, variation, day, users, retained FROM ({long}) r
            WHERE dt <= (SELECT MAX(dt) FROM ({long})) - day""",
    }


TOTALS = f"""SELECT CAST(timestamp_assigned AS DATE) AS assign_date, variation_id,
    COUNT(DISTINCT user_id) AS total_assigned FROM ({USER_FIRST}) GROUP BY 1, 2"""

R1 = """SELECT u.first_visit_date AS dt, e.variation_id AS variation, COUNT(DISTINCT u.user_id) AS new_users,
    COUNT(DISTINCT CASE WHEN a.active_date = u.first_visit_date + 1 THEN u.user_id END) AS d1,
    COUNT(DISTINCT CASE WHEN a.active_date = u.first_visit_date + 3 THEN u.user_id END) AS d3,
    COUNT(DISTINCT CASE WHEN a.active_date = u.first_visit_date + 7 THEN u.user_id END) AS d7,
    COUNT(DISTINCT CASE WHEN a.active_date = u.first_visit_date + 15 THEN u.user_id END) AS d15,
    MAX(COALESCE(ta.total_assigned, 0)) AS total_assigned
    FROM v_first_visit u JOIN picked e ON u.user_id = e.user_id
    LEFT JOIN seen a ON a.user_id = u.user_id
    LEFT JOIN totals ta ON ta.assign_date = u.first_visit_date AND ta.variation_id = e.variation_id
    WHERE u.first_visit_date BETWEEN {S} AND {E} AND e.variation_id IS NOT NULL GROUP BY 1, 2""".format(S=S, E=E)


def seen(first: str = S, last: str = E) -> str:
    return f"SELECT DISTINCT user_id, active_date FROM v_active WHERE keep_alive_flag = 1 AND active_date BETWEEN {first} AND {last}"


R1_PARTS = {"picked": IN_PHASE, "totals": TOTALS, "seen": seen(), "wide": R1}
R1_STRICT = {**R1_PARTS, "seen": seen(f"{S} + 1")}


def active_cohorts(first: str, more: str, keys: str) -> str:
    lookups = " ".join(f"LEFT JOIN seen d{n} ON d{n}.user_id = b.user_id AND d{n}.active_date = b.active_date + {n}"
                       for n in (1, 3, 7, 15))
    counts = ", ".join(f"COUNT(DISTINCT d{n}.user_id) AS d{n}" for n in (1, 3, 7, 15))
    return f"""SELECT b.active_date AS dt, e.variation_id AS variation{keys}, COUNT(DISTINCT b.user_id) AS new_users,
        {counts}, MAX(COALESCE(ta.total_assigned, 0)) AS total_assigned
        FROM (SELECT * FROM seen WHERE active_date BETWEEN {first} AND {E}) b JOIN picked e ON b.user_id = e.user_id
        {lookups} {more} LEFT JOIN totals ta ON ta.assign_date = b.active_date AND ta.variation_id = e.variation_id
        WHERE e.variation_id IS NOT NULL GROUP BY ALL"""


R2_PARTS = {"picked": IN_PHASE, "totals": TOTALS, "seen": seen(S, f"{E} + 15"), "wide": active_cohorts(S, "", "")}
R3_PARTS = {
    "picked": chosen("user_id", "timestamp_assigned, variation_id",
                     "timestamp_assigned BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28'"),
    "home": "SELECT user_id, MAX(json_extract_string(geo, '$.country')) AS country FROM v_app_event GROUP BY 1",
    "seen": seen(S, f"{E} + 15"),
    "wide": active_cohorts(S, "JOIN home h ON h.user_id = b.user_id AND h.country IS NOT NULL", ", h.country"),
}
RAW_TOTALS = """SELECT CAST(timestamp_assigned AS DATE) AS assign_date, variation_id,
    COUNT(DISTINCT user_id) AS total_assigned FROM v_assignment GROUP BY 1, 2"""

RATES = "SELECT dt, variation, 1 AS day, new_users AS users, d1 AS retained FROM wide WHERE new_users > 0" + "".join(
    f" UNION ALL SELECT dt, variation, {n}, new_users, d{n} FROM wide WHERE new_users > 0" for n in (3, 7, 15))
LONG = """SELECT *, retained / users AS retention_rate,
    GREATEST(0, retained / users - 1.96 * SQRT(retained / users * (1 - retained / users) / users)) AS ci_lower,
    LEAST(1, retained / users + 1.96 * SQRT(retained / users * (1 - retained / users) / users)) AS ci_upper
    FROM rates"""


def daily(trim: bool) -> tuple[str, dict[str, str]]:
    kept = """(SELECT COUNT(DISTINCT dt) FROM long) <= 2 OR dt NOT IN
        (SELECT MIN(dt) FROM long UNION ALL SELECT MAX(dt) FROM long)""" if trim else "TRUE"
    body = """SELECT e.dt, e.variation, c.users AS control_users, c.retention_rate AS control_rate,
        e.users AS exp_users, e.retention_rate AS exp_rate, e.retention_rate AS d1_rate,
        d3.retention_rate AS d3_rate, d7.retention_rate AS d7_rate, d15.retention_rate AS d15_rate,
        CAST(NULL AS DOUBLE) AS coverage_ratio, e.ci_lower AS exp_ci_lower, e.ci_upper AS exp_ci_upper
        FROM kept e LEFT JOIN kept c ON c.dt = e.dt AND c.variation = 0 AND c.day = 1 """ + " ".join(
        f"LEFT JOIN kept d{n} ON d{n}.dt = e.dt AND d{n}.variation = e.variation AND d{n}.day = {n}" for n in (3, 7, 15))
    body = rounded(body + " WHERE e.variation <> 0 AND e.day = 1",
                   "control_rate exp_rate d1_rate d3_rate d7_rate d15_rate exp_ci_lower exp_ci_upper")
    return body, {"rates": RATES, "long": LONG, "kept": f"SELECT * FROM long WHERE {kept}"}


# P(treatment > control) of two Beta posteriors with whole parameters, as a finite sum.
WIN = """(SELECT SUM(EXP(
      lgamma(cr + 1 + i) + lgamma(eu - er + 1 + cu - cr + 1) - lgamma(cr + 1 + i + eu - er + 1 + cu - cr + 1)
      - LN(eu - er + 1 + i) - (lgamma(1 + i) + lgamma(eu - er + 1) - lgamma(1 + i + eu - er + 1))
      - (lgamma(cr + 1) + lgamma(cu - cr + 1) - lgamma(cu + 2))))
    FROM generate_series(0, er) g(i))"""


def phi(z: str) -> str:
    """Normal distribution function, by Simpson's rule."""
    return f"""(0.5 + ({z}) / 3000 / SQRT(2 * PI()) * (SELECT SUM((CASE WHEN k IN (0, 1000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
        * EXP(-POWER(({z}) * k / 1000, 2) / 2)) FROM generate_series(0, 1000) g(k)))"""


def student(t: str, df: str) -> str:
    """Two-sided p-value of Student's t, by Simpson's rule."""
    return f"""(1 - 2 * ABS({t}) / 6000 * EXP(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / SQRT({df} * PI())
        * (SELECT SUM((CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)
        * POWER(1 + POWER({t} * k / 2000, 2) / {df}, -({df} + 1) / 2)) FROM generate_series(0, 2000) g(k)))"""


def beta_win(xc: str, nc: str, xe: str, ne: str) -> str:
    """P(treatment > control) of two Beta posteriors with any parameters, on a grid."""
    def density(x: str, n: str) -> str:
        return (f"EXP(lgamma(({n}) + 2) - lgamma(({x}) + 1) - lgamma(({n}) - ({x}) + 1) + ({x}) * LN((i + 0.5) / 400000)"
                f" + (({n}) - ({x})) * LN(1 - (i + 0.5) / 400000))")
    return f"""(SELECT SUM(c * (SUM_E - CUM_E + e / 2)) / (SUM(c) * MAX(SUM_E)) FROM (SELECT c, e, SUM(e) OVER () AS SUM_E,
        SUM(e) OVER (ORDER BY i) AS CUM_E FROM (SELECT i, {density(xc, nc)} AS c, {density(xe, ne)} AS e
        FROM generate_series(0, 399999) g(i))))"""


def bounds(keys: str, steps: int = 40) -> dict[str, str]:
    """2.5% and 97.5% quantiles of the difference of two Beta posteriors for the rows of ``sides`` (cu, cr, eu, er),
    as relation ``bounds``: both densities on 2000 cells, and the distribution of the difference halved step by step."""
    def cells(side: str, users: str, hits: str) -> dict[str, str]:
        mean, spread = f"(({hits} + 1) / ({users} + 2))", f"SQRT(({hits} + 1) * ({users} - {hits} + 1) / ({users} + 3)) / ({users} + 2)"
        return {
            f"{side}_support": f"""SELECT {keys}, {users} AS n, {hits} AS x, GREATEST(0, {mean} - 12 * {spread}) AS low,
                LEAST(1, {mean} + 12 * {spread}) AS high FROM sides WHERE cu IS NOT NULL""",
            f"{side}_density": f"""SELECT {keys}, i, low, (high - low) / 2000 AS step, spot, x * LN(spot) + (n - x) * LN(1 - spot) AS log
                FROM (SELECT *, low + (high - low) * (i + 0.5) / 2000 AS spot FROM {side}_support, generate_series(0, 1999) g(i))""",
            f"{side}_raw": f"SELECT *, EXP(log - MAX(log) OVER (PARTITION BY {keys})) AS raw FROM {side}_density",
            f"{side}_mass": f"SELECT *, raw / SUM(raw) OVER (PARTITION BY {keys}) AS mass FROM {side}_raw"}

    place = "((c.spot + (low + high) / 2 - e_low) / e_step)"
    at_most = f"""CASE WHEN {place} <= 0 THEN 0 WHEN {place} >= 2000 THEN cdf[2001] ELSE cdf[CAST(FLOOR({place}) AS INT) + 1]
        + ({place} - FLOOR({place})) * (cdf[CAST(FLOOR({place}) AS INT) + 2] - cdf[CAST(FLOOR({place}) AS INT) + 1]) END"""
    parts = {
        **cells("c", "cu", "cr"), **cells("e", "eu", "er"),
        "c_cells": f"SELECT {keys}, LIST({{'spot': spot, 'mass': mass}} ORDER BY i) AS cells FROM c_mass GROUP BY ALL",
        "e_cells": f"""SELECT {keys}, MIN(low) AS e_low, MIN(step) AS e_step, [0.0] || LIST(upto ORDER BY i) AS cdf FROM (
            SELECT *, SUM(mass) OVER (PARTITION BY {keys} ORDER BY i) AS upto FROM e_mass) GROUP BY {keys}""",
        "halved0": f"""SELECT *, CAST(-1 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
            FROM c_cells JOIN e_cells USING ({keys}), (VALUES (0.025), (0.975)) l(level)""",
    }
    for step in range(steps):
        parts[f"halved{step + 1}"] = f"""SELECT * EXCLUDE (f) REPLACE (CASE WHEN f < level THEN (low + high) / 2 ELSE low END AS low,
            CASE WHEN f < level THEN high ELSE (low + high) / 2 END AS high) FROM (SELECT *, list_sum(list_transform(cells,
            lambda c: c.mass * {at_most})) AS f FROM halved{step})"""
    parts["bounds"] = f"""SELECT {keys}, MIN((low + high) / 2) AS low, MAX((low + high) / 2) AS high FROM halved{steps} GROUP BY {keys}"""
    return parts


def overall(cutoff: bool) -> tuple[str, dict[str, str]]:
    matured = "dt <= (SELECT MAX(dt) FROM long) - day" if cutoff else "TRUE"
    kept = f"""SELECT * FROM long WHERE {matured} AND ((SELECT COUNT(DISTINCT dt) FROM long) <= 2 OR dt NOT IN
        (SELECT MIN(dt) FROM long UNION ALL SELECT MAX(dt) FROM long))"""
    sums = "SELECT day, variation, SUM(users) AS u, SUM(retained) AS r FROM kept GROUP BY 1, 2"
    sides = """SELECT e.day, e.variation, CAST(c.u AS BIGINT) AS cu, CAST(c.r AS BIGINT) AS cr, CAST(e.u AS BIGINT) AS eu,
        CAST(e.r AS BIGINT) AS er, p.u AS pu, p.r AS pr FROM sums e JOIN sums c ON c.day = e.day AND c.variation = 0
        JOIN (SELECT day, SUM(u) AS u, SUM(r) AS r FROM sums WHERE variation <> 0 GROUP BY 1) p ON p.day = e.day
        WHERE e.variation <> 0"""
    uplift = "ROUND(((er + 1) / (eu + 2) - (cr + 1) / (cu + 2)) / ((cr + 1) / (cu + 2)), 6)"
    body = f"""SELECT day, variation, cu AS control_users, cr AS control_retained, ROUND(cr / cu, 6) AS control_freq_rate,
        ROUND((cr + 1) / (cu + 2), 6) AS control_bayes_rate, eu AS exp_users, er AS exp_retained,
        ROUND(er / eu, 6) AS exp_freq_rate, ROUND((er + 1) / (eu + 2), 6) AS exp_bayes_rate,
        {", ".join(f"CASE WHEN day = {n} THEN {uplift} END AS overall_d{n}_uplift" for n in (1, 3, 7, 15))},
        ROUND({WIN}, 6) AS overall_chance_to_win,
        CASE WHEN cr > 0 THEN ROUND((pr / pu - cr / cu) / (cr / cu), 6) ELSE 0 END AS freq_uplift FROM sides"""
    return body, {"rates": RATES, "long": LONG, "kept": kept, "sums": sums, "sides": sides}


def _retention() -> dict[str, str]:
    wide = "SELECT * FROM wide"
    image = """SELECT d AS event_day, a.variation_id, COUNT(DISTINCT c.user_id) AS test_chat_users,
        COALESCE(MAX(g.n), 0) AS generate_user,
        ROUND(COALESCE(MAX(g.n), 0) / COUNT(DISTINCT c.user_id), 3) AS generate_image_use_rate
        FROM days JOIN v_chat c ON c.event_date = d
        JOIN v_assignment a ON a.user_id = c.user_id AND a.event_date = d
        LEFT JOIN (SELECT i.event_date, x.variation_id, COUNT(DISTINCT i.user_id) AS n FROM v_image i
            JOIN v_assignment x ON x.user_id = i.user_id AND x.event_date = i.event_date GROUP BY 1, 2) g
            ON g.event_date = d AND g.variation_id = a.variation_id GROUP BY 1, 2"""
    result = {
        "r1_new_user_retention": with_views(wide, **R1_PARTS),
        "r1_new_user_retention_strict": with_views(wide, **R1_STRICT),
        "r2_active_user_retention": with_views(wide, **R2_PARTS),
        "r3_country_retention": with_views(wide, totals=TOTALS, **R3_PARTS),
        "r3_country_retention_raw_totals": with_views(wide, totals=RAW_TOTALS, **R3_PARTS),
        "r4_merged_parts": with_views(wide, **R1_PARTS),
        "r10_image_use_rate": with_views(image, days=BEFORE_LAST),
    }
    r5 = rounded("SELECT * FROM long", "retention_rate ci_lower ci_upper")
    result["r5_retention_rates"] = with_views(r5, **R1_PARTS, rates=RATES, long=LONG)
    for name, parts, trim in (("r6_new_user_report", R1_PARTS, True), ("r7_active_user_report", R2_PARTS, False)):
        body, more = daily(trim)
        result[f"{name}_rates"] = with_views(body, **parts, **more)
        sides = """SELECT e.dt, e.variation, c.users AS cu, c.retained AS cr, e.users AS eu, e.retained AS er
            FROM kept e LEFT JOIN kept c ON c.dt = e.dt AND c.variation = 0 AND c.day = 1
            WHERE e.variation <> 0 AND e.day = 1"""
        wins = f"""SELECT dt, variation, cu AS control_users, eu AS exp_users,
            ROUND(((er + 1) / (eu + 2) - (cr + 1) / (cu + 2)) / ((cr + 1) / (cu + 2)), 6) AS uplift,
            ROUND({WIN}, 6) AS chance_to_win FROM sides"""
        result[f"{name}_wins"] = with_views(wins, **parts, **more, sides=sides)
        full = """SELECT r.*, w.uplift, ROUND(b.low / ((cr + 1) / (cu + 2)), 6) AS uplift_ci_lower,
            ROUND(b.high / ((cr + 1) / (cu + 2)), 6) AS uplift_ci_upper, w.chance_to_win FROM rows r
            JOIN wins w USING (dt, variation) JOIN sides USING (dt, variation) LEFT JOIN bounds b USING (dt, variation)"""
        result[name] = with_views(full, **parts, **more, sides=sides, rows=body, wins=wins, **bounds("dt, variation"))
    for name, parts, cutoff in (("r8_new_user_overall", R1_PARTS, True), ("r9_active_user_overall", R2_PARTS, True),
                                ("r9_active_user_overall_uncut", R2_PARTS, False)):
        body, more = overall(cutoff)
        result[name] = with_views(body, **parts, **more)
    return result


def _business() -> dict[str, str]:
    orders = "SELECT user_id, event_date, revenue FROM v_currency UNION ALL SELECT user_id, event_date, revenue FROM v_subscribe"
    b1 = """SELECT o.event_date, variation_id, SUM(revenue) AS total_revenue, COUNT(*) AS total_order_cnt,
        ROUND(ROUND(SUM(revenue), 6) / COUNT(*), 2) AS aov FROM days JOIN orders o ON o.event_date = d
        JOIN picked USING (user_id) GROUP BY 1, 2"""

    def new_aov(revenue: str, count: str, mean: str) -> str:
        return rounded(f"""SELECT d AS event_date, a.variation_id,
            SUM(CASE WHEN o.event_date <= d + 1 THEN revenue ELSE 0 END) AS {revenue}_day1,
            COUNT(CASE WHEN o.event_date <= d + 1 THEN 1 END) AS {count}_day1,
            ROUND(ROUND(SUM(CASE WHEN o.event_date <= d + 1 THEN revenue ELSE 0 END), 6)
                / NULLIF(COUNT(CASE WHEN o.event_date <= d + 1 THEN 1 END), 0), 2) AS {mean}_day1,
            SUM(revenue) AS {revenue}_day3, COUNT(*) AS {count}_day3, ROUND(ROUND(SUM(revenue), 6) / COUNT(*), 2) AS {mean}_day3
            FROM days JOIN v_first_visit f ON f.first_visit_date = d
            JOIN picked a ON a.user_id = f.user_id AND a.event_date = d
            JOIN orders o ON o.user_id = f.user_id AND o.event_date BETWEEN d AND d + 3 GROUP BY 1, 2""",
            f"{revenue}_day1 {revenue}_day3")

    b4 = """SELECT p.event_date, p.variation_id, act.n AS active_users,
        ROUND(SUM(COALESCE(sub.r, 0)), 6) AS total_subscribe_revenue, ROUND(SUM(COALESCE(ord.r, 0)), 6) AS total_order_revenue,
        ROUND(SUM(COALESCE(ad.r, 0)), 6) AS total_ad_revenue,
        ROUND(SUM(COALESCE(sub.r, 0) + COALESCE(ord.r, 0) + COALESCE(ad.r, 0)), 6) AS total_revenue,
        ROUND(ROUND(SUM(COALESCE(sub.r, 0) + COALESCE(ord.r, 0) + COALESCE(ad.r, 0)), 6) / act.n, 4) AS ARPU
        FROM days JOIN picked p ON p.event_date = d
        JOIN (SELECT x.event_date, x.variation_id, COUNT(DISTINCT s.user_id) AS n FROM v_session s
            JOIN picked x USING (user_id, event_date) GROUP BY 1, 2) act
            ON act.event_date = d AND act.variation_id = p.variation_id
        LEFT JOIN (SELECT user_id, event_date, SUM(revenue) AS r FROM v_subscribe GROUP BY 1, 2) sub
            ON sub.user_id = p.user_id AND sub.event_date = d
        LEFT JOIN (SELECT user_id, event_date, SUM(revenue) AS r FROM v_currency GROUP BY 1, 2) ord
            ON ord.user_id = p.user_id AND ord.event_date = d
        LEFT JOIN (SELECT user_id, event_date, SUM(ad_revenue) AS r FROM v_ads GROUP BY 1, 2) ad
            ON ad.user_id = p.user_id AND ad.event_date = d
        GROUP BY 1, 2, 3"""
    b5 = rounded("""SELECT m.event_date, m.variation_id, SUM(s) AS total_subscribe_revenue, SUM(o) AS total_order_revenue,
        SUM(s + o) + COALESCE(MAX(dad.r), 0) AS total_revenue, COUNT(*) AS paying_users,
        COUNT(DISTINCT m.user_id) AS active_users,
        ROUND(ROUND(SUM(s + o) + COALESCE(MAX(dad.r), 0), 6) / COUNT(*), 4) AS arppu
        FROM (SELECT COALESCE(s.user_id, o.user_id) AS user_id, COALESCE(s.event_date, o.event_date) AS event_date,
                COALESCE(s.r, 0) AS s, COALESCE(o.r, 0) AS o, p.variation_id
              FROM (SELECT user_id, event_date, SUM(revenue) AS r FROM v_subscribe GROUP BY 1, 2) s
              FULL JOIN (SELECT user_id, event_date, SUM(revenue) AS r FROM v_currency GROUP BY 1, 2) o
                ON s.user_id = o.user_id AND s.event_date = o.event_date
              JOIN picked p ON p.user_id = COALESCE(s.user_id, o.user_id)) m
        JOIN days ON m.event_date = d
        LEFT JOIN (SELECT v.event_date, x.variation_id, SUM(ad_revenue) AS r FROM v_ads v JOIN picked x USING (user_id)
                   GROUP BY 1, 2) dad ON dad.event_date = m.event_date AND dad.variation_id = m.variation_id
        GROUP BY 1, 2""", "total_subscribe_revenue total_order_revenue total_revenue")

    def earned(last: str) -> str:
        return f"""SELECT b.user_id, d AS event_date, p.variation_id,
            SUM(COALESCE(ad_revenue, 0) + COALESCE(subscribe_revenue, 0) + COALESCE(flux_revenue, 0)) AS r
            FROM days JOIN v_business_user b ON b.first_active_date = d JOIN picked p ON p.user_id = b.user_id
            LEFT JOIN v_daily_revenue v ON v.user_id = b.user_id AND v.event_date BETWEEN d AND d + {last}
            GROUP BY 1, 2, 3"""

    b6 = f"""SELECT w.event_date, w.variation_id, COUNT(DISTINCT w.user_id) AS register_users,
        ROUND(ROUND(SUM(w.r), 6), 2) AS revenue_7d, ROUND(ROUND(SUM(c.r), 6), 2) AS revenue_cycle,
        ROUND(ROUND(SUM(w.r), 6) / COUNT(DISTINCT w.user_id), 4) AS ltv_7d, ROUND(ROUND(SUM(c.r), 6) / COUNT(DISTINCT w.user_id), 4) AS ltv_cycle
        FROM ({earned("7")}) w JOIN ({earned("26")}) c
        ON c.user_id = w.user_id AND c.event_date = w.event_date AND c.variation_id = w.variation_id GROUP BY 1, 2"""
    typed = "type IN ('subscription', 'currency')"
    b7 = f"""SELECT d AS event_date, g.country, p.variation_id, COUNT(DISTINCT p.user_id) AS active_users,
        COUNT(DISTINCT b.user_id) AS paying_users,
        ROUND(COUNT(DISTINCT b.user_id) / COUNT(DISTINCT p.user_id), 4) AS purchase_rate
        FROM days JOIN picked p ON p.event_date = d JOIN v_session s ON s.user_id = p.user_id AND s.event_date = d
        JOIN v_geo g ON g.user_id = p.user_id AND g.event_date = d
        LEFT JOIN v_all_purchase b ON b.user_id = p.user_id AND b.event_date = d AND {typed} GROUP BY 1, 2, 3"""
    b8 = f"""SELECT d AS event_date, p.variation_id, COALESCE(g.country, 'unknown') AS country,
        COUNT(DISTINCT f.user_id) AS new_users,
        COUNT(DISTINCT CASE WHEN b.event_date <= d + 1 THEN f.user_id END) AS pay_user_day1,
        ROUND(COUNT(DISTINCT CASE WHEN b.event_date <= d + 1 THEN f.user_id END) / COUNT(DISTINCT f.user_id), 4) AS pay_rate_day1,
        COUNT(DISTINCT b.user_id) AS pay_user_day3,
        ROUND(COUNT(DISTINCT b.user_id) / COUNT(DISTINCT f.user_id), 4) AS pay_rate_day3
        FROM days JOIN v_first_visit f ON f.first_visit_date = d JOIN picked p ON p.user_id = f.user_id AND p.event_date = d
        LEFT JOIN v_geo g ON g.user_id = f.user_id AND g.event_date = d
        LEFT JOIN v_all_purchase b ON b.user_id = f.user_id AND {typed} AND b.event_date BETWEEN d AND d + 3
        WHERE p.variation_id IS NOT NULL GROUP BY 1, 2, 3"""

    def b9(distinct: str, age: str) -> str:
        return rounded(f"""SELECT a.variation_id, d AS event_date, COUNT(DISTINCT p.user_id) AS paying_users,
            SUM(COALESCE(p.revenue, 0)) AS revenue,
            ROUND(ROUND(SUM(CASE WHEN p.age <= 7 THEN p.revenue ELSE 0 END), 6) / NULLIF(COUNT(DISTINCT p.user_id), 0), 4) AS LTV7,
            ROUND(ROUND(SUM(COALESCE(p.revenue, 0)), 6) / NULLIF(COUNT(DISTINCT p.user_id), 0), 4) AS LTV_experiment,
            COUNT(DISTINCT a.user_id) AS total_users,
            ROUND(COUNT(DISTINCT p.user_id) / COUNT(DISTINCT a.user_id), 4) AS purchase_rate
            FROM days JOIN (SELECT DISTINCT x.user_id, x.variation_id, x.event_date FROM picked x
                JOIN v_all_purchase USING (user_id, event_date)) a ON a.event_date = d
            LEFT JOIN (SELECT {distinct} x.user_id, x.variation_id, x.event_date, b.revenue, {age} AS age FROM picked x
                JOIN v_all_purchase b USING (user_id, event_date) WHERE {typed}) p
            ON p.user_id = a.user_id AND p.variation_id = a.variation_id AND p.event_date = d GROUP BY 1, 2""", "revenue")

    first_day = f"""date_diff('day', (SELECT MIN(y.event_date) FROM picked y WHERE y.user_id = x.user_id
        AND y.variation_id = x.variation_id AND y.event_date BETWEEN {S} AND {E}), x.event_date)"""
    notices = """SELECT user_id, order_id, sub_date, notification_type IN ('SUBSCRIBED', 'DID_RENEW') AS subscribed FROM v_apple
        UNION ALL SELECT user_id, order_id, sub_date, notification_type IN ('2', '4') FROM v_google"""

    def b10(located: str) -> str:
        return f"""SELECT d AS event_date, g.country, p.variation_id, COUNT(DISTINCT n.user_id) AS total_subs,
            COUNT(DISTINCT c.user_id) AS unsub_in3d,
            ROUND(COUNT(DISTINCT c.user_id) / COUNT(DISTINCT n.user_id), 4) AS unsub_rate_day3
            FROM days JOIN notices n ON n.sub_date = d AND n.subscribed
            JOIN picked p ON p.user_id = n.user_id AND p.event_date = d
            LEFT JOIN v_geo g ON g.user_id = n.user_id AND g.event_date = d
            LEFT JOIN (SELECT x.user_id, x.order_id, x.sub_date, h.country FROM notices x
                LEFT JOIN v_geo h ON h.user_id = x.user_id AND h.event_date = x.sub_date WHERE NOT x.subscribed) c
            ON c.user_id = n.user_id AND c.order_id = n.order_id AND c.country = g.country
                AND c.sub_date BETWEEN d AND d + 3 AND {located} GROUP BY 1, 2, 3"""

    daily = {"days": AFTER_FIRST, "picked": DAILY_FIRST}
    whole = {"days": WHOLE, "picked": DAILY_FIRST}
    return {
        "b1_order_value": with_views(rounded(b1, "total_revenue"), days=AFTER_FIRST, picked=USER_FIRST, orders=orders),
        "b2_new_user_order_value": with_views(new_aov("revenue", "order_cnt", "aov"), orders=orders, **whole),
        "b3_new_user_subscription_value": with_views(
            new_aov("subscribe_revenue", "subscribe_order_cnt", "aov_subscribe"), orders="SELECT * FROM v_subscribe", **whole),
        "b4_revenue_per_user": with_views(b4, days=INNER, picked=DAILY_FIRST),
        "b5_revenue_per_paying_user": with_views(b5, days=INNER, picked=LATEST_DAY),
        "b6_lifetime_value": with_views(b6, days=AFTER_FIRST, picked=USER_FIRST),
        "b7_payment_rate_by_country": with_views(b7, **daily),
        "b8_new_user_payment_rate": with_views(b8, **whole),
        "b9_payment_ratio": with_views(b9("", first_day), **daily),
        "b9_payment_ratio_as_published": with_views(b9("DISTINCT", "0"), **daily),
        "b10_cancellation_rate": with_views(b10("TRUE"), notices=notices, **whole),
        "b10_cancellation_rate_same_day": with_views(b10("c.sub_date = d"), notices=notices, **whole),
    }


def _subscription() -> dict[str, str]:
    # Orders of both kinds joined on the variation, as the original report does.
    joined = """SELECT d AS event_date, u.variation_id, u.n AS experiment_user_count, COALESCE(nw.n, 0) AS new_subscribe_users,
        COUNT(s.user_id) AS so, COUNT(CASE WHEN NOT s.new_subscription THEN 1 END) AS sr,
        COUNT(CASE WHEN NOT s.new_product_subscription THEN 1 END) AS sn,
        COUNT(f.user_id) AS fo, COUNT(CASE WHEN f.is_first_flux = 0 THEN 1 END) AS fr
        FROM days JOIN (SELECT event_date, variation_id, COUNT(DISTINCT user_id) AS n FROM picked GROUP BY 1, 2) u ON u.event_date = d
        LEFT JOIN (SELECT event_date, variation_id, COUNT(DISTINCT user_id) AS n FROM subs WHERE new_subscription GROUP BY 1, 2) nw
            ON nw.event_date = d AND nw.variation_id = u.variation_id
        LEFT JOIN subs s ON s.event_date = d AND s.variation_id = u.variation_id
        LEFT JOIN fluxes f ON f.event_date = d AND f.variation_id = u.variation_id GROUP BY 1, 2, 3, 4"""
    apart = """SELECT d AS event_date, u.variation_id, u.n AS experiment_user_count, COALESCE(s.nw, 0) AS new_subscribe_users,
        COALESCE(s.so, 0) AS so, COALESCE(s.sr, 0) AS sr, COALESCE(s.sn, 0) AS sn, COALESCE(f.fo, 0) AS fo, COALESCE(f.fr, 0) AS fr
        FROM days JOIN (SELECT event_date, variation_id, COUNT(DISTINCT user_id) AS n FROM picked GROUP BY 1, 2) u ON u.event_date = d
        LEFT JOIN (SELECT event_date, variation_id, COUNT(DISTINCT CASE WHEN new_subscription THEN user_id END) AS nw, COUNT(*) AS so,
            COUNT(CASE WHEN NOT new_subscription THEN 1 END) AS sr, COUNT(CASE WHEN NOT new_product_subscription THEN 1 END) AS sn
            FROM subs GROUP BY 1, 2) s ON s.event_date = d AND s.variation_id = u.variation_id
        LEFT JOIN (SELECT event_date, variation_id, COUNT(*) AS fo, COUNT(CASE WHEN is_first_flux = 0 THEN 1 END) AS fr
            FROM fluxes GROUP BY 1, 2) f ON f.event_date = d AND f.variation_id = u.variation_id"""
    u1 = """SELECT event_date, variation_id, experiment_user_count, new_subscribe_users,
        ROUND(new_subscribe_users / experiment_user_count, 6) AS subscribe_rate, so AS subscribe_orders,
        sr AS subscribe_repeat_orders, sn AS subscribe_renew_orders,
        CASE WHEN so = 0 THEN 0 ELSE ROUND(sr / so, 6) END AS subscribe_repurchase_rate,
        CASE WHEN so = 0 THEN 0 ELSE ROUND(sn / so, 6) END AS subscribe_renew_rate,
        fo AS flux_orders, fr AS flux_repeat_orders, CASE WHEN fo = 0 THEN 0 ELSE ROUND(fr / fo, 6) END AS flux_repurchase_rate,
        so + fo AS total_orders, CASE WHEN so + fo = 0 THEN 0 ELSE ROUND((sr + fr) / (so + fo), 6) END AS repurchase_rate
        FROM counts"""
    parts = {"days": AFTER_FIRST, "picked": DAILY_FIRST,
             "subs": "SELECT s.*, variation_id FROM v_subscribe s JOIN picked USING (user_id, event_date)",
             "fluxes": "SELECT c.*, variation_id FROM v_currency c JOIN picked USING (user_id, event_date)"}

    def rate(first: bool, users: str, name: str) -> str:
        more = "AND new_subscription = 1" if first else ""
        return f"""SELECT d AS sub_date, p.variation_id, COUNT(DISTINCT p.user_id) AS group_user_count,
            COUNT(DISTINCT b.user_id) AS {users}, ROUND(COUNT(DISTINCT b.user_id) / COUNT(DISTINCT p.user_id), 4) AS {name}
            FROM days JOIN picked p ON p.event_date = d LEFT JOIN (
                SELECT user_id, sub_date FROM v_google WHERE notification_type = '4' {more}
                UNION ALL SELECT user_id, sub_date FROM v_apple WHERE notification_type = 'SUBSCRIBED' {more}) b
            ON b.user_id = p.user_id AND b.sub_date = d GROUP BY 1, 2"""

    return {
        "u1_subscription_orders": with_views(u1, **parts, counts=apart),
        "u1_subscription_orders_fanout": with_views(u1, **parts, counts=joined),
        "u2_subscription_rate": with_views(rate(False, "new_subscribe_users", "order_rate"),
                                           days=AFTER_FIRST, picked=DAILY_FIRST),
        "u3_first_subscription_rate": with_views(rate(True, "first_subscribe_users", "first_subscribe_rate"),
                                                 days=WHOLE, picked=DAILY_FIRST),
    }


def _phase_sums() -> dict[str, str]:
    in_phase = f"event_date BETWEEN {S} AND {E}"
    anyone = f"SELECT DISTINCT user_id, variation_id FROM v_assignment WHERE {in_phase}"
    g1 = rounded(f"""SELECT a.variation_id AS variation, a.n AS total_active_users, r.revenue AS total_recharge_revenue,
        ROUND(r.revenue / a.n, 4) AS recharge_ARPU, ROUND(r.payers / a.n, 4) AS recharge_conversion_rate,
        ROUND(r.orders / r.payers, 4) AS recharge_frequency
        FROM (SELECT variation_id, COUNT(DISTINCT user_id) AS n FROM anyone GROUP BY 1) a
        LEFT JOIN (SELECT variation_id, COUNT(*) AS orders, COUNT(DISTINCT user_id) AS payers, ROUND(SUM(revenue), 6) AS revenue
            FROM v_currency JOIN anyone USING (user_id) WHERE {in_phase} GROUP BY 1) r ON r.variation_id = a.variation_id""",
        "total_recharge_revenue")

    def v1(where: str) -> str:
        return rounded(f"""SELECT a.variation_id, a.n AS total_active_users, COALESCE(r.r, 0) AS total_ad_revenue,
            ROUND(COALESCE(r.r, 0) / a.n, 4) AS ad_arpu, COALESCE(x.users, 0) AS ad_exposure_users,
            ROUND(COALESCE(x.users, 0) / a.n, 4) AS ad_exposure_rate, COALESCE(x.shown, 0) AS ad_exposure_count,
            CASE WHEN COALESCE(x.shown, 0) = 0 THEN 0 ELSE ROUND(r.r / x.shown * 1000, 4) END AS ecpm,
            CASE WHEN COALESCE(x.users, 0) = 0 THEN 0 ELSE ROUND(x.shown / x.users, 4) END AS ad_exposure_per_user
            FROM (SELECT variation_id, COUNT(DISTINCT user_id) AS n FROM anyone GROUP BY 1) a
            LEFT JOIN (SELECT variation_id, ROUND(SUM(ad_revenue), 6) AS r FROM v_ads JOIN anyone USING (user_id) WHERE {where} GROUP BY 1) r
                ON r.variation_id = a.variation_id
            LEFT JOIN (SELECT variation_id, COUNT(*) AS shown, COUNT(DISTINCT user_id) AS users FROM v_ads
                JOIN anyone USING (user_id) WHERE {where} GROUP BY 1) x ON x.variation_id = a.variation_id""", "total_ad_revenue")

    g3 = """SELECT e.variation, c.total_active_users AS control_users, c.recharge_conversion_rate AS control_conversion_rate,
        c.recharge_ARPU AS control_ARPU, e.total_active_users AS exp_users, e.recharge_conversion_rate AS exp_conversion_rate,
        e.recharge_ARPU AS exp_ARPU,
        CASE WHEN c.recharge_conversion_rate > 0 THEN ROUND((e.recharge_conversion_rate - c.recharge_conversion_rate)
            / c.recharge_conversion_rate, 6) ELSE 0 END AS conversion_uplift,
        CASE WHEN c.recharge_ARPU > 0 THEN ROUND((e.recharge_ARPU - c.recharge_ARPU) / c.recharge_ARPU, 6) ELSE 0 END AS ARPU_uplift
        FROM sums e JOIN sums c ON c.variation = 0 WHERE e.variation <> 0"""
    v2 = """SELECT e.variation_id AS variation, c.total_active_users AS control_users,
        c.ad_exposure_rate AS control_ad_exposure_rate, c.ad_arpu AS control_ad_arpu, e.total_active_users AS exp_group_users,
        e.ad_exposure_rate AS exp_group_ad_exposure_rate, e.ad_arpu AS exp_group_ad_arpu,
        CASE WHEN c.ad_exposure_rate > 0 THEN ROUND((e.ad_exposure_rate - c.ad_exposure_rate) / c.ad_exposure_rate, 6) ELSE 0 END
            AS exposure_rate_uplift,
        CASE WHEN c.ad_arpu > 0 THEN ROUND((e.ad_arpu - c.ad_arpu) / c.ad_arpu, 6) ELSE 0 END AS ad_arpu_uplift
        FROM sums e JOIN sums c ON c.variation_id = 0 WHERE e.variation_id <> 0"""
    g3_full = f"""SELECT *, ROUND({beta_win("control_users * control_conversion_rate", "control_users",
        "exp_users * exp_conversion_rate", "exp_users")}, 6) AS conversion_chance_to_win,
        ROUND({phi("(exp_ARPU - control_ARPU) / SQRT(POWER(exp_ARPU / 5, 2) + POWER(control_ARPU / 5, 2))")}, 6)
        AS ARPU_chance_to_win FROM uplifts"""
    v2_full = f"""SELECT u.*, ROUND({beta_win("cx", "control_users", "ex", "exp_group_users")}, 6) AS exposure_rate_chance_to_win,
        ROUND({phi("(exp_group_ad_arpu - control_ad_arpu) / SQRT(POWER(exp_group_ad_arpu / 5, 2) + POWER(control_ad_arpu / 5, 2))")}, 6)
        AS ad_arpu_chance_to_win FROM uplifts u JOIN (SELECT e.variation_id, e.ad_exposure_users AS ex, c.ad_exposure_users AS cx
        FROM sums e JOIN sums c ON c.variation_id = 0) x ON x.variation_id = u.variation"""
    return {
        "g3_recharge_evaluation": with_views(g3_full, anyone=anyone, sums=g1, uplifts=g3),
        "v2_ads_evaluation": with_views(v2_full, anyone=anyone, sums=v1("TRUE"), uplifts=v2),
        "g1_recharge": with_views(g1, anyone=anyone),
        "g2_recharge_rolled_up": with_views(f"SELECT * FROM ({g1}) WHERE variation IS NOT NULL", anyone=anyone),
        "g3_recharge_uplift": with_views(g3, anyone=anyone, sums=g1),
        "v1_ads": with_views(v1("TRUE"), anyone=anyone),
        "v1_ads_in_phase": with_views(v1(in_phase), anyone=anyone),
        "v2_ads_uplift": with_views(v2, anyone=anyone, sums=v1("TRUE")),
    }


def _engagement() -> dict[str, str]:
    def daily(view: str, where: str, label: str, keys: str, unit: str = "event_id") -> str:
        return f"""SELECT d AS event_date, p.variation_id AS variation, COUNT(DISTINCT x.{unit}) AS total_{label},
            COUNT(DISTINCT x.user_id) AS unique_{label}_users,
            ROUND(COUNT(DISTINCT x.{unit}) / COUNT(DISTINCT x.user_id), 4) AS {label}_ratio
            FROM days JOIN {view} x ON x.event_date = d JOIN picked p ON {keys} WHERE {where} GROUP BY 1, 2"""

    same_day = "p.user_id = x.user_id AND p.event_date = x.event_date"
    same_user = "p.user_id = x.user_id"
    regen = """SELECT d AS event_date, g.variation_id AS variation, COUNT(DISTINCT x.event_id) AS total_regen,
        COUNT(DISTINCT x.user_id) AS unique_regen_users, CASE WHEN COUNT(DISTINCT x.user_id) = 0 THEN 0
        ELSE ROUND(COUNT(DISTINCT x.event_id) / COUNT(DISTINCT x.user_id), 4) END AS regen_ratio
        FROM days CROSS JOIN (SELECT DISTINCT variation_id FROM v_assignment) g
        LEFT JOIN (SELECT c.event_id, c.user_id, c.event_date, p.variation_id FROM v_chat c JOIN picked p USING (user_id)
            WHERE method = 'regenerate') x ON x.event_date = d AND x.variation_id = g.variation_id GROUP BY 1, 2"""
    phase = """SELECT variation, CAST(SUM(n) AS BIGINT) AS total_edit, CAST(SUM(u) AS BIGINT) AS unique_edit_users,
        ROUND(SUM(n) / SUM(u), 4) AS edit_ratio FROM (
            SELECT d, a.variation_id AS variation, COUNT(DISTINCT c.event_id) AS n, COUNT(DISTINCT c.user_id) AS u
            FROM days JOIN v_chat c ON c.ingest_timestamp >= d
                AND c.ingest_timestamp < CAST(d AS TIMESTAMP) + INTERVAL '23:59:59' AND c.method = 'edit'
            JOIN (SELECT DISTINCT user_id, variation_id FROM v_assignment) a ON a.user_id = c.user_id GROUP BY 1, 2)
        WHERE variation IS NOT NULL GROUP BY 1"""
    return {
        "e1_continues": with_views(daily("v_chat", "method = 'continue'", "continue", same_day), days=INNER, picked=DAILY_FIRST),
        "e2_conversation_resets": with_views(daily("v_reset", "TRUE", "conversation_reset", same_day), days=INNER, picked=DAILY_FIRST),
        "e3_edits": with_views(daily("v_chat", "method = 'edit'", "edit", same_day), days=INNER, picked=DAILY_FIRST),
        "e4_follows": with_views(daily("v_follow", "TRUE", "follow", same_user), days=INNER, picked=LATEST_DAY),
        "e5_new_conversations": with_views(
            daily("v_chat", "TRUE", "new_conversation", same_day, "conversation_id"), days=INNER,
            picked="SELECT DISTINCT user_id, event_date, variation_id FROM v_assignment"),
        "e6_regenerations": with_views(regen, days=INNER, picked=LATEST_DAY),
        "e7_edits_of_phase": with_views(phase, days=WHOLE),
    }


def _chat() -> dict[str, str]:
    new = "LEFT JOIN v_first_visit f ON f.user_id = {who}.user_id AND f.first_visit_date = d"
    c1 = f"""SELECT d AS event_date, a.variation_id AS variation, CAST(SUM(s.n) AS BIGINT) AS showed_events,
        CAST(SUM(COALESCE(v.n, 0)) AS BIGINT) AS clicked_events, ROUND(SUM(COALESCE(v.n, 0)) / NULLIF(SUM(s.n), 0), 4) AS click_ratio,
        CAST(SUM(CASE WHEN f.user_id IS NOT NULL THEN s.n ELSE 0 END) AS BIGINT) AS new_showed_events,
        CAST(SUM(CASE WHEN f.user_id IS NOT NULL THEN COALESCE(v.n, 0) ELSE 0 END) AS BIGINT) AS new_clicked_events,
        ROUND(SUM(CASE WHEN f.user_id IS NOT NULL THEN COALESCE(v.n, 0) ELSE 0 END)
            / NULLIF(SUM(CASE WHEN f.user_id IS NOT NULL THEN s.n ELSE 0 END), 0), 4) AS new_user_click_ratio
        FROM days CROSS JOIN picked a
        LEFT JOIN (SELECT user_id, event_date, COUNT(DISTINCT event_id) AS n FROM v_show_card GROUP BY 1, 2) s
            ON s.user_id = a.user_id AND s.event_date = a.event_date AND s.event_date = d
        LEFT JOIN (SELECT user_id, event_date, COUNT(DISTINCT event_id) AS n FROM v_bot_view GROUP BY 1, 2) v
            ON v.user_id = s.user_id AND v.event_date = s.event_date
        {new.format(who="s")} GROUP BY 1, 2"""

    def share(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} = 0 THEN 0 ELSE ROUND({part} / {whole}, 4) END"

    def n(what: str, when: str = "TRUE") -> str:
        return f"COUNT(DISTINCT CASE WHEN {when} THEN {what} END)"

    is_new = "f.user_id IS NOT NULL"
    chatted = "c.prompt_id IS NOT NULL"
    c2 = f"""SELECT d AS event_date, p.variation_id AS variation, {n("v.bot_id")} AS clicked_bots,
        {n("c.prompt_id")} AS chat_bots, {share(n("c.prompt_id"), n("v.bot_id"))} AS chat_start_rate,
        {n("v.bot_id", is_new)} AS new_clicked_bots, {n("c.prompt_id", is_new)} AS new_chat_bots,
        {share(n("c.prompt_id", is_new), n("v.bot_id", is_new))} AS new_chat_start_rate,
        {n("v.user_id")} AS clicked_users, {n("v.user_id", chatted)} AS started_users,
        {share(n("v.user_id", chatted), n("v.user_id"))} AS user_chat_start_rate,
        {share(n("v.user_id", f"{chatted} AND {is_new}"), n("v.user_id", is_new))} AS new_user_chat_start_rate
        FROM days JOIN v_bot_view v ON v.event_date = d JOIN picked p ON p.user_id = v.user_id AND p.event_date = d
        LEFT JOIN v_chat c ON c.user_id = v.user_id AND c.prompt_id = v.bot_id AND c.event_date = d
        {new.format(who="v")} GROUP BY 1, 2"""

    def depth(where: str, total: str, new_rounds: str) -> str:
        users, bots, ids, new_users = n("c.user_id"), n("c.prompt_id"), n("c.event_id"), n("c.user_id", is_new)
        return f"""SELECT d AS event_date, p.variation_id AS variation, {total} AS total_chat_rounds, {users} AS unique_users,
            {bots} AS chat_bots, ROUND({ids} / {bots}, 2) AS chat_depth_bot, ROUND({ids} / {users}, 2) AS chat_depth_user,
            ROUND({ids} / ({users} * {bots}), 4) AS chat_depth_per_user_per_bot,
            ROUND({new_rounds} / {bots}, 2) AS chat_depth_bot_new,
            ROUND({new_rounds} / NULLIF({new_users}, 0), 2) AS chat_depth_user_new,
            ROUND({new_rounds} / NULLIF({bots} * {new_users}, 0), 4) AS chat_depth_per_user_per_bot_new
            FROM days JOIN v_chat c ON c.event_date = d JOIN picked p ON p.user_id = c.user_id AND p.event_date = d
            {new.format(who="c")} WHERE {where} GROUP BY 1, 2"""

    def per_user(view: str, bot: str) -> str:
        pair = f"CONCAT(x.user_id, '_', x.{bot})"
        return f"""SELECT d AS event_date, p.variation_id, {n(pair)} AS total_click, {n("x.user_id")} AS total_user,
            ROUND({n(pair)} / {n("x.user_id")}, 4) AS avg_bot_clicked, {n(pair, is_new)} AS new_user_total_click,
            {n("x.user_id", is_new)} AS new_user_total_user,
            ROUND({n(pair, is_new)} / NULLIF({n("x.user_id", is_new)}, 0), 4) AS new_user_avg_bot_clicked
            FROM days JOIN {view} x ON x.event_date = d JOIN picked p ON p.user_id = x.user_id AND p.event_date = d
            {new.format(who="x")} GROUP BY 1, 2"""

    c6 = rounded(f"""SELECT d AS event_date, p.variation_id AS variation, SUM(m) AS total_time_minutes,
        COUNT(DISTINCT s.user_id) AS unique_users, ROUND(ROUND(SUM(m), 6) / COUNT(DISTINCT s.user_id), 2) AS avg_time_spent_minutes,
        SUM(CASE WHEN {is_new} THEN m ELSE 0 END) AS new_user_total_time_minutes, {n("s.user_id", is_new)} AS new_user_count,
        ROUND(ROUND(SUM(CASE WHEN {is_new} THEN m ELSE 0 END), 6) / NULLIF({n("s.user_id", is_new)}, 0), 2) AS new_user_avg_time_spent_minutes
        FROM days JOIN (SELECT user_id, event_date, ROUND(SUM(duration) / 1000 / 60, 2) AS m FROM v_session GROUP BY 1, 2) s
            ON s.event_date = d JOIN picked p ON p.user_id = s.user_id AND p.event_date = d
        {new.format(who="s")} GROUP BY 1, 2""", "total_time_minutes new_user_total_time_minutes")
    carried = f"""SELECT d, a.user_id, a.variation_id, COALESCE(s.n, 0) AS shows, COALESCE(v.n, 0) AS clicks, {is_new} AS is_new
        FROM days CROSS JOIN picked a
        LEFT JOIN (SELECT user_id, event_date, COUNT(DISTINCT event_id) AS n FROM v_show_card
            WHERE current_page = 'home' AND tab_name = 'Explore' GROUP BY 1, 2) s ON s.user_id = a.user_id AND s.event_date = d
        LEFT JOIN (SELECT user_id, event_date, COUNT(DISTINCT event_id) AS n FROM v_bot_view
            WHERE source = 'tag:Explore' GROUP BY 1, 2) v ON v.user_id = a.user_id AND v.event_date = d
        {new.format(who="a")}"""
    c7 = """SELECT d AS event_date, variation_id AS variation, COUNT(DISTINCT user_id) AS show_users,
        ROUND(SUM(shows) / COUNT(DISTINCT user_id), 4) AS avg_shows_per_user,
        ROUND(SUM(clicks) / NULLIF(SUM(shows), 0), 4) AS click_rate,
        COUNT(DISTINCT CASE WHEN is_new THEN user_id END) AS new_user_show_users,
        ROUND(SUM(CASE WHEN is_new THEN shows ELSE 0 END) / NULLIF(COUNT(DISTINCT CASE WHEN is_new THEN user_id END), 0), 4)
            AS avg_shows_per_new_user,
        ROUND(SUM(CASE WHEN is_new THEN clicks ELSE 0 END) / NULLIF(SUM(CASE WHEN is_new THEN shows ELSE 0 END), 0), 4)
            AS click_rate_new_user FROM carried GROUP BY 1, 2"""
    c8 = f"""SELECT d AS event_date, p.variation_id AS variation, {n("v.user_id")} AS clicked_users, {n("c.user_id")} AS chat_users,
        {share(n("c.user_id"), n("v.user_id"))} AS chat_start_rate, {n("v.user_id", is_new)} AS new_clicked_users,
        {n("c.user_id", is_new)} AS new_chat_users,
        {share(n("c.user_id", is_new), n("v.user_id", is_new))} AS new_chat_start_rate
        FROM days JOIN v_bot_view v ON v.event_date = d AND v.source = 'tag:Explore'
        JOIN picked p ON p.user_id = v.user_id AND p.event_date = d
        LEFT JOIN v_chat c ON c.user_id = v.user_id AND c.event_date = d AND c.source = 'tag:Explore'
        {new.format(who="v")} GROUP BY 1, 2"""
    c10 = """SELECT d AS event_date, variation_id, CAST(SUM(shows) AS BIGINT) AS total_shows,
        CAST(SUM(clicks) AS BIGINT) AS total_clicks, ROUND(SUM(clicks) / NULLIF(SUM(shows), 0), 4) AS click_through_rate,
        ROUND(SUM(shows) / COUNT(DISTINCT user_id), 4) AS avg_shows_per_user FROM carried GROUP BY 1, 2"""
    first, lowest = {"days": INNER, "picked": DAILY_FIRST}, {"days": INNER, "picked": DAILY_LOWEST}
    new_rows = f"COUNT(CASE WHEN {is_new} THEN 1 END)"
    return {
        "c1_click_rate": with_views(c1, **first),
        "c2_start_rate": with_views(c2, **lowest),
        "c3_chat_depth": with_views(depth("c.method <> 'generate'", n("c.event_id"), new_rows), **lowest),
        "c4_bots_viewed_per_user": with_views(per_user("v_bot_view", "bot_id"), **first),
        "c5_bots_chatted_per_user": with_views(per_user("v_chat", "prompt_id"), **first),
        "c6_time_spent": with_views(c6, days=AFTER_FIRST, picked=DAILY_FIRST),
        "c7_explore_click_rate": with_views(c7, days=EXPLORE, picked=FIRST_DAY, carried=carried),
        "c8_explore_start_rate": with_views(c8, **lowest),
        "c9_explore_chat_depth": with_views(
            depth("c.source = 'tag:Explore'", "COUNT(c.event_id)", n("c.event_id", is_new)), **lowest),
        "c10_recall_impressions": with_views(c10, days=WHOLE, picked=FIRST_DAY, carried=carried),
    }


def _statistics() -> dict[str, str]:
    t1 = rounded("""SELECT n_name AS country, users, payers, payers / users AS rate,
        GREATEST(0, payers / users - 1.96 * SQRT(payers / users * (1 - payers / users) / users)) AS ci_lower,
        LEAST(1, payers / users + 1.96 * SQRT(payers / users * (1 - payers / users) / users)) AS ci_upper FROM (
            SELECT n_name, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT CASE WHEN event_type = 'purchase'
            AND value > 40 THEN user_id END) AS payers FROM events JOIN nation ON n_nationkey = user_id % 25 GROUP BY 1)""",
        "rate ci_lower ci_upper")
    sample = "SELECT * FROM v_user_aov WHERE user_aov IS NOT NULL"
    moments = """SELECT COUNT(*) FILTER (variation_id = 0) AS na, COUNT(*) FILTER (variation_id = 1) AS nb,
        AVG(user_aov) FILTER (variation_id = 0) AS ma, AVG(user_aov) FILTER (variation_id = 1) AS mb,
        VAR_SAMP(user_aov) FILTER (variation_id = 0) AS va, VAR_SAMP(user_aov) FILTER (variation_id = 1) AS vb FROM sample"""
    t7 = rounded("""SELECT n, r2, 'variation_id' AS term, slope AS coefficient, SQRT(s2 / sxx) AS std_error,
            slope / SQRT(s2 / sxx) AS t_stat FROM fit
        UNION ALL SELECT n, r2, 'intercept', b, SQRT(s2 * (1 / n + mx * mx / sxx)), b / SQRT(s2 * (1 / n + mx * mx / sxx)) FROM fit""",
        "r2 coefficient std_error t_stat")
    fit = """SELECT c.*, (SELECT SUM(POWER(user_aov - b - slope * variation_id, 2)) FROM sample) / (n - 2) AS s2 FROM (
        SELECT COUNT(*) AS n, regr_slope(user_aov, variation_id) AS slope, regr_intercept(user_aov, variation_id) AS b,
        regr_r2(user_aov, variation_id) AS r2, SUM(POWER(variation_id, 2)) - COUNT(*) * POWER(AVG(variation_id), 2) AS sxx,
        AVG(variation_id) AS mx FROM sample) c"""
    t8 = rounded("""SELECT na AS n_a, nb AS n_b, ma AS mean_a, mb AS mean_b, mb - ma AS mean_diff, SQRT(va / na + vb / nb) AS se,
        (ma - mb) / SQRT(va / na + vb / nb) AS t_stat,
        POWER(va / na + vb / nb, 2) / (POWER(va / na, 2) / (na - 1) + POWER(vb / nb, 2) / (nb - 1)) AS t_df,
        (mb - ma) / SQRT(va / na + vb / nb) AS z_stat FROM moments""", "mean_a mean_b mean_diff se t_stat t_df z_stat")
    t9 = rounded("""SELECT mb - ma AS uplift_mean, mb - ma - 1.959963984540054 * SQRT(va / na + vb / nb) AS ci_low,
        mb - ma + 1.959963984540054 * SQRT(va / na + vb / nb) AS ci_high FROM moments""", "uplift_mean ci_low ci_high")
    t11 = rounded("""SELECT na AS n_a, nb AS n_b, u AS u_stat, (GREATEST(u, na * nb - u) - na * nb / 2 - 0.5)
        / SQRT(na * nb / 12 * (n + 1 - ties / (n * (n - 1)))) AS z_stat FROM (
            SELECT COUNT(*) FILTER (variation_id = 0) AS na, COUNT(*) FILTER (variation_id = 1) AS nb, COUNT(*) AS n,
            SUM(r) FILTER (variation_id = 0) - na * (na + 1) / 2 AS u, SUM(t * t - 1) AS ties FROM (
                SELECT variation_id, RANK() OVER (ORDER BY user_aov) + (COUNT(*) OVER (PARTITION BY user_aov) - 1) / 2 AS r,
                COUNT(*) OVER (PARTITION BY user_aov) AS t FROM sample))""", "u_stat z_stat")
    order_sample = "SELECT o_custkey % 2 AS variation_id, ROUND(o_totalprice, -3) AS user_aov FROM orders"
    t12 = rounded("""SELECT variation_id, COUNT(*) AS n, AVG(user_aov) AS mean, VAR_SAMP(user_aov) AS variance
        FROM sample GROUP BY 1""", "mean variance")
    t6 = """SELECT TRY_CAST(v AS INT) AS variation_id, ROUND(TRY_CAST(a AS DOUBLE), 6) AS user_aov FROM (
        SELECT CAST(variation_id AS VARCHAR) AS v, CASE WHEN user_id % 7 = 0 THEN 'n/a' WHEN user_id % 11 = 0 THEN NULL
        ELSE CAST(user_aov AS VARCHAR) END AS a FROM v_user_aov) WHERE TRY_CAST(a AS DOUBLE) IS NOT NULL"""
    payers = """SELECT n_name AS country, n_regionkey AS region, COUNT(DISTINCT user_id) AS users,
        COUNT(DISTINCT CASE WHEN event_type = 'purchase' AND value > 40 THEN user_id END) AS payers
        FROM events JOIN nation ON n_nationkey = user_id % 25 GROUP BY 1, 2"""
    sides = """SELECT e.country, e.users AS eu, e.payers AS er, c.users AS cu, c.payers AS cr FROM payers e
        JOIN payers c ON c.region = e.region AND c.country = (SELECT MIN(country) FROM payers m WHERE m.region = e.region)"""
    t2 = f"""SELECT country, eu AS users, er AS payers, cu AS control_users, cr AS control_payers,
        ROUND(((er + 1) / (eu + 2) - (cr + 1) / (cu + 2)) / ((cr + 1) / (cu + 2)), 6) AS uplift,
        ROUND({WIN}, 6) AS chance_to_win FROM sides"""
    t2_bounds = """SELECT country, ROUND(low / ((cr + 1) / (cu + 2)), 6) AS uplift_ci_lower,
        ROUND(high / ((cr + 1) / (cu + 2)), 6) AS uplift_ci_upper FROM sides JOIN bounds USING (country)"""
    bits = "18446744073709551616::UHUGEINT"

    def mixed(source: str) -> str:
        """SplitMix64 of column h, in 64 bits."""
        text = f"SELECT * REPLACE (((h::UHUGEINT + 11400714819323198485::UHUGEINT) % {bits})::UBIGINT AS h) FROM ({source})"
        for shift, factor in ((30, "13787848793156543929"), (27, "10723151780598845931")):
            text = f"""SELECT * REPLACE (((xor(h, h >> {shift}::UBIGINT)::UHUGEINT * {factor}::UHUGEINT) % {bits})::UBIGINT AS h)
                FROM ({text})"""
        return f"SELECT * REPLACE (xor(h, h >> 31::UBIGINT) AS h) FROM ({text})"

    keys = mixed("SELECT *, ('0x' || SUBSTR(MD5(CAST(user_id AS VARCHAR)), 1, 16))::UBIGINT AS h FROM sample")
    steps = mixed("SELECT i AS resample, i::UBIGINT AS h FROM generate_series(1, 10000) g(i)")
    both = mixed(f"SELECT k.* EXCLUDE (h), s.resample, xor(k.h, s.h) AS h FROM ({keys}) k, ({steps}) s")
    # A hash above 1 - P(more than k draws) stands for more than k draws of a Poisson(1) variable.
    tails = [sum(exp(-1) / factorial(j) for j in range(k + 30, k, -1)) * 2**64 for k in range(40)]
    drawn = f"SELECT *, {' + '.join(f'(h >= {2**64 - int(t)}::UBIGINT)::INT' for t in tails if t >= 1)} AS times FROM ({both})"
    t10 = rounded("""SELECT AVG(d) AS mean_diff, QUANTILE_CONT(d, 0.025) AS ci_low, QUANTILE_CONT(d, 0.975) AS ci_high,
        AVG((d > 0)::INT) AS boot_prob FROM (SELECT resample,
            SUM(times * user_aov) FILTER (variation_id = 1) / NULLIF(SUM(times) FILTER (variation_id = 1), 0)
            - SUM(times * user_aov) FILTER (variation_id = 0) / NULLIF(SUM(times) FILTER (variation_id = 0), 0) AS d
            FROM drawn GROUP BY 1)""", "mean_diff ci_low ci_high boot_prob")
    averages = """SELECT n_name AS country, n_regionkey AS region, AVG(value) AS m FROM events
        JOIN nation ON n_nationkey = user_id % 25 GROUP BY 1, 2"""
    pairs = """SELECT e.country, e.m, c.m AS cm FROM averages e JOIN averages c ON c.region = e.region
        AND c.country = (SELECT MIN(country) FROM averages o WHERE o.region = e.region)"""
    t3 = f"""SELECT country, ROUND(m, 6) AS mean, ROUND(cm, 6) AS control_mean,
        ROUND({phi("(m - cm) / SQRT(POWER(m / 5, 2) + POWER(cm / 5, 2))")}, 6) AS chance_to_win FROM pairs"""
    t7_p = rounded(f"SELECT *, {student('t_stat', '(n - 2)')} AS p_value FROM base", "r2 coefficient std_error t_stat p_value")
    t8_p = rounded(f"SELECT *, {student('t_stat', 't_df')} AS t_p, 2 * (1 - {phi('ABS(z_stat)')}) AS z_p FROM base",
                   "mean_a mean_b mean_diff se t_stat t_df z_stat t_p z_p")
    t9_p = f"""SELECT base.*, ROUND({phi("(mb - ma) / SQRT(va / na + vb / nb)")}, 6) AS bayes_prob FROM base, moments"""
    t11_p = rounded(f"SELECT *, CASE WHEN z_stat <= 0 THEN 1 ELSE 2 * (1 - {phi('z_stat')}) END AS u_p FROM base", "u_stat z_stat u_p")
    return {
        "t2_beta_comparison": with_views(t2, payers=payers, sides=sides),
        "t3_assumed_normal_win": with_views(t3, averages=averages, pairs=pairs),
        "t7_regression_p_values": with_views(t7_p, sample=sample, fit=fit, base=t7.replace(", 6) AS", ", 12) AS")),
        "t8_mean_tests_p_values": with_views(t8_p, sample=sample, moments=moments, base=t8.replace(", 6) AS", ", 12) AS")),
        "t9_posterior_difference_probability": with_views(t9_p, sample=sample, moments=moments, base=t9),
        "t11_rank_test_p_value": with_views(t11_p, sample=sample, base=t11.replace(", 6) AS", ", 12) AS")),
        "t1_proportion_interval": with_views(t1),
        "t2_beta_interval": with_views(t2_bounds, payers=payers, sides=sides, **bounds("country")),
        "t10_bootstrap": with_views(t10, sample=sample, drawn=drawn),
        "t4_t5_uplifts": with_views("""SELECT day, SUM(er)::BIGINT AS pooled_retained, SUM(eu)::BIGINT AS pooled_users,
            CASE WHEN MAX(cr) > 0 THEN ROUND((SUM(er) / SUM(eu) - MAX(cr) / MAX(cu)) / (MAX(cr) / MAX(cu)), 6) ELSE 0 END
            AS freq_uplift FROM sides GROUP BY 1""", **R2_PARTS, **overall(True)[1]),
        "t6_numeric_sample": with_views(t6),
        "t7_regression": with_views(t7, sample=sample, fit=fit),
        "t8_mean_tests": with_views(t8, sample=sample, moments=moments),
        "t9_posterior_difference": with_views(t9, sample=sample, moments=moments),
        "t11_rank_test": with_views(t11, sample=sample),
        "t11_rank_test_tied": with_views(t11, sample=order_sample),
        "t12_group_moments": with_views(t12, sample=sample),
    }


# Experiment documents derived from the orders table: one document per order.
DOCUMENTS = """SELECT o_orderkey AS position, 'exp_' || o_orderkey AS name,
    [' tag ' || (o_custkey % 97)] || CASE WHEN o_orderkey % 3 = 0 THEN ['team_' || (o_orderkey % 11)] ELSE [] END AS tags,
    o_orderkey % 4 AS n_variations,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'soon'
        ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.5Z' END AS start_text,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
        ELSE strftime(o_orderdate + to_days(CAST(o_orderkey % 120 AS INT)), '%Y-%m-%dT12:%M:%S') || '.25Z' END AS end_text
    FROM orders"""
AS_OF = "TIMESTAMP '2001-08-02 08:00:00'"


def _catalog() -> dict[str, str]:
    started = "TRY_CAST(SUBSTR(CASE WHEN start_text = 'soon' THEN NULL ELSE start_text END, 1, 19) AS TIMESTAMP)"
    tagged = f"SELECT *, {started} AS started FROM (SELECT *, UNNEST(list_transform(tags, lambda t: TRIM(t))) AS tag FROM documents)"
    latest = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tag ORDER BY started DESC NULLS LAST, position) AS rn
        FROM tagged) WHERE rn = 1"""
    ended = f"SELECT *, COALESCE(CAST(SUBSTR(end_text, 1, 19) AS TIMESTAMP), {AS_OF}) AS ended FROM latest WHERE started IS NOT NULL"
    kept = f"""SELECT * FROM ended WHERE epoch({AS_OF} - started) >= 2 * 86400 AND FLOOR(epoch(ended - started) / 86400) <= 90"""
    described = """SELECT tag, name AS experiment_name, REPLACE(ARRAY_TO_STRING(tags, '_'), ' ', '') AS tags,
        started AS phase_start_time, ended AS phase_end_time, CAST(n_variations AS INT) AS number_of_variations,
        CASE WHEN n_variations > 0 THEN '0' END AS control_group_key FROM kept"""
    parts = {"documents": DOCUMENTS, "tagged": tagged, "latest": latest, "ended": ended, "kept": kept, "described": described}
    overrides = f"""SELECT 'tag_by_hand' AS tag, 'exp_by_hand_' || r_regionkey AS experiment_name, 'tag_by_hand' AS tags,
        TIMESTAMP '2000-12-01' AS phase_start_time, TIMESTAMP '2000-12-20' AS phase_end_time, 2 AS number_of_variations,
        '0' AS control_group_key FROM region"""
    published = """SELECT experiment_name, tags, phase_start_time, phase_end_time, number_of_variations, control_group_key
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY experiment_name, tags ORDER BY tag) AS rn FROM described) WHERE rn = 1"""
    return {
        "m8_m10_stored_and_looked_up": with_views(
            "SELECT tag, experiment_name, phase_start_time, phase_end_time, number_of_variations FROM described", **parts),
        "m1_documents_by_tag": with_views("SELECT name, tag, started FROM tagged", **parts),
        "m3_latest_by_tag": with_views("SELECT tag, name, started FROM latest", **parts),
        "m4_eligible": with_views("SELECT tag, name, started, ended FROM kept", **parts),
        "m5_described": with_views("SELECT * FROM described", **parts),
        "m6_m7_with_overrides": with_views(f"SELECT * FROM described UNION ALL ({overrides})", **parts),
        "s3_exported_documents": with_views("SELECT * FROM described", **parts),
        "m7_as_published": with_views(published, **parts),
        "m9_tags": with_views("SELECT DISTINCT tag FROM described", **parts),
        "m10_lookup": with_views("SELECT * FROM described WHERE tag = 'team_3'", **parts),
    }


def _publication(found: dict[str, str]) -> dict[str, str]:
    """The same rows as the reports that are written, typed, previewed and renamed."""
    order_value = found["b1_order_value"]
    headings = {"control_users": "对照组人数", "control_rate": "对照组留存率", "exp_users": "实验组人数",
                "exp_rate": "实验组留存率", "d1_rate": "d1留存率", "d3_rate": "d3留存率", "d7_rate": "d7留存率",
                "d15_rate": "d15留存率", "coverage_ratio": "覆盖占比"}
    renamed = ", ".join(f'{old} AS "{new}"' for old, new in headings.items())
    edits = {"event_date": "日期", "variation": "实验分组", "total_edit": "编辑事件数", "unique_edit_users": "活跃编辑用户数",
             "edit_ratio": "人均编辑次数"}
    edits = ", ".join(f'{old} AS "{new}"' for old, new in edits.items())
    filled = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in
                       ("showed_events", "clicked_events", "click_ratio", "new_showed_events", "new_clicked_events",
                        "new_user_click_ratio"))
    return {
        "s4_s5_csv_round_trip": order_value,
        "s6_published_twice": order_value,
        "s9_typed_report": order_value,
        "s13_preview": f"SELECT event_date, variation, {filled} FROM ({found['c1_click_rate']})",
        "s14_edit_headings": f"SELECT {edits} FROM ({found['e3_edits']})",
        "s14_headings": f"SELECT dt, variation, {renamed}, exp_ci_lower, exp_ci_upper "
                        f"FROM ({found['r6_new_user_report_rates']})",
    }


#: Tag, first and last day, start, end and length in days of the phases that are reported together.
SEVERAL = [("demo", S, E, TS, TE, 26),
           ("inside", "DATE '2024-01-10'", "DATE '2024-01-19'", "TIMESTAMP '2024-01-10 00:00:00'", "TIMESTAMP '2024-01-19 12:00:00'", 9),
           ("later", "DATE '2024-01-17'", "DATE '2024-02-06'", "TIMESTAMP '2024-01-17 09:00:00'", "TIMESTAMP '2024-02-06 21:00:00'", 20)]
TOGETHER = {
    "m11_together_order_value": "b1_order_value", "m11_together_revenue_per_user": "b4_revenue_per_user",
    "m11_together_lifetime_value": "b6_lifetime_value", "m11_together_cancellation_rate": "b10_cancellation_rate",
    "m11_together_click_rate": "c1_click_rate", "m11_together_chat_depth": "c3_chat_depth",
    "m11_together_retention_new": "r1_new_user_retention", "m11_together_retention_active": "r2_active_user_retention",
    "m11_together_recharge": "g2_recharge_rolled_up", "m11_together_edits_of_phase": "e7_edits_of_phase", "m11_run_together": "b1_order_value"}
KEPT = ("a2_first_ever", "a3_latest_day", "a7_first_day", "r1_new_user_retention", "r2_active_user_retention", "r3_country_retention", "r4_merged_parts")


def at_phase(sql: str, first: str, last: str, start: str, end: str, length: int) -> str:
    """The SQL of a report for another phase."""
    for usual, other in ((TS, start), (TE, end), (S, first), (E, last), ("+ 26", f"+ {length}")):
        sql = sql.replace(usual, f"<{other}>")
    return re.sub(r"<((?:DATE|TIMESTAMP) '[^']*'|\+ \d+)>", r"\1", sql)


def together(sql: str) -> str:
    return " UNION ALL ".join(f"SELECT '{tag}' AS tag, * FROM ({at_phase(sql, *phase)})" for tag, *phase in SEVERAL)


HARD = ("t4_t5_uplifts", "r8_new_user_overall", "g3_recharge_uplift", "v2_ads_uplift", "c1_click_rate", "c2_start_rate",
        "c3_chat_depth", "e6_regenerations", "b8_new_user_payment_rate", "r3_country_retention")


def oracle_sql() -> dict[str, str]:
    found = {**_assignments(), **_windows(), **_retention(), **_business(), **_subscription(), **_phase_sums(),
             **_engagement(), **_chat(), **_statistics(), **_catalog()}
    found.update({f"{name}_hard": on_hard_events(found[name]) for name in HARD})
    found.update({name: together(found[of]) for name, of in TOGETHER.items()})
    found.update({f"{name}_kept": found[name] for name in KEPT})
    found["s6_s11_days_replaced"] = found["b1_order_value"]
    found["s4_bad_records_set_apart"] = with_views("""SELECT event_date, COUNT(*) FILTER (event_id % 19 <> 0) AS orders,
        ROUND(SUM(revenue) FILTER (event_id % 19 <> 0), 6) AS revenue, COUNT(*) FILTER (event_id % 19 = 0) AS set_apart
        FROM v_currency GROUP BY 1""")
    return {name: half_up(text) for name, text in {**found, **_publication(found)}.items()}
