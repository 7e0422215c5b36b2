"""DuckDB SQL for the fixture views, used by the correctness oracle.

Each function returns a ``name AS (...)`` CTE body; ``with_views`` assembles
the views a query needs, in dependency order, ahead of its final SELECT. The
SQL is written independently of the Spark code, sharing only the fixed
values (breakpoints, band bounds, texts).
"""

from __future__ import annotations

from aerolith.functions.aqi import (
    ACTIVITY, ALERT_LEVELS, ALERT_UPPER, BAND_UPPER, CARD_CLASSES, CATEGORIES, COLORS,
    GUIDANCE, PM10_BREAKPOINTS, PM25_BREAKPOINTS, UNKNOWN,
)


def d(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub_index_sql(c: str, table) -> str:
    parts = [f"CASE WHEN {c} IS NULL OR isnan({c}) OR {c} < 0 THEN NULL"]
    for lo, hi, ilo, ihi in table:
        val = f"({d(ihi)} - {d(ilo)}) / ({d(hi)} - {d(lo)}) * ({c} - {d(lo)}) + {d(ilo)}"
        parts.append(f"WHEN {c} >= {d(lo)} AND {c} <= {d(hi)} THEN round_even({val}, 0)")
    parts.append(f"WHEN {c} > {d(table[-1][1])} THEN 500 END")
    return "CAST(" + " ".join(parts) + " AS BIGINT)"


def band_sql(c: str, values, uppers=BAND_UPPER) -> str:
    parts = [f"CASE WHEN {c} IS NULL OR isnan({c}) THEN {q(values[0])}"]
    for i, u in enumerate(uppers):
        parts.append(f"WHEN {c} <= {d(u)} THEN {q(values[i + 1])}")
    parts.append(f"ELSE {q(values[len(uppers) + 1])} END")
    return " ".join(parts)


def category_sql(c: str) -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", [UNKNOWN] + CATEGORIES)


def alert_sql(c: str) -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", [UNKNOWN] + ALERT_LEVELS, ALERT_UPPER)


def guidance_sql(c: str, variant: str = "scoring") -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", GUIDANCE[variant])


def color_sql(c: str) -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", COLORS)


def card_sql(c: str) -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", CARD_CLASSES)


def activity_level_sql(c: str) -> str:
    return band_sql(f"CAST({c} AS DOUBLE)", [a[0] for a in ACTIVITY])


def season_sql(m: str) -> str:
    return (f"CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring' "
            f"WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")


def calendar_sql(ts: str = '"timestamp"') -> str:
    return (f"CAST(hour({ts}) AS BIGINT) AS hour, CAST(day({ts}) AS BIGINT) AS day, "
            f"CAST(month({ts}) AS BIGINT) AS month, CAST(year({ts}) AS BIGINT) AS year, "
            f"dayname({ts}) AS day_of_week, CAST(isodow({ts}) >= 6 AS BIGINT) AS is_weekend, "
            f"{season_sql(f'month({ts})')} AS season")


K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

VIEWS = {
    "obs": f"""SELECT event_id AS obs_id, event_type AS city, user_id AS station_id, ts AS "timestamp",
        value AS pm2_5, 2 * value + {K} / 10 AS pm10, 10 + 0.3 * {K} AS temperature FROM events""",
    "scored": f"""SELECT o.*, {sub_index_sql('pm2_5', PM25_BREAKPOINTS)} AS pm25_index,
        {sub_index_sql('pm10', PM10_BREAKPOINTS)} AS pm10_index,
        greatest({sub_index_sql('pm2_5', PM25_BREAKPOINTS)}, {sub_index_sql('pm10', PM10_BREAKPOINTS)}) AS us_aqi
        FROM obs o""",
    "series": """SELECT city, date_trunc('hour', "timestamp") AS "timestamp",
        round(avg(pm2_5), 6) AS pm2_5, round(avg(pm10), 6) AS pm10, round(avg(temperature), 6) AS temperature,
        round_even(avg(us_aqi), 0) AS us_aqi, count(*) AS n_obs
        FROM scored WHERE city IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY ALL""",
    "feats": f"""SELECT s.*, {calendar_sql('s."timestamp"')},
        lag(us_aqi, 1) OVER w AS aqi_lag_1, lag(us_aqi, 3) OVER w AS aqi_lag_3,
        lag(us_aqi, 6) OVER w AS aqi_lag_6, lag(us_aqi, 24) OVER w AS aqi_lag_24,
        CASE WHEN count(us_aqi) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
             THEN avg(us_aqi) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS aqi_roll_3,
        CASE WHEN count(us_aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) = 6
             THEN avg(us_aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) END AS aqi_roll_6,
        CASE WHEN count(us_aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) = 24
             THEN avg(us_aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS aqi_roll_24,
        lead(us_aqi, 3) OVER w AS target_aqi
        FROM series s WINDOW w AS (PARTITION BY city ORDER BY "timestamp")""",
    "obs_raw": """SELECT obs_id,
        CASE WHEN obs_id % 83 = 0 THEN NULL ELSE city END AS city,
        CAST(station_id AS VARCHAR) AS station_id,
        CASE WHEN obs_id % 97 = 0 THEN 'not-a-time' ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp",
        CASE WHEN obs_id % 89 = 0 THEN 'n/a' ELSE CAST(pm2_5 AS VARCHAR) END AS pm2_5,
        CAST(pm10 AS VARCHAR) AS pm10, CAST(temperature AS VARCHAR) AS temperature FROM obs""",
    "dup": """SELECT *, 0 AS ingest_seq FROM obs
        UNION ALL SELECT obs_id, city, station_id, "timestamp", pm2_5 + 1.0, pm10, temperature, 1 FROM obs WHERE obs_id % 10 = 0""",
    "weather": """SELECT obs_id, city, "timestamp", station_id, temperature FROM obs""",
    "pollution": """SELECT obs_id, city, "timestamp", pm2_5, pm10 FROM obs WHERE obs_id % 50 <> 0""",
    "runs": """SELECT p_brand AS model,
        CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS version_no,
        p_partkey AS run_id, 5.0::DOUBLE + CAST((p_partkey * 7919) % 997 AS DOUBLE) / 100.0::DOUBLE AS rmse FROM part""",
    "series_hist": """SELECT city, "timestamp", us_aqi FROM series""",
    "series_rt": """SELECT s.city, s."timestamp", s.us_aqi FROM series s
        JOIN (SELECT city, max("timestamp") AS last_ts FROM series GROUP BY city) l USING (city)
        WHERE s.city NOT IN ('click', 'error') OR s."timestamp" > l.last_ts - INTERVAL 12 HOUR""",
}

DEPS = {
    "obs": [], "scored": ["obs"], "series": ["scored"], "feats": ["series"], "obs_raw": ["obs"],
    "dup": ["obs"], "weather": ["obs"], "pollution": ["obs"], "runs": [],
    "series_hist": ["series"], "series_rt": ["series"],
}


def _order(names):
    out = []

    def visit(n):
        for dep in DEPS[n]:
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], body: str, extra: list[tuple[str, str]] | None = None,
               recursive: bool = False) -> str:
    ctes = [f"{n} AS ({VIEWS[n]})" for n in _order(views)]
    ctes += [f"{n} AS ({s})" for n, s in (extra or [])]
    head = "WITH RECURSIVE " if recursive else "WITH "
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return head + ",\n".join(ctes) + ",\n" + stripped[5:]
    return head + ",\n".join(ctes) + "\n" + body
