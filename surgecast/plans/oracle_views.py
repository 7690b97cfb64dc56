"""Reference-shaped inputs as SQL text for the DuckDB oracle.

The same derivations as ``surgecast.sources.tables.Tables``, spelled in the
SQL subset DuckDB and Spark share. ``ctes(...)`` returns a WITH-prefix holding
the requested views (and the views they depend on).
"""

from __future__ import annotations

HOURLY_SUM = "cast(sum(cast(value AS decimal(12,2))) AS double)"

VIEWS: dict[str, str] = {
    "watch_traffic": """
SELECT user_id AS id, event_type AS sport, 'L' || cast(user_id % 4 AS varchar) AS league,
       date_trunc('hour', ts) AS starttime, count(*) AS cnt
FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)""",
    "service_traffic": f"""
SELECT date_trunc('hour', ts) AS datetime, {HOURLY_SUM} AS service_count
FROM events GROUP BY date_trunc('hour', ts)""",
    "baseline": f"""
SELECT datetime AS ds, 0.8 * avg(service_count) OVER (PARTITION BY hour(datetime)) AS baseline_count
FROM (SELECT date_trunc('hour', ts) AS datetime, {HOURLY_SUM} AS service_count
      FROM events GROUP BY date_trunc('hour', ts)) h""",
    "calendar": """
SELECT c.id, n0.n_name || ' at ' || n1.n_name AS name, 'L' || cast(c.id % 4 AS varchar) AS league,
       CASE c.id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'purchase' END AS sport,
       c.date_utc, c.date_utc + cast(60 + c.id % 180 AS int) * interval '1' minute AS end_with_avg_duration,
       n0.n_name AS team_0_display_name, n1.n_name AS team_1_display_name,
       CASE c.id % 4 WHEN 0 THEN 'A|B' WHEN 1 THEN 'A,C' WHEN 2 THEN 'B' END AS media,
       CASE WHEN c.id % 5 = 0 THEN NULL ELSE 'V' || cast(c.id % 7 AS varchar) END AS venue
FROM (SELECT user_id AS id, date_trunc('minute', min(ts)) + cast(user_id % 29 AS int) * interval '1' day AS date_utc
      FROM events GROUP BY user_id) c
JOIN nation n0 ON n0.n_nationkey = c.id % 25
JOIN nation n1 ON n1.n_nationkey = (c.id + 7) % 25""",
    "airings": """
SELECT l_orderkey % 200 AS event_id, cast(l_orderkey % 200 AS varchar) AS game_id,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag || l_linestatus END AS network_name
FROM lineitem""",
    "scheduled_tasks": f"""
SELECT date_trunc('hour', ts) AS datetime, cast(ceil({HOURLY_SUM} / 100) AS bigint) AS n_tasks
FROM events GROUP BY date_trunc('hour', ts)""",
    "predictions_full": f"""
SELECT date_trunc('hour', ts) AS ds, {HOURLY_SUM} AS total,
       coalesce(cast(sum(CASE WHEN event_type = 'click' AND value > 40 THEN cast(value AS decimal(12,2)) END) AS double), 0.0E0) AS click,
       coalesce(cast(sum(CASE WHEN event_type = 'view' AND value > 40 THEN cast(value AS decimal(12,2)) END) AS double), 0.0E0) AS view_,
       coalesce(cast(sum(CASE WHEN event_type = 'purchase' AND value > 40 THEN cast(value AS decimal(12,2)) END) AS double), 0.0E0) AS purchase
FROM events GROUP BY date_trunc('hour', ts)""",
    "service_metrics": f"""
SELECT date_trunc('hour', ts) AS datetime, {HOURLY_SUM} AS traffic,
       {HOURLY_SUM} / count(*) AS cpu_util,
       cast(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS double) / count(*) AS error_rate,
       max(value) AS response_time, count(DISTINCT user_id) AS running_ecs
FROM events GROUP BY date_trunc('hour', ts)""",
    "series": f"""
SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, {HOURLY_SUM} AS value
FROM events GROUP BY event_type, date_trunc('hour', ts)""",
    "anomaly_points": """
SELECT event_type AS series_id, ts, value FROM events WHERE value > 40""",
    "scored": """
SELECT l_returnflag AS model, l_extendedprice AS y,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS yhat
FROM lineitem""",
    "rankings": """
SELECT n_name AS team_name, 2024 AS year, n_nationkey + 1 AS league_rank FROM nation""",
    "service_info": """
SELECT 'svc' || cast(r_regionkey AS varchar) AS service, r_name AS region,
       cast(1000 + r_regionkey AS varchar) AS account_id, 'cl-' || r_name AS cluster_name FROM region""",
    "ranking_pages": """
        SELECT page_id, '<table><tr><th>Rk</th><th>Team</th></tr>' ||
               string_agg('<tr><td>' || rk || '</td><td> <b>' || c_name || '</b></td></tr>', '' ORDER BY rk) || '</table>' AS html
        FROM (SELECT c_custkey // 50 AS page_id, c_name,
                     row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_acctbal DESC, c_custkey) AS rk FROM customer) x
        GROUP BY page_id""",
}


def ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH-prefix with the named views, then ``extra`` CTEs in order."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
