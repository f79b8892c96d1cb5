"""DuckDB SQL for each registered query, written independently of the Spark code."""

from __future__ import annotations

# Ratios are rounded as decimals: Spark rounds the decimal form of a double half up (1.025 gives 1.03), DuckDB rounds
# the binary value.
_EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
         CAST(json_extract(props, '$.k') AS BIGINT) * 21 AS product_id,
         CASE event_type WHEN 'signup' THEN 'SEARCH' WHEN 'view' THEN 'VIEW_PRODUCT' WHEN 'click' THEN 'ADD_TO_CART'
                         WHEN 'purchase' THEN 'PURCHASE' WHEN 'error' THEN 'ERROR' END AS event_type,
         CASE CAST(json_extract(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN 'WEB' WHEN 1 THEN 'IOS' ELSE 'ANDROID' END
           AS platform,
         date_trunc('second', ts) AS occurred_at,
         strftime(ts, '%Y-%m-%d') AS "date", strftime(ts, '%H') AS "hour"
  FROM events)"""

_SILVER = _EVENTS + """,
cat AS (SELECT p_type, min(p_partkey) AS category_id FROM part GROUP BY p_type),
silver AS (
  SELECT e.event_id, e.occurred_at, e.event_type, e.platform, e.user_id, lower(c.c_name) AS username,
         c.c_name AS full_name, e.product_id, lower(c.c_name) || '@example.com' AS email,
         TIMESTAMP '2020-01-01' + to_days(CAST(c.c_custkey AS INTEGER)) AS user_created_at,
         p.p_name AS product_name, p.p_retailprice AS product_price, k.p_type AS category_name,
         s.s_name AS store_name, e."date", e."hour"
  FROM ev e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN part p ON e.product_id = p.p_partkey
  LEFT JOIN cat k ON p.p_type = k.p_type
  LEFT JOIN supplier s ON p.p_partkey % (SELECT count(*) FROM supplier) = s.s_suppkey)"""


def _text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


_SILVER_COLUMNS = (
    "event_id, " + _text("occurred_at") + ", event_type, platform, user_id, username, full_name, product_id, email, "
    + _text("user_created_at") + ', product_name, product_price, category_name, store_name, "date", "hour"')
_BRONZE_COLUMNS = ('event_id, user_id, product_id, event_type, platform, '
                   'CAST(epoch(occurred_at) AS BIGINT) AS occurred_at, "date", "hour"')
_HOT_COLUMNS = ("event_id, user_id, product_id, event_type, platform, " + _text("occurred_at") + ', "date", "hour"')


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _keys(grain: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{k}"' for k in grain)


def _profile(grain: tuple[str, ...]) -> str:
    g = _keys(grain)
    same = " AND ".join(f't."{k}" = d."{k}"' for k in grain)
    return _with(_SILVER, f"""
, devices AS (
  SELECT {g}, user_id, platform,
         row_number() OVER (PARTITION BY {g}, user_id ORDER BY count(*) DESC, platform) AS rn
  FROM silver GROUP BY {g}, user_id, platform),
totals AS (
  SELECT {g}, user_id, min(full_name) AS fullname, min(email) AS email, min(user_created_at) AS created_at,
         strftime(max(occurred_at), '%Y-%m-%d') AS last_active_date,
         CAST(count(*) FILTER (WHERE event_type = 'PURCHASE') AS BIGINT) AS total_transactions
  FROM silver GROUP BY {g}, user_id)
SELECT t.user_id AS customer_id, t.fullname, t.email, {_text('t.created_at', 'created_at')}, t.last_active_date,
       t.total_transactions, d.platform AS primary_device, {_keys(grain, 't.')}
FROM totals t JOIN devices d ON t.user_id = d.user_id AND {same} AND d.rn = 1""")


def _funnel(grain: tuple[str, ...]) -> str:
    g = _keys(grain)
    return _with(_EVENTS, f"""
, steps AS (
  SELECT {g}, platform,
    count(DISTINCT CASE WHEN event_type = 'SEARCH' THEN user_id END) AS step_1_visit,
    count(DISTINCT CASE WHEN event_type = 'VIEW_PRODUCT' THEN user_id END) AS step_2_view_product,
    count(DISTINCT CASE WHEN event_type = 'ADD_TO_CART' THEN user_id END) AS step_3_initiate_checkout,
    count(DISTINCT CASE WHEN event_type = 'PURCHASE' THEN user_id END) AS step_4_purchase_success
  FROM ev GROUP BY {g}, platform)
SELECT "date" AS log_date, platform AS device_type, step_1_visit, step_2_view_product, step_3_initiate_checkout,
  step_4_purchase_success,
  CASE WHEN step_1_visit > 0 THEN round(CAST(step_4_purchase_success / step_1_visit AS DECIMAL(18, 12)), 4)
       ELSE 0 END::DOUBLE AS conversion_rate_overall, {g}
FROM steps""")


def _rfm(grain: tuple[str, ...]) -> str:
    g = _keys(grain)
    group = f"{g}, user_id" if grain else "user_id"
    part = f"PARTITION BY {g}" if grain else ""
    if "hour" in grain:
        anchor = """CAST("date" || ' ' || "hour" || ':59:59' AS TIMESTAMP)"""
    elif grain:
        anchor = """CAST("date" || ' 23:59:59' AS TIMESTAMP)"""
    else:
        anchor = """(SELECT CAST(max("date") || ' 23:59:59' AS TIMESTAMP) FROM ev)"""
    tail = f", {g}" if grain else ""
    prefix = "Hourly " if "hour" in grain else ""
    return _with(_SILVER, f"""
, facts AS (
  SELECT {group}, max(CASE WHEN event_type = 'PURCHASE' THEN occurred_at END) AS last_purchase,
         count(*) FILTER (WHERE event_type = 'PURCHASE') AS frequency_value,
         round(sum(CASE WHEN event_type = 'PURCHASE' THEN product_price ELSE 0.0 END), 2) AS monetary_value
  FROM silver GROUP BY {group}),
metrics AS (
  SELECT *, coalesce(CAST(floor((epoch({anchor}) - epoch(last_purchase)) / 60) AS BIGINT), 9999) AS recency_value
  FROM facts),
scores AS (
  SELECT *, ntile(5) OVER ({part} ORDER BY frequency_value > 0, recency_value DESC, user_id) AS r,
         ntile(5) OVER ({part} ORDER BY frequency_value, user_id) AS f,
         ntile(5) OVER ({part} ORDER BY monetary_value NULLS FIRST, user_id) AS m
  FROM metrics)
SELECT user_id AS customer_id, recency_value, CAST(frequency_value AS BIGINT) AS frequency_value, monetary_value,
  r AS r_score, f AS f_score, m AS m_score, CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_cell,
  CASE WHEN r IN (4, 5) AND f IN (4, 5) THEN '{prefix}Champions'
       WHEN r IN (3, 4, 5) AND f IN (3, 4, 5) THEN '{prefix}Active Users'
       WHEN r IN (4, 5) AND f = 1 THEN '{prefix}New Buyers'
       ELSE '{prefix}Low Active' END AS segment_name{tail}
FROM scores""")


_SESSIONS = _EVENTS + """,
flagged AS (
  SELECT *, CASE WHEN lag(occurred_at) OVER u IS NULL
                   OR epoch(occurred_at) - epoch(lag(occurred_at) OVER u) > 1800 THEN 1 ELSE 0 END AS starts
  FROM ev WINDOW u AS (PARTITION BY "date", user_id ORDER BY occurred_at)),
sessions AS (
  SELECT *, CAST(user_id AS VARCHAR) || '_' || CAST(CAST(sum(starts) OVER (
              PARTITION BY "date", user_id ORDER BY occurred_at) AS BIGINT) AS VARCHAR) AS session_id
  FROM flagged)"""

_SPANS = _with(_SESSIONS, f"""
SELECT "date", user_id, {_text('min(occurred_at)', 'session_start')}, {_text('max(occurred_at)', 'session_end')},
       count(event_id) AS events
FROM sessions GROUP BY "date", user_id, session_id""")


def _performance(extra: str = "") -> str:
    return _with(_SESSIONS, """
, rows_ AS (
  SELECT "date", session_id, platform, any_value(user_id) AS user_id, count(event_id) AS n
  FROM sessions GROUP BY "date", session_id, platform),
days AS (
  SELECT "date", platform, count(session_id) AS total_sessions, count(DISTINCT user_id) AS total_users,
         CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS bounce_sessions, avg(n) AS mean_events
  FROM rows_ GROUP BY "date", platform)
""" + (extra or """
SELECT "date" AS log_date, total_sessions, total_users, bounce_sessions,
       CASE WHEN total_sessions > 0 THEN round(CAST(bounce_sessions / total_sessions AS DECIMAL(18, 12)), 4)
            ELSE 0 END::DOUBLE AS bounce_rate,
       round(CAST(mean_events AS DECIMAL(18, 12)), 2)::DOUBLE AS avg_events_per_session, platform AS operating_system, "date"
FROM days"""))


def _sales(where: str = "", tail: str = "") -> str:
    return _with(_EVENTS, f"""
SELECT p.p_name AS name, round(sum(p.p_retailprice), 2) AS total_revenue, count(e.event_id) AS total_orders
FROM ev e JOIN part p ON e.product_id = p.p_partkey {where} GROUP BY p.p_name {tail}""")


_SILVER_AS_OF = _with(_EVENTS, f"""
, cat AS (SELECT p_type, min(p_partkey) AS category_id FROM part GROUP BY p_type),
silver AS (
  SELECT e.event_id, e.occurred_at, e.event_type, e.platform, e.user_id, lower(c.c_name) AS username,
         CASE WHEN e."date" >= '2024-01-11' AND e."date" < '2024-01-21' THEN upper(c.c_name) ELSE c.c_name END AS full_name,
         e.product_id, lower(c.c_name) || '@example.com' AS email,
         TIMESTAMP '2020-01-01' + to_days(CAST(c.c_custkey AS INTEGER)) AS user_created_at,
         p.p_name AS product_name,
         CASE WHEN e."date" >= '2024-01-16' AND p.p_partkey % 2 = 0 THEN p.p_retailprice * 2 ELSE p.p_retailprice END AS product_price,
         CASE WHEN e."date" >= '2024-01-21' THEN lower(k.p_type) ELSE k.p_type END AS category_name,
         s.s_name AS store_name, e."date", e."hour"
  FROM ev e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
    AND (c.c_mktsegment <> 'MACHINERY' OR e."date" < '2024-01-11' OR e."date" >= '2024-01-21')
  LEFT JOIN part p ON e.product_id = p.p_partkey
  LEFT JOIN cat k ON p.p_type = k.p_type
  LEFT JOIN supplier s ON p.p_partkey % (SELECT count(*) FROM supplier) = s.s_suppkey)
SELECT {_SILVER_COLUMNS} FROM silver""")
_SILVER_ALL = _with(_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver")
_EVENTS_ALL = _with(_EVENTS, f"SELECT {_HOT_COLUMNS} FROM ev")
_HOUR_COUNTS = 'SELECT "date", "hour", count(*) AS events FROM ev GROUP BY "date", "hour"'

ORACLES = {
    "bronze_export_projection": _with(_EVENTS, f"SELECT {_BRONZE_COLUMNS} FROM ev"),
    "hot_interval_archive": _with(_EVENTS, f"""SELECT {_HOT_COLUMNS} FROM ev
        WHERE occurred_at >= TIMESTAMP '2024-01-10 06:00:00' AND occurred_at < TIMESTAMP '2024-01-20 18:00:00'"""),
    "hot_interval_retained": _with(_EVENTS, f"""SELECT {_HOT_COLUMNS} FROM ev
        WHERE occurred_at < TIMESTAMP '2024-01-10 06:00:00' OR occurred_at >= TIMESTAMP '2024-01-20 18:00:00'"""),
    "silver_enriched_events": _SILVER_ALL,
    "silver_enriched_shuffled": _SILVER_ALL,
    "silver_asof_intervals": _SILVER_AS_OF,
    "silver_asof_shuffled": _SILVER_AS_OF,
    "users_from_buckets": _with(_SILVER, f"""
        SELECT event_id, user_id, username, full_name, email, {_text("user_created_at")} FROM silver"""),
    "silver_partition_slice": _with(_SILVER, f"""SELECT {_SILVER_COLUMNS} FROM silver WHERE "date" = '2024-01-12'"""),
    "latest_dimension_snapshot": """
        WITH snaps AS (
          SELECT c_custkey AS user_id, c_name AS full_name, '2024-01-01' AS "date" FROM customer
          UNION ALL
          SELECT c_custkey, upper(c_name), '2024-01-15' FROM customer WHERE c_mktsegment <> 'MACHINERY'
          UNION ALL
          SELECT c_custkey, lower(c_name), '2024-02-01' FROM customer)
        SELECT user_id, full_name, "date" FROM snaps
        WHERE "date" = (SELECT max("date") FROM snaps WHERE "date" <= '2024-01-30')""",
    "customer_profile": _profile(("date", "hour")),
    "customer_profile_daily": _profile(("date",)),
    "funnel_hourly": _funnel(("date", "hour")),
    "funnel_daily": _funnel(("date",)),
    "rfm_hourly": _rfm(("date", "hour")),
    "rfm_daily": _rfm(("date",)),
    "rfm_daily_distributed": _rfm(("date",)),
    "rfm_global": _rfm(()),
    "session_assignment": _with(_SESSIONS, "SELECT event_id, session_id FROM sessions"),
    "session_assignment_shuffled": _with(_SESSIONS, "SELECT event_id, session_id FROM sessions"),
    "session_summary": _SPANS,
    "session_performance_daily": _performance(),
    "session_users_approx_ok": _performance('SELECT "date", platform AS operating_system, TRUE AS close FROM days'),
    "session_performance_from_hours": _performance(),
    "funnel_daily_from_hours": _funnel(("date",)),
    "users_from_sketches_ok": _performance('SELECT "date", platform AS operating_system, TRUE AS close FROM days'),
    "product_sales": _sales(),
    "product_sales_purchases": _sales("WHERE e.event_type = 'PURCHASE'"),
    "product_sales_topk": _sales(tail="ORDER BY total_revenue DESC, name LIMIT 10"),
    "hot_cold_union": _EVENTS_ALL,
    "dedup_events": _EVENTS_ALL,
    "event_json_roundtrip": _EVENTS_ALL,
    "quarantine_bad_json": """
        SELECT CASE event_type WHEN 'error' THEN 'malformed json' WHEN 'click' THEN 'bad time'
                               WHEN 'view' THEN 'malformed json' WHEN 'signup' THEN 'missing field'
                               ELSE 'good' END AS outcome,
               CAST(event_id AS VARCHAR) AS event_id FROM events""",
    "category_slug": """
        SELECT p_type AS name, replace(lower(p_brand || ' ' || p_type), ' ', '-') AS slug, count(*) AS parts
        FROM part GROUP BY ALL""",
    "month_bucket_counts": """
        SELECT strftime(ts, '%Y%m') AS month, event_type, count(*) AS events FROM events GROUP BY ALL""",
    "dimension_probe": """
        SELECT 'users' AS dimension, (SELECT count(*) FROM customer) > 0 AS loaded
        UNION ALL SELECT 'nobody', FALSE
        UNION ALL SELECT 'products', (SELECT count(*) FROM part) > 0
        UNION ALL SELECT 'categories', (SELECT count(*) FROM part) > 0
        UNION ALL SELECT 'stores', (SELECT count(*) FROM supplier) > 0""",
    "stream_silver": _SILVER_AS_OF,
    "stream_sessions": _SPANS,
    "stream_ingest_dedup": _EVENTS_ALL,
    "stream_restart": _with(_EVENTS, """
        SELECT "date", "hour", count(*) AS events, count(DISTINCT event_id) AS ids, 1 AS batches FROM ev GROUP BY "date", "hour\""""),
    "stream_distinct_events": _EVENTS_ALL,
    "stream_funnel": _funnel(("date", "hour")),
    "stream_funnel_approx": f"""
        SELECT log_date, "hour", device_type, TRUE AS close FROM ({_funnel(("date", "hour"))})""",
    "late_hours_recomputed": _with(_EVENTS, f"""
        SELECT 'silver' AS part, "date", "hour", count(*) AS n FROM ev GROUP BY "date", "hour"
        UNION ALL
        SELECT 'buyers', "date", "hour", count(DISTINCT CASE WHEN event_type = 'PURCHASE' THEN platform || user_id END)
        FROM ev GROUP BY "date", "hour"
        UNION ALL
        SELECT 'sessions', "date", '', CAST(sum(total_sessions) AS BIGINT) FROM ({_performance()}) GROUP BY "date\""""),
    "partition_replace_roundtrip": _with(_EVENTS, f"""
        SELECT {_BRONZE_COLUMNS} FROM ev WHERE "date" <> '2024-01-20' OR "hour" <> '10'"""),
    "point_reads": _with(_EVENTS, f"""
        , ends AS (SELECT min(event_id) AS low, max(event_id) AS high FROM ev GROUP BY event_type)
        SELECT {_BRONZE_COLUMNS} FROM ev
        WHERE event_id IN (SELECT low FROM ends) OR event_id IN (SELECT high FROM ends)"""),
    "published_versions": _funnel(("date", "hour")),
    "catalog_reload": """
        SELECT c_custkey AS user_id, lower(c_name) AS username, FALSE AS gone_exists, 'empty' AS empty_snapshot FROM customer""",
    "uuid_roundtrip": """
        SELECT event_id, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-8' || substr(d, 14, 3) || '-'
               || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(d, 18, 3) || '-'
               || substr(d, 21) AS uuid
        FROM (SELECT event_id, md5('+' || event_id) AS d FROM events)""",
    "gold_overwrite_roundtrip": _funnel(("date", "hour")),
    "hour_archive_roundtrip": _with(_EVENTS, _HOUR_COUNTS),
    "catalog_sync_roundtrip": _with(_EVENTS, f"""
        SELECT * FROM ({_HOUR_COUNTS}) WHERE NOT ("date" = '2024-01-05' AND "hour" = '07')"""),
    "snapshot_if_absent": """
        SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price, '2024-01-30' AS "date" FROM part""",
    "gold_backfill": " UNION ALL ".join(
        f"""SELECT '{mart}' AS mart, "date", count(*) AS out_rows, CAST(sum({value}) AS BIGINT) AS total
            FROM ({rows}) GROUP BY "date\""""
        for mart, value, rows in (
            ("silver", "user_id + 3 * product_id", _with(_EVENTS, "SELECT * FROM ev")),
            ("customer_profile", "total_transactions * (customer_id % 97 + 1)", _profile(("date", "hour"))),
            ("funnel_conversion", "step_1_visit + 2 * step_2_view_product + 3 * step_3_initiate_checkout "
             "+ 5 * step_4_purchase_success", _funnel(("date", "hour"))),
            ("rfm_segments", "(r_score + 7 * f_score + 49 * m_score) * (customer_id % 97 + 1)", _rfm(("date", "hour"))),
            ("session_performance", "total_sessions + 2 * total_users + 3 * bounce_sessions", _performance()))),
}
