"""The result of each query as DuckDB SQL over the same tables."""

from __future__ import annotations

from aislewise.schema import RAW as RAW_SCHEMA
from aislewise.sources import synthetic

RAW_NAMES = RAW_SCHEMA.names

# FIXTURES.md section 2.
RAW = """
raw AS (
  SELECT event_id,
         ts AS event_time,
         CASE event_type WHEN 'click' THEN 'cart'
                         WHEN 'signup' THEN 'remove_from_cart'
                         ELSE event_type END AS event_type,
         CASE WHEN event_id % 103 = 0 THEN NULL ELSE k END AS product_id,
         2000000000000000000 + k AS category_id,
         CASE WHEN k % 10 = 0 THEN NULL ELSE lower(p_type) || '.' || p_name END AS category_code,
         CASE WHEN k % 7 = 0 THEN NULL ELSE p_brand END AS brand,
         CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN event_id % 97 = 0 THEN -value
              ELSE value END AS price,
         user_id,
         CASE WHEN event_id % 101 = 0 THEN '  '
              WHEN event_id % 107 = 0 THEN NULL
              ELSE user_id || '-' || strftime(ts, '%Y%m%d') END AS user_session
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) AS e
  JOIN part ON p_partkey = k
)
"""
COLUMNS = (
    "event_time, event_type, product_id, category_id, category_code, "
    "brand, price, user_id, user_session"
)
KNOWN = "event_type IN ('view', 'cart', 'purchase', 'remove_from_cart')"
IS_CLEAN = (
    "(user_id IS NOT NULL AND product_id IS NOT NULL AND price IS NOT NULL AND event_time IS NOT NULL "
    f"AND {KNOWN} AND price >= 0 AND trim(user_session) <> '')"
)
CLEAN = f"""
clean AS (
  SELECT {COLUMNS}, coalesce(split_part(category_code, '.', 1), 'unknown') AS top_category
  FROM raw
  WHERE {IS_CLEAN}
)
"""
# Without the first of so many files.
CLEAN_PART = CLEAN.replace("WHERE", "WHERE event_id % {} > 0 AND", 1)
REVENUE = """
revenue AS (
  SELECT top_category, round(sum(price), 2) AS total_revenue, count(*) AS num_purchases,
         round(avg(price), 4) AS avg_price
  FROM clean WHERE event_type = 'purchase' GROUP BY top_category
)
"""
BRANDS = """
brands AS (
  SELECT brand, round(sum(price), 2) AS total_revenue, count(*) AS num_purchases
  FROM clean WHERE event_type = 'purchase' AND brand IS NOT NULL GROUP BY brand
  ORDER BY total_revenue DESC, brand LIMIT 20
)
"""
FUNNEL = """
funnel AS (
  SELECT *, round(cart / nullif("view", 0), 6) AS cart_rate,
         round(purchase / nullif("view", 0), 6) AS purchase_rate
  FROM (
    SELECT top_category,
           count(*) FILTER (WHERE event_type = 'view') AS "view",
           count(*) FILTER (WHERE event_type = 'cart') AS cart,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
           count(*) FILTER (WHERE event_type = 'remove_from_cart') AS remove_from_cart
    FROM clean GROUP BY top_category
  ) AS counted
)
"""
HOURLY = """
hourly AS (
  SELECT CAST(hour(event_time) AS BIGINT) AS hour, event_type, count(*) AS count
  FROM clean GROUP BY ALL
)
"""
PRODUCTS = """
products AS (
  SELECT top_category, product_id, round(sum(price), 2) AS total_revenue,
         count(*) AS num_purchases
  FROM clean WHERE event_type = 'purchase' GROUP BY ALL
)
"""
SESSIONS = """
sessions AS (
  SELECT *, (epoch_us(session_end) - epoch_us(session_start)) / 60000000.0
              AS session_duration_min
  FROM (
    SELECT user_session, min(event_time) AS session_start, max(event_time) AS session_end,
           count(*) AS num_events, round(sum(price), 2) AS total_spend
    FROM clean GROUP BY user_session
  ) AS grouped
)
"""
NULL_COLUMNS = COLUMNS.split(", ")
NULLS = ",\n".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in NULL_COLUMNS)
NULL_ROWS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM raw"
    for c in NULL_COLUMNS
)
LINES = """
lines AS (
  SELECT event_id, event_type,
         concat_ws(',', strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC', event_type,
                   CASE WHEN event_id % 17 = 0 THEN 'x'
                        ELSE coalesce(CAST(product_id AS VARCHAR), '') END,
                   category_id, coalesce(category_code, ''), coalesce(brand, '')) AS head,
         concat_ws(',', coalesce(printf('%.2f', price), ''), user_id,
                   coalesce(user_session, '')) AS tail
  FROM raw
)
"""
DAMAGED = """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN head || ',' || tail || ',more'
                      WHEN event_id % 13 = 0 THEN head
                      ELSE head || ',' || tail END AS line
FROM lines
"""
REJECTED = "(event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0)"
VALIDATED_SCHEMA = (
    "struct<event_time:timestamp_ntz,product_id:bigint,category_id:bigint,category_code:string,"
    "brand:string,price:double,user_id:bigint,user_session:string,event_type:string>"
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _rank(order: str) -> str:
    return f"""
    {_with(RAW, CLEAN, PRODUCTS)}
    SELECT *, rank() OVER (PARTITION BY top_category ORDER BY {order} DESC) AS rank
    FROM products
    """


def _draw(name: str, seed: str = "state") -> str:
    product = f"({seed} * {synthetic.MULTIPLIERS[name]} % {synthetic.MODULUS})"
    return f"xor({product}, {product} >> {synthetic.FOLD_BITS})"


def _between(name: str, bounds: tuple[int, int]) -> str:
    return f"{_draw(name)} % {bounds[1] - bounds[0] + 1} + {bounds[0]}"


def _one_of(name: str, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"[{listed}][{_draw(name)} % {len(words)} + 1]"


def _generated() -> str:
    m, shift = synthetic.MODULUS, synthetic.WRAP_SHIFT

    def seed(number: str) -> str:
        return f"({number} % {m} + {number} // {m} * {shift} + 1) % {m}"

    return f"""
    WITH seeded AS (
      SELECT {seed('event_id')} AS seed, event_id // 5 AS session,
             {seed('(event_id // 5)')} AS session_seed
      FROM events
    ), mixed AS (
      SELECT session, {_draw('seed', 'seed')} AS state,
             {_draw('seed', 'session_seed')} AS session_state
      FROM seeded
    )
    SELECT TIMESTAMP '{synthetic.START}'
             + to_seconds({_draw('event_time')} % {synthetic.DAYS * 86_400}) AS event_time,
           {_one_of('event_type', synthetic.TYPES)} AS event_type,
           {_between('product_id', synthetic.PRODUCT_IDS)} AS product_id,
           {synthetic.FIRST_CATEGORY_ID} + {_draw('category_high')} * {synthetic.CATEGORY_STEP}
             + {_draw('category_low')} % {synthetic.CATEGORY_STEP} AS category_id,
           {_one_of('category_code', synthetic.CATEGORIES)} AS category_code,
           {_one_of('brand', synthetic.BRANDS)} AS brand,
           ({_between('price', synthetic.PRICE_CENTS)}) / 100.0 AS price,
           {_between('user_id', synthetic.USER_IDS)} AS user_id,
           session || '-' || {_draw('user_session', 'session_state')} AS user_session
    FROM mixed
    """


BROKEN_BRAND = """
CASE WHEN event_id % 3 = 0
     THEN coalesce(brand, 'no') || chr(10) || '"or"' || chr(10) || chr(10) || 'none'
     ELSE brand END AS brand
"""
SQL: dict[str, str] = {
    "csv_scan": f"{_with(RAW)} SELECT {COLUMNS} FROM raw",
    "csv_rejects": f"""
    {_with(RAW, LINES)}
    SELECT line FROM ({DAMAGED}) WHERE {REJECTED}
    """,
    "csv_accepted": f"""
    {_with(RAW, LINES)}
    SELECT event_type, count(*) AS count FROM lines WHERE NOT {REJECTED} GROUP BY event_type
    """,
    "validated_scan": f"{_with(RAW, CLEAN)} SELECT {COLUMNS} FROM clean",
    "generate_events": _generated(),
    "schema_report": f"""
    {_with(RAW)}
    SELECT false AS valid, 'brand' AS missing, 'loaded_by' AS extra, '' AS mistyped,
           count(*) AS total_rows
    FROM raw
    """,
    "input_verify": f"""
    {_with(RAW, CLEAN)}
    SELECT count(*) AS total_rows, '{VALIDATED_SCHEMA}' AS schema_text,
           true AS has_partition_column, count(*) > 0 AS has_rows
    FROM clean
    """,
    "dq_report": f"""
    {_with(RAW)}
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE NOT coalesce({KNOWN}, false)) AS invalid_events,
           count(*) FILTER (WHERE price < 0) AS negative_prices,
           {NULLS}
    FROM raw
    """,
    "dq_null_counts": f"{_with(RAW)} {NULL_ROWS}",
    "clean_events": f"{_with(RAW, CLEAN)} SELECT {COLUMNS} FROM clean",
    "validated_write": f"""
    {_with(RAW, CLEAN)}
    SELECT event_type, count(*) AS count FROM clean GROUP BY event_type
    """,
    "packed_layout": f"""
    {_with(RAW, CLEAN)}
    SELECT event_type, count(*) AS count, round(sum(price), 2) AS price_sum, true AS within_bound
    FROM clean GROUP BY event_type
    """,
    "follow_values": f"""
    {_with(RAW, CLEAN_PART.format(3), REVENUE, SESSIONS)}
    SELECT 'revenue' AS table_name, top_category AS key, total_revenue AS value FROM revenue
    UNION ALL SELECT 'sessions', 'all', count(*)::DOUBLE FROM sessions
    """,
    "result_roundtrip": f"""
    {_with(RAW, CLEAN, REVENUE)}
    SELECT * FROM revenue
    """,
    "result_preview": f"""
    {_with(RAW, CLEAN, REVENUE)}
    SELECT * FROM revenue ORDER BY total_revenue DESC, top_category LIMIT 5
    """,
    "ingest_idempotent": f"""
    {_with(RAW, CLEAN)}, sizes AS (
      SELECT (SELECT count(*) FROM raw) AS lines_read,
             (SELECT count(*) FROM clean) AS rows_written
    )
    SELECT run, skipped,
           CASE WHEN NOT skipped THEN lines_read END AS lines_read,
           CASE WHEN NOT skipped THEN CAST(0 AS BIGINT) END AS lines_rejected,
           CASE WHEN NOT skipped THEN rows_written END AS rows_written
    FROM sizes, (VALUES ('first', false), ('again', true), ('changed', false)) AS r(run, skipped)
    """,
    "csv_headers_by_file": f"""
    {_with(RAW)}
    SELECT {COLUMNS.replace("brand", "CASE WHEN event_id % 3 < 2 THEN brand END AS brand")},
           CASE WHEN event_id % 3 = 2 THEN 'batch' END AS loaded_by
    FROM raw
    """,
    "csv_quoted_breaks": f"""
    {_with(RAW)}
    SELECT {COLUMNS.replace("brand", BROKEN_BRAND)} FROM raw
    """,
    "ingest_incremental": f"""
    {_with(RAW)}, file AS (
      SELECT event_id % 4 AS k, count(*) AS n, count(*) FILTER (WHERE {IS_CLEAN}) AS good,
             sum(price) FILTER (WHERE {IS_CLEAN}) AS paid
      FROM raw GROUP BY event_id % 4
    ), step(step, files_gone, from_new, from_all) AS (
      VALUES ('first', false, 0, 0), ('changed', true, 3, 1), ('again', false, 4, 1)
    )
    SELECT step, true AS files_as_listed, files_gone,
           coalesce(sum(n) FILTER (WHERE fresh), 0)::BIGINT AS lines_read,
           coalesce(sum(good) FILTER (WHERE fresh), 0)::BIGINT AS rows_written,
           0::BIGINT AS lines_rejected,
           sum(good) FILTER (WHERE stored)::BIGINT AS rows_stored,
           round(sum(paid) FILTER (WHERE stored), 2) AS price_sum
    FROM (SELECT *, k >= from_new AND k < from_all + 3 AS fresh,
                 k >= from_all AND k < from_all + 3 AS stored
          FROM step, file)
    GROUP BY step, files_gone
    """,
    "ingest_synced_events": f"""
    {_with(RAW)} SELECT {COLUMNS} FROM raw WHERE event_id % 4 > 0 AND {IS_CLEAN}
    """,
    "top_category": f"""
    {_with(RAW)}
    SELECT category_code, coalesce(split_part(category_code, '.', 1), 'unknown') AS top_category,
           count(*) AS count
    FROM raw GROUP BY ALL
    """,
    "revenue_by_category": f"{_with(RAW, CLEAN, REVENUE)} SELECT * FROM revenue",
    "product_rank": _rank("total_revenue"),
    "product_rank_top5": f"SELECT * FROM ({_rank('total_revenue')}) AS ranked WHERE rank <= 5",
    "product_rank_by_count": _rank("num_purchases"),
    "conversion_funnel": f"{_with(RAW, CLEAN, FUNNEL)} SELECT * FROM funnel",
    "hourly_activity": f"{_with(RAW, CLEAN, HOURLY)} SELECT * FROM hourly",
    "session_stats": f"{_with(RAW, CLEAN, SESSIONS)} SELECT * FROM sessions",
    "session_partials": f"""
    {_with(RAW, CLEAN)}
    SELECT user_session, event_type, min(event_time) AS session_start,
           max(event_time) AS session_end, count(*) AS num_events,
           round(sum(price), 2) AS total_spend
    FROM clean GROUP BY user_session, event_type
    """,
    "session_stats_merged": f"{_with(RAW, CLEAN, SESSIONS)} SELECT * FROM sessions",
    "top_brands": f"{_with(RAW, CLEAN, BRANDS)} SELECT * FROM brands",
    "revenue_top10": f"""
    {_with(RAW, CLEAN, REVENUE)}
    SELECT * FROM revenue ORDER BY total_revenue DESC, top_category LIMIT 10
    """,
    "brands_top10": f"""
    {_with(RAW, CLEAN, BRANDS)}
    SELECT * FROM brands ORDER BY total_revenue DESC, brand LIMIT 10
    """,
    "funnel_top_rate": f"""
    {_with(RAW, CLEAN, FUNNEL)}
    SELECT top_category, "view", cart, purchase, purchase_rate, cart_rate FROM funnel
    ORDER BY purchase / nullif("view", 0) DESC NULLS LAST, top_category LIMIT 5
    """,
    "funnel_long": f"""
    {_with(RAW, CLEAN, FUNNEL)}, best AS (
      SELECT * FROM funnel ORDER BY "view" DESC, top_category LIMIT 5
    )
    SELECT top_category, 'view' AS "Step", "view" AS "Count" FROM best
    UNION ALL SELECT top_category, 'cart', cart FROM best
    UNION ALL SELECT top_category, 'purchase', purchase FROM best
    """,
    "hourly_purchase_histogram": f"""
    {_with(RAW, CLEAN, HOURLY)}
    SELECT hour, count, repeat('#', CAST(count // 20 AS INTEGER)) AS bar
    FROM hourly WHERE event_type = 'purchase'
    """,
    "session_summary": f"""
    {_with(RAW, CLEAN, SESSIONS)}
    SELECT count(*) AS num_sessions, round(avg(num_events), 6) AS avg_events,
           round(median(session_duration_min), 6) AS median_duration_min,
           round(avg(total_spend), 4) AS avg_spend
    FROM sessions
    """,
    "session_summary_approx": f"""
    {_with(RAW, CLEAN, SESSIONS)}
    SELECT count(*) AS num_sessions, round(avg(num_events), 6) AS avg_events,
           round(avg(total_spend), 4) AS avg_spend, true AS median_within_bound
    FROM sessions
    """,
    "session_sample": f"""
    {_with(RAW, CLEAN, SESSIONS)}
    SELECT * FROM sessions ORDER BY md5(user_session), user_session LIMIT 200
    """,
    "end_to_end_row_counts": f"""
    {_with(RAW, CLEAN, REVENUE, FUNNEL, HOURLY, SESSIONS, BRANDS, PRODUCTS)}
    SELECT 'validated' AS table_name, count(*) AS row_count FROM clean
    UNION ALL SELECT 'revenue_by_category', count(*) FROM revenue
    UNION ALL SELECT 'conversion_funnel', count(*) FROM funnel
    UNION ALL SELECT 'hourly_activity', count(*) FROM hourly
    UNION ALL SELECT 'session_partials', count(*)
    FROM (SELECT DISTINCT user_session, event_type FROM clean) AS p
    UNION ALL SELECT 'session_stats', count(*) FROM sessions
    UNION ALL SELECT 'top_brands', count(*) FROM brands
    UNION ALL SELECT 'product_sales', count(*) FROM products
    UNION ALL SELECT 'product_rank', count(*) FROM products
    UNION ALL SELECT 'session_summary', 1
    UNION ALL SELECT 'session_sample', least(count(*), 500000) FROM sessions
    """,
    "end_to_end_values": f"""
    {_with(RAW, CLEAN, REVENUE, FUNNEL, BRANDS)}, found AS (
      SELECT 'revenue_by_category' AS table_name, top_category AS key,
             'total_revenue' AS measure, CAST(total_revenue AS DOUBLE) AS value FROM revenue
      UNION ALL SELECT 'revenue_by_category', top_category, 'num_purchases', num_purchases FROM revenue
      UNION ALL SELECT 'conversion_funnel', top_category, 'view', "view" FROM funnel
      UNION ALL SELECT 'conversion_funnel', top_category, 'cart', cart FROM funnel
      UNION ALL SELECT 'conversion_funnel', top_category, 'purchase', purchase FROM funnel
      UNION ALL SELECT 'top_brands', brand, 'total_revenue', total_revenue FROM brands
      UNION ALL SELECT 'session_stats', 'all', 'num_events', count(*) FROM clean
    )
    SELECT table_name, key, measure, round(value, 2) AS value FROM found
    """,
    "sample_head": f"""
    {_with(RAW)} SELECT {COLUMNS} FROM raw WHERE event_id % 4 IN (0, 1)
    """,
    "sample_inside_file": f"""
    {_with(RAW, LINES)}, placed AS (
      SELECT event_id, {len(",".join(RAW_NAMES)) + 1} + coalesce(sum(strlen(line) + 1) OVER (
               ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
      FROM ({DAMAGED})
    )
    SELECT event_type, count(*) AS count, sum(user_id)::BIGINT AS user_ids, max(user_id) AS max_user
    FROM placed JOIN raw USING (event_id)
    WHERE begins <= 2 * {1 << 14} AND NOT {REJECTED} GROUP BY event_type
    """,
    "input_discovery": f"""
    {_with(RAW)} SELECT CAST(event_id % 2 AS INTEGER) AS folder, true AS as_listed, count(*) AS row_count
    FROM raw GROUP BY event_id % 2
    """,
}
# The job stores the very lines that the scan rejects.
SQL["job_rejects"] = SQL["csv_rejects"]
SQL["ingest_synced_rejects"] = SQL["csv_rejects"]
# What the ingest counts is the report, and what batches leave in the rollup are the statistics.
SQL["job_quality"] = SQL["dq_report"]
SQL["session_rollup"] = SQL["session_stats"]
SQL["session_rollup_follows"] = f"""
{_with(RAW, CLEAN_PART.format(4), SESSIONS)} SELECT * FROM sessions
"""
SQL["session_rollup_buckets"] = """
SELECT true AS others_keep_files, true AS has_untouched, true AS has_rewritten, true AS all_buckets
"""
SQL["session_rollup_summary"] = SQL["session_summary_approx"].replace(
    "count(*) AS num_sessions", "true AS counts_sessions"
)
