"""The same results in SQL for DuckDB, written without regard to the Spark plans."""

from __future__ import annotations

# The categories, in the order the product number selects them.
CATEGORIES = (
    "smartphones",
    "laptops",
    "tablets",
    "headphones",
    "smartwatches",
    "cameras",
    "gaming",
    "accessories",
)
CATEGORY_LIST = "[" + ", ".join(f"'{name}'" for name in CATEGORIES) + "]"

EVENTS = f"""
ev AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'product_' || CAST(k AS VARCHAR) AS product_id,
         {CATEGORY_LIST}[CAST(k % 8 AS BIGINT) + 1] AS product_category,
         CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END
           AS event_type,
         ts AS event_timestamp,
         CAST(ts AS DATE) AS day
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k
        FROM events)
)"""

ACTIVITY = """
activity AS (
  SELECT day, user_id, count(*) AS n, count(event_type) AS typed,
         count(*) FILTER (WHERE event_type = 'purchase') AS bought,
         min(event_timestamp) AS first_seen
  FROM ev GROUP BY day, user_id
),
segments AS (
  SELECT day, user_id, first_seen,
         CASE WHEN bought > 0 THEN 'buyer' ELSE 'window_shopper' END AS segment
  FROM activity WHERE user_id <> '' AND typed > 0
)"""

FIGURES = """
figures AS (
  SELECT a.day, a.total_events, s.buyer_count, s.window_shopper_count,
         CAST(format('{:.2f}', s.buyer_count
           / (s.buyer_count + s.window_shopper_count) * 100) AS DOUBLE) AS buyer_rate
  FROM (SELECT day, count(*) AS total_events FROM ev GROUP BY day) a
  JOIN (SELECT day, count(*) FILTER (WHERE segment = 'buyer') AS buyer_count,
               count(*) FILTER (WHERE segment <> 'buyer') AS window_shopper_count
        FROM segments GROUP BY day) s USING (day)
)"""


def views(name: str = "views_by_product", source: str = "ev") -> str:
    return f"""
{name} AS (
  SELECT day, product_id, count(*) AS view_count, min(event_timestamp) AS first_seen,
         row_number() OVER (PARTITION BY day ORDER BY count(*) DESC,
           min(event_timestamp), product_id) AS rank
  FROM {source} WHERE event_type = 'view' AND product_id <> ''
  GROUP BY day, product_id
)"""


def conversion(name: str = "conversion", source: str = "ev") -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN views > 0
              THEN CAST(format('{{:.2f}}', purchases / views * 100) AS DOUBLE)
              ELSE 0.0 END AS conversion_rate
  FROM (SELECT day, product_category AS category,
               count(*) FILTER (WHERE event_type = 'view') AS views,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
               min(event_timestamp) AS first_seen
        FROM {source} WHERE event_type IN ('view', 'purchase')
        GROUP BY day, product_category)
)"""


EARLY = """
early AS (SELECT * FROM ev WHERE event_timestamp < TIMESTAMP '2024-01-20 12:00:00')"""
FIRST_LOAD = "'2024-01-20 12:00:00.000000'"
SECOND_LOAD = "'2024-01-31 02:00:00.000000'"

DAY = "strftime(day, '%Y-%m-%d') AS report_date"


def text_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def with_(*parts: str) -> str:
    return "WITH " + ",".join((EVENTS, *parts)) + "\n"


def windowed(length: int, slide: int, keys: str = "product_id") -> str:
    """Windows of ``length`` seconds every ``slide``; events in each of them."""
    keys = f", {keys}" if keys else ""
    return f"""
windowed AS (
  SELECT make_timestamp(start * 1000000) AS window_start,
         make_timestamp((start + {length}) * 1000000) AS window_end{keys},
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT)
           AS purchases,
         count(*) AS total_events
  FROM (SELECT *, (epoch_us(event_timestamp) // 1000000 // {slide}) * {slide}
                    - unnest(range(0, {length}, {slide})) AS start
        FROM ev)
  GROUP BY start{keys}
)"""


WINDOW_COLUMNS = f"""{text_time('window_start')} AS window_start,
  {text_time('window_end')} AS window_end"""

# The JSON form of an event, with the offset the time text carries.
JSON = """'{"user_id":"' || user_id || '","product_id":"' || product_id
  || '","product_category":"' || product_category || '","event_type":"' || event_type
  || '","timestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f')
  || '+00:00"}'"""

LOGGED = f"""SELECT user_id, product_id, product_category, event_type,
  {text_time('event_timestamp')} AS event_timestamp,
  strftime(day, '%Y-%m-%d') AS event_date FROM ev"""

PART = "CAST(split_part(product_id, '_', 2) AS BIGINT) % 4"
UNDAMAGED = f" WHERE event_type <> 'error' AND NOT (event_type = 'signup' AND {PART} < 3)"

UNDATED = """
undated AS (
  SELECT * REPLACE (
    CASE WHEN day <> DATE '2024-01-03' THEN event_timestamp END AS event_timestamp,
    CASE WHEN day <> DATE '2024-01-03' THEN day END AS day)
  FROM ev
)"""

SEGMENT_CANDIDATES = """
candidates AS (
  SELECT day,
         CASE WHEN event_type = 'error' THEN repeat(user_id, 8) ELSE user_id END
           AS user_id,
         CASE event_type WHEN 'purchase' THEN 'buyer' WHEN 'view' THEN 'window_shopper'
           WHEN 'error' THEN repeat(user_id, 8) WHEN 'add_to_cart' THEN 'add_to_cart'
           END AS segment
  FROM ev
)"""


def _broken(rule: str, where: str, source: str, key: str) -> str:
    return (
        f"SELECT {DAY}, {key}, '{rule}' AS rule, count(*) AS rows FROM {source} "
        f"WHERE {where} GROUP BY day, {key}"
    )


def _repeated(source: str, key: str) -> str:
    return (
        f"SELECT {DAY}, {key}, 'key is not unique' AS rule, count(*) AS rows "
        f"FROM {source} GROUP BY day, {key} HAVING count(*) > 1"
    )


DOCUMENT_PARTS = f"""
ids AS (
  SELECT day, segment, string_agg(user_id, ',' ORDER BY position) AS listed,
         string_agg('"' || user_id || '"', ',' ORDER BY position) AS quoted
  FROM (SELECT *, row_number() OVER (PARTITION BY day, segment
                    ORDER BY first_seen, user_id) AS position FROM segments)
  WHERE position <= 10 GROUP BY day, segment
),
top AS (
  SELECT day,
    string_agg('{{"product_id":"' || product_id || '","views":' || view_count || '}}',
      ',' ORDER BY rank) AS as_json,
    string_agg(rank || '. ' || product_id || ' - ' || view_count || ' views',
      chr(10) ORDER BY rank) AS as_lines
  FROM views_by_product WHERE rank <= 5 GROUP BY day
),
rated AS (
  SELECT day,
    string_agg('"' || category || '":{{"views":' || views || ',"purchases":'
      || purchases || ',"conversion_rate":' || CAST(conversion_rate AS VARCHAR) || '}}',
      ',' ORDER BY conversion_rate DESC, first_seen, category) AS as_json,
    string_agg(printf('%-15s %10d %10d %9.2f%%', category, views, purchases,
      conversion_rate), chr(10) ORDER BY conversion_rate DESC, first_seen, category)
      AS as_lines
  FROM conversion GROUP BY day
),
documents_of_days AS (
  SELECT f.*, b.quoted AS buyer_ids, w.quoted AS shopper_ids,
         top.as_json AS top_json, top.as_lines AS top_lines,
         rated.as_json AS rated_json, rated.as_lines AS rated_lines
  FROM figures f
  LEFT JOIN ids b ON b.day = f.day AND b.segment = 'buyer'
  LEFT JOIN ids w ON w.day = f.day AND w.segment = 'window_shopper'
  LEFT JOIN top ON top.day = f.day
  LEFT JOIN rated ON rated.day = f.day
)"""

DOCUMENTS = with_(ACTIVITY, FIGURES, views(), conversion(), DOCUMENT_PARTS)

ORACLE: dict[str, str] = {
    "parse_events": with_()
    + """SELECT
  CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
  CASE WHEN event_type <> 'error' THEN product_id END AS product_id,
  CASE WHEN event_type <> 'error' THEN product_category END AS product_category,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error'
    THEN strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS timestamp
FROM ev""",
    "event_time": with_()
    + f"""SELECT user_id, product_id,
  CASE WHEN event_type <> 'error' THEN {text_time('event_timestamp')} END
    AS event_timestamp,
  CASE WHEN event_type <> 'error' THEN strftime(day, '%Y-%m-%d') END AS event_date
FROM ev""",
    "category_default": with_()
    + """SELECT CASE WHEN event_type IN ('signup', 'error') THEN 'unknown'
  ELSE product_category END AS category, count(*) AS events
FROM ev GROUP BY 1""",
    "product_category": f"""
WITH forms AS (
  SELECT CASE event_type WHEN 'click' THEN 'product_-' || k
           WHEN 'purchase' THEN 'product_' || k || '_x' WHEN 'signup' THEN 'p' || k
           WHEN 'error' THEN 'product_x' || k ELSE 'product_' || k END AS product_id,
         CASE WHEN event_type IN ('view', 'purchase') THEN k WHEN event_type = 'click'
           THEN -k END AS number
  FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k
        FROM events)
)
SELECT product_id, count(*) AS events,
  coalesce({CATEGORY_LIST}[CAST(((number % 8) + 8) % 8 AS BIGINT) + 1], 'accessories')
    AS category
FROM forms GROUP BY product_id, number""",
    "buyer_rate": with_(ACTIVITY, FIGURES)
    + f"""SELECT {DAY}, buyer_count AS buyers, window_shopper_count AS shoppers,
  buyer_rate FROM figures""",
    "event_messages": with_() + f"SELECT {JSON} AS value FROM ev",
    "user_action_sets": with_()
    + f"""SELECT {DAY}, user_id,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS actions
FROM ev GROUP BY day, user_id""",
    "user_segments": with_(ACTIVITY) + f"SELECT {DAY}, user_id, segment FROM segments",
    "buyers": with_()
    + f"SELECT DISTINCT {DAY}, user_id FROM ev WHERE event_type = 'purchase'",
    "window_shoppers": with_()
    + f"""SELECT DISTINCT {DAY}, user_id FROM ev e
WHERE NOT EXISTS (SELECT 1 FROM ev b WHERE b.day = e.day AND b.user_id = e.user_id
  AND b.event_type = 'purchase')""",
    "segment_rows": with_()
    + f"""SELECT DISTINCT {DAY}, user_id, 'buyer' AS segment FROM ev
WHERE event_type = 'purchase'
UNION ALL
SELECT DISTINCT {DAY}, user_id, 'window_shopper' AS segment FROM ev e
WHERE NOT EXISTS (SELECT 1 FROM ev b WHERE b.day = e.day AND b.user_id = e.user_id
  AND b.event_type = 'purchase')""",
    "segment_samples": with_(ACTIVITY, FIGURES, views(), conversion(), DOCUMENT_PARTS)
    + f"SELECT {DAY}, segment, listed AS user_ids FROM ids",
    "product_view_counts": with_(views())
    + f"""SELECT {DAY}, product_id, view_count,
  {text_time('first_seen')} AS first_seen FROM views_by_product""",
    "top_viewed_products": with_(views())
    + f"""SELECT {DAY}, product_id, view_count, rank FROM views_by_product
WHERE rank <= 5""",
    "top_viewed_products_undated": with_(UNDATED, views("undated_views", "undated"))
    + f"""SELECT {DAY}, product_id, view_count, rank FROM undated_views
WHERE rank <= 40""",
    "summary_undated": with_(UNDATED)
    + f"""SELECT {DAY}, total_events, buyers, users - buyers AS shoppers,
  least(buyers, 10) AS listed_buyers, least(users - buyers, 10) AS listed_shoppers,
  least(products, 5) AS listed_products, categories AS listed_categories
FROM (SELECT day, count(*) AS total_events, count(DISTINCT user_id) AS users,
        count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS buyers,
        count(DISTINCT product_id) FILTER (WHERE event_type = 'view') AS products,
        count(DISTINCT product_category)
          FILTER (WHERE event_type IN ('view', 'purchase')) AS categories
      FROM undated GROUP BY day)""",
    "product_rank": with_(views())
    + f"SELECT {DAY}, product_id, view_count, rank FROM views_by_product",
    "category_conversion": with_(conversion())
    + f"SELECT {DAY}, category, views, purchases, conversion_rate FROM conversion",
    "category_conversion_ranked": with_(conversion())
    + f"""SELECT {DAY}, category, views, purchases, conversion_rate,
  {text_time('first_seen')} AS first_seen FROM conversion
ORDER BY day, conversion_rate DESC, conversion.first_seen, category""",
    "event_type_distribution": with_()
    + """SELECT event_type, count(*) AS events, CAST(format('{:.1f}',
  count(*) / (SELECT count(*) FROM ev) * 100) AS DOUBLE) AS share_percent
FROM ev GROUP BY event_type""",
    "event_throughput": with_()
    + f"""SELECT {DAY}, {text_time('hour')} AS interval_start,
  CAST(sum(n) OVER so_far AS BIGINT) AS events,
  CAST(sum(v) OVER so_far AS BIGINT) AS views,
  CAST(sum(c) OVER so_far AS BIGINT) AS carts,
  CAST(sum(p) OVER so_far AS BIGINT) AS purchases,
  max(last_event) OVER so_far - min(first_event) OVER so_far AS elapsed_micros,
  CASE WHEN max(last_event) OVER so_far > min(first_event) OVER so_far
    THEN CAST(sum(n) OVER so_far AS DOUBLE) * 1000000.0
      / CAST(max(last_event) OVER so_far - min(first_event) OVER so_far AS DOUBLE)
    ELSE 0.0 END AS events_per_second
FROM (SELECT day, date_trunc('hour', event_timestamp) AS hour, count(*) AS n,
        count(*) FILTER (WHERE event_type = 'view') AS v,
        count(*) FILTER (WHERE event_type = 'add_to_cart') AS c,
        count(*) FILTER (WHERE event_type = 'purchase') AS p,
        epoch_us(min(event_timestamp)) AS first_event,
        epoch_us(max(event_timestamp)) AS last_event
      FROM ev GROUP BY 1, 2)
WINDOW so_far AS (PARTITION BY day ORDER BY hour
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "windowed_product_stats": with_(windowed(600, 300))
    + f"""SELECT {WINDOW_COLUMNS}, product_id, views, purchases, total_events
FROM windowed""",
    "windowed_product_stats_fine": with_(windowed(3600, 300))
    + f"""SELECT {WINDOW_COLUMNS}, product_id, views, purchases, total_events
FROM windowed""",
    "sliding_window_counts": with_(windowed(600, 300, ""))
    + f"SELECT {WINDOW_COLUMNS}, total_events FROM windowed",
    "flash_sale_alerts": with_(windowed(172800, 86400))
    + f"""SELECT {WINDOW_COLUMNS}, product_id, views, purchases FROM windowed
WHERE views > 2 AND purchases < 1""",
    "daily_summary": with_(ACTIVITY, FIGURES)
    + f"""SELECT {DAY}, total_events, buyer_count, window_shopper_count, buyer_rate
FROM figures""",
    "daily_summary_doc": DOCUMENTS
    + f"""SELECT {DAY},
  '{{"date":"' || strftime(day, '%Y-%m-%d') || '","total_events":' || total_events
  || ',"window_shoppers":{{"count":' || window_shopper_count || ',"user_ids":['
  || coalesce(shopper_ids, '') || ']}},"buyers":{{"count":' || buyer_count
  || ',"user_ids":[' || coalesce(buyer_ids, '') || ']}},"top_5_viewed_products":['
  || coalesce(top_json, '') || '],"conversion_rates_by_category":{{'
  || coalesce(rated_json, '') || '}},"generated_at":"2024-01-31T02:00:00.000000"}}'
  AS document
FROM documents_of_days""",
    "daily_report_text": DOCUMENTS
    + f"""SELECT {DAY}, concat_ws(chr(10),
  'Daily E-commerce Summary - ' || strftime(day, '%Y-%m-%d'), repeat('=', 60), '',
  'Total Events: ' || total_events, '', 'USER SEGMENTATION', repeat('-', 40),
  '- Buyers: ' || buyer_count, '- Window Shoppers: ' || window_shopper_count, '',
  'TOP 5 VIEWED PRODUCTS', repeat('-', 40), top_lines, '',
  'CONVERSION RATES BY PRODUCT CATEGORY', repeat('-', 40),
  printf('%-15s %10s %10s %10s', 'Category', 'Views', 'Purchases', 'Rate'),
  repeat('-', 45), rated_lines, '', repeat('=', 60),
  'Report generated at: 2024-01-31T02:00:00.000000') AS report
FROM documents_of_days""",
    "upsert_daily_summary": with_(ACTIVITY, FIGURES)
    + f"""SELECT {DAY}, total_events, buyer_count, window_shopper_count, buyer_rate,
  {SECOND_LOAD} AS generated_at FROM figures""",
    "upsert_category_conversion": with_(EARLY, conversion(), conversion("old", "early"))
    + f"""SELECT strftime(c.day, '%Y-%m-%d') AS report_date, c.category, c.views,
  c.purchases, c.conversion_rate,
  CASE WHEN o.day IS NULL THEN {SECOND_LOAD} ELSE {FIRST_LOAD} END AS created_at
FROM conversion c LEFT JOIN old o ON o.day = c.day AND o.category = c.category""",
    "upsert_user_segments": with_(EARLY, ACTIVITY)
    + f"""SELECT strftime(s.day, '%Y-%m-%d') AS report_date, s.user_id, s.segment,
  CASE WHEN o.day IS NULL THEN {SECOND_LOAD} ELSE {FIRST_LOAD} END AS created_at
FROM segments s LEFT JOIN (SELECT DISTINCT day, user_id FROM early) o
  ON o.day = s.day AND o.user_id = s.user_id""",
    "constraint_violations": with_(SEGMENT_CANDIDATES)
    + " UNION ALL ".join(
        [
            _broken("segment is missing", "segment IS NULL", "candidates", "user_id"),
            _broken(
                "user_id is longer than 50", "length(user_id) > 50", "candidates", "user_id"
            ),
            _broken(
                "segment is longer than 20", "length(segment) > 20", "candidates", "user_id"
            ),
            _broken(
                "segment is not allowed",
                "segment NOT IN ('buyer', 'window_shopper')",
                "candidates",
                "user_id",
            ),
            _repeated("candidates", "user_id"),
        ]
    ),
    "constraint_violations_rates": with_(conversion())
    + _broken(
        "conversion_rate is out of range",
        "views * purchases * 500 >= 1000",
        "conversion",
        "category",
    ),
    "summary_by_date": with_(ACTIVITY, FIGURES)
    + """SELECT strftime(day, '%Y-%m-%d') AS date, total_events, buyer_count AS buyers,
  window_shopper_count AS window_shoppers, buyer_rate,
  '2024-01-31 02:00:00' AS generated_at
FROM figures WHERE day = DATE '2024-01-15'""",
    "conversion_trends": with_(conversion())
    + """SELECT strftime(day, '%Y-%m-%d') AS date, category, conversion_rate
FROM conversion WHERE day >= DATE '2024-01-30' - INTERVAL 7 DAY
ORDER BY day DESC, conversion_rate DESC, category""",
    "daily_event_log": with_() + LOGGED,
    "jsonl_daily_scan": with_() + LOGGED + UNDAMAGED,
    "daily_files_scan": with_() + LOGGED + UNDAMAGED,
    "jsonl_malformed_lines": with_()
    + f"""SELECT strftime(day, '%Y-%m-%d') AS event_date,
  CASE WHEN event_type = 'error' THEN left({JSON}, 30)
    WHEN {PART} = 0 THEN {JSON} || {JSON} ELSE {JSON} || ' junk' END AS line
FROM ev WHERE event_type = 'error' OR event_type = 'signup' AND {PART} < 2""",
    "stream_event_log": with_() + LOGGED,
    # Appended are the windows the watermark, ten minutes behind the newest event
    # and counted in milliseconds, has passed.
    "stream_stats_history": with_(windowed(600, 300))
    + f"""SELECT {WINDOW_COLUMNS}, product_id, views, purchases, total_events
FROM windowed WHERE epoch_ms(window_end) <=
  (SELECT epoch_ms(max(event_timestamp)) - 600000 FROM ev)""",
}
ORACLE["stream_flash_sale_alerts"] = ORACLE["flash_sale_alerts"]
ORACLE["upsert_segments_by_key"] = ORACLE["upsert_user_segments"]
ORACLE["user_action_sets_of_bits"] = ORACLE["user_action_sets"]
ORACLE["daily_summary_pieces"] = ORACLE["daily_summary_doc"]
for _name, _test in (("events_of_buyers", "IN"), ("events_without_buyers", "NOT IN")):
    ORACLE[_name] = (
        with_()
        + f"""SELECT strftime(day, '%Y-%m-%d') AS event_date, event_type, count(*) AS events
FROM ev WHERE user_id {_test} (SELECT user_id FROM ev
  WHERE event_type = 'purchase' AND day = DATE '2024-01-03')
GROUP BY day, event_type"""
    )
ORACLE["conversion_trends_of_sundays"] = (
    with_(conversion())
    + """SELECT strftime(s.day, '%Y-%m-%d') AS as_of, strftime(c.day, '%Y-%m-%d') AS date,
  c.category, c.conversion_rate
FROM (SELECT DISTINCT day FROM ev WHERE dayofweek(day) = 0) s
JOIN conversion c ON c.day BETWEEN s.day - INTERVAL 7 DAY AND s.day"""
)
PASSED = """(epoch_ms(window_end) <=
  (SELECT epoch_ms(max(event_timestamp)) - 600000 FROM ev))"""
ORACLE["stream_windows"] = (
    with_(windowed(172800, 86400))
    + f"""SELECT 'alert' AS kind, {WINDOW_COLUMNS}, product_id, views, purchases,
  0::BIGINT AS total_events FROM windowed WHERE views > 2 AND purchases < 1
UNION ALL
SELECT 'closed', {WINDOW_COLUMNS}, product_id, views, purchases, total_events
FROM windowed WHERE {PASSED}"""
)
ORACLE["stream_state_windows"] = (
    with_(windowed(172800, 86400))
    + f"""SELECT {WINDOW_COLUMNS}, product_id, views, purchases, total_events
FROM windowed WHERE NOT {PASSED}"""
)
ORACLE["stream_trigger_metrics"] = (
    with_()
    + """SELECT count(*) AS events, count(*) FILTER (event_type = 'error') AS malformed,
  count(*) FILTER (event_type = 'error') AS undated, 0::BIGINT AS late_events,
  strftime(max(event_timestamp) FILTER (event_type <> 'error'), '%Y-%m-%dT%H:%M:%S.%f')
    AS newest_event
FROM ev GROUP BY (day(day) - 1) // 10"""
)

# A key of the first load stays, also where it is no longer among the top five.
ORACLE["merge_upsert"] = (
    with_(EARLY, views("new"), views("old", "early"))
    + f"""SELECT strftime(coalesce(n.day, o.day), '%Y-%m-%d') AS report_date,
  coalesce(n.product_id, o.product_id) AS product_id,
  coalesce(n.view_count, o.view_count) AS view_count,
  coalesce(n.rank, o.rank) AS rank,
  CASE WHEN o.day IS NULL THEN {SECOND_LOAD} ELSE {FIRST_LOAD} END AS created_at
FROM (SELECT * FROM new WHERE rank <= 5) n
FULL JOIN (SELECT * FROM old WHERE rank <= 5) o
  ON o.day = n.day AND o.product_id = n.product_id"""
)
ORACLE["upsert_product_performance"] = ORACLE["merge_upsert"]
