"""The registered queries in plain SQL for another engine, over the same tables."""

from __future__ import annotations

FEED = """
base AS (
  SELECT CASE WHEN e.event_id % 71 <> 0 THEN 'e' || CAST(e.event_id AS VARCHAR) END AS event_id,
         CASE WHEN e.event_id % 97 = 0 THEN 'not_a_timestamp'
              ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_time,
         CASE WHEN e.event_id % 89 = 0 THEN 'x' ELSE '' END || CAST(e.user_id AS VARCHAR) AS user_id,
         e.event_type AS action,
         CAST(p.p_partkey AS VARCHAR) AS product_id,
         CASE WHEN e.event_id % 13 = 0 THEN p.p_name || ' 27", "black", size ""L""'
              ELSE p.p_name END AS product_name,
         p.p_type AS category,
         CASE WHEN e.event_type = 'purchase' AND e.event_id % 83 <> 0 THEN
              CASE WHEN e.event_id % 79 = 0 THEN 'abc'
                   ELSE CAST(CAST(e.value AS DECIMAL(10,2)) AS VARCHAR) END END AS price,
         CASE WHEN e.event_type = 'purchase'
              THEN CAST(1 + e.event_id % 5 AS VARCHAR) END AS quantity,
         CASE WHEN e.event_id % 2 = 0 THEN 'web' ELSE 'mobile' END AS source,
         CAST(e.event_id % 8 AS INTEGER) AS file_no
  FROM events e
  LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS INTEGER)),
feed AS (
  SELECT * FROM base
  UNION ALL
  SELECT * REPLACE (8 AS file_no, 'app' AS source) FROM base WHERE event_id LIKE '%7')
"""


# What streams get: some events twice within their delivery.
DELIVERED = FEED.replace("feed AS (", "once AS (").rstrip() + """,
feed AS (
  SELECT * FROM once
  UNION ALL
  SELECT * REPLACE ('kiosk' AS source) FROM once WHERE event_id LIKE '%3')
"""


def _int(name: str) -> str:
    """Only whole numbers convert; this engine would also round 5.9 and read 1e3."""
    return (
        f"CASE WHEN regexp_full_match(trim({name}), '[+-]?[0-9]+') "
        f"THEN TRY_CAST({name} AS INTEGER) END"
    )


# Rows compared column by column, missing values first.
SMALLEST = """event_time, user_id, action, product_id, product_name NULLS FIRST,
         category NULLS FIRST, price NULLS FIRST, quantity NULLS FIRST, source NULLS FIRST"""

TYPED = f"""
typed AS (
  SELECT event_id, TRY_CAST(event_time AS TIMESTAMP) AS event_time, {_int("user_id")} AS user_id,
         action, {_int("product_id")} AS product_id, product_name, category,
         TRY_CAST(price AS DECIMAL(10,2)) AS price, {_int("quantity")} AS quantity, source,
         file_no, price AS raw_price, quantity AS raw_quantity,
         CASE WHEN file_no <= 3 THEN 0 WHEN file_no <= 7 THEN 1 ELSE 2 END AS wave
  FROM feed),
clean AS (
  SELECT * FROM typed
  WHERE action IN ('view', 'purchase') AND event_id IS NOT NULL AND event_time IS NOT NULL
    AND user_id IS NOT NULL AND product_id IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {SMALLEST}) AS place
  FROM clean),
uniq AS (SELECT * FROM ranked WHERE place = 1),
arrived AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY wave, {SMALLEST}) AS turn,
         row_number() OVER (PARTITION BY event_id, wave ORDER BY {SMALLEST}) AS copy
  FROM clean),
first_arrived AS (SELECT * FROM arrived WHERE turn = 1),
per_wave AS (SELECT * FROM arrived WHERE copy = 1),
early AS (SELECT * FROM clean WHERE wave = 0),
waves AS (SELECT wave, count(DISTINCT event_id) AS n FROM clean GROUP BY wave)
"""

ROW = (
    "event_id, user_id, action, product_id, product_name, category, quantity, source, "
    "event_time, CAST(price AS DOUBLE) AS price"
)
RAW = (
    "event_id, event_time, user_id, action, product_id, product_name, category, price, "
    "quantity, source"
)
BROKEN = """
broken AS (
  SELECT f.*, CASE WHEN action IS NULL OR action NOT IN ('view', 'purchase') THEN 'bad_action'
              WHEN event_id IS NULL THEN 'missing_event_id'
              WHEN TRY_CAST(event_time AS TIMESTAMP) IS NULL THEN 'bad_event_time'
              WHEN {user} IS NULL THEN 'bad_user_id'
              WHEN {product} IS NULL THEN 'bad_product_id' END AS reason
  FROM feed f)
""".format(user=_int("user_id"), product=_int("product_id"))

AUDIT = """
  SELECT 'unique_event_id' AS constraint_name,
         (SELECT count(*) - count(DISTINCT event_id) FROM {valid}) AS violations
  UNION ALL SELECT 'null_event_id', count(*) FROM {rows} WHERE event_id IS NULL
  UNION ALL SELECT 'null_event_time', count(*) FROM {rows} WHERE event_time IS NULL
  UNION ALL SELECT 'null_user_id', count(*) FROM {rows} WHERE user_id IS NULL
  UNION ALL SELECT 'null_action', count(*) FROM {rows} WHERE action IS NULL
  UNION ALL SELECT 'null_product_id', count(*) FROM {rows} WHERE product_id IS NULL
  UNION ALL SELECT 'action_domain', count(*) FROM {rows}
            WHERE action IS NULL OR action NOT IN ('view', 'purchase')
  UNION ALL SELECT 'cast_loss_price', count(*) FROM {rows} WHERE {price_lost}
  UNION ALL SELECT 'cast_loss_quantity', count(*) FROM {rows} WHERE {quantity_lost}
"""

IN_DAY = "event_time >= TIMESTAMP '2024-01-05' AND event_time < TIMESTAMP '2024-01-06'"

UNIQUE_ROWS = f"SELECT {ROW} FROM uniq"
# A row that is unique over all batches is the one that arrived first.
FIRST_ROWS = f"SELECT {ROW} FROM first_arrived"
TEXTS = (
    "event_id, event_time, user_id, action, product_id, product_name, category, quantity, source"
)
DAMAGED = """,
numbered AS (SELECT *, CAST(substr(event_id, 2) AS BIGINT) AS number FROM clean),
damaged AS (
  SELECT * REPLACE (CASE WHEN number % 101 <> 0 THEN user_id END AS user_id,
                    CASE WHEN number % 103 = 0 THEN 'click' ELSE action END AS action),
         number % 107 = 0 AS no_time FROM numbered),
whole AS (SELECT * FROM damaged WHERE user_id IS NOT NULL AND action IN ('view', 'purchase'))
"""
UNIQUE_ACTIONS = "SELECT action, count(*) AS n FROM uniq GROUP BY action"

# Files of every third number lack the source, others have one more column.
MIXED = f"""
SELECT {ROW.replace("source", "CASE WHEN file_no % 3 <> 1 THEN source END AS source")},
       CASE WHEN file_no % 3 = 2 THEN 'v2' END AS app FROM clean"""

_BODIES = {
    "action_counts": "SELECT action, count(*) AS n FROM clean GROUP BY action",
    "raw_feed_count": "SELECT count(*) AS n FROM feed",
    "raw_feed_rows": "SELECT * FROM feed",
    "clean_count": "SELECT count(*) AS n FROM clean",
    "distinct_event_ids": "SELECT count(DISTINCT event_id) AS n FROM clean",
    "clean_events": f"SELECT {ROW} FROM clean",
    "dedup_events": UNIQUE_ROWS,
    "latest_events": "SELECT event_id, action, product_id, source, event_time FROM uniq "
    "ORDER BY event_time DESC, event_id LIMIT 5",
    "strict_cast_events": f"SELECT {ROW} FROM clean WHERE raw_price IS NULL OR price IS NOT NULL",
    "default_stored_at": "SELECT action, count(*) AS n, CAST(0 AS BIGINT) AS missing "
    "FROM clean GROUP BY action",
    "rejected_events": f"SELECT {RAW}, file_no, reason FROM broken WHERE reason IS NOT NULL",
    "reject_reasons": "SELECT reason, count(*) AS n FROM broken WHERE reason IS NOT NULL "
    "GROUP BY reason",
    "constraint_audit": AUDIT.format(
        rows="typed",
        valid="clean",
        price_lost="raw_price IS NOT NULL AND price IS NULL",
        quantity_lost="raw_quantity IS NOT NULL AND quantity IS NULL",
    ),
    "stored_constraint_audit": DAMAGED + AUDIT.format(
        rows="damaged", valid="whole", price_lost="FALSE", quantity_lost="FALSE"
    )
    + "  UNION ALL SELECT 'null_stored_at', count(*) FROM damaged WHERE no_time",
    "time_range_lookup": f"SELECT {ROW} FROM uniq WHERE {IN_DAY}",
    "user_lookup": f"SELECT {ROW} FROM uniq WHERE user_id = 12",
    "product_lookup": f"SELECT {ROW} FROM uniq WHERE product_id = 7",
    "action_lookup": f"SELECT {ROW} FROM uniq WHERE action = 'purchase'",
    "stored_lookups": f"""
  SELECT {ROW}, 'day' AS lookup FROM first_arrived WHERE {IN_DAY}
  UNION ALL SELECT {ROW}, 'user' FROM first_arrived WHERE user_id = 12
  UNION ALL SELECT {ROW}, 'product' FROM first_arrived WHERE product_id = 7
  UNION ALL SELECT {ROW}, 'action' FROM first_arrived WHERE action = 'purchase'""",
    "curve_lookups": f"""
  SELECT {ROW}, 'day' AS lookup FROM uniq WHERE {IN_DAY}
  UNION ALL SELECT {ROW}, 'user' FROM uniq WHERE user_id = 12
  UNION ALL SELECT {ROW}, 'product' FROM uniq WHERE product_id = 7""",
    "heavy_products": """
  SELECT product_id AS value, count(*) AS n FROM feed WHERE product_id IS NOT NULL
  GROUP BY product_id HAVING count(*) > 0.0105 * (SELECT count(product_id) FROM feed)""",
    "salted_product_join": """
  SELECT e.event_id, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS product, p.p_name AS name
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS INTEGER)""",
    "replayed_days": UNIQUE_ROWS,
    "mixed_headers": MIXED,
    "stream_mixed_headers": MIXED,
    "csv_roundtrip": f"SELECT {RAW}, CAST(NULL AS VARCHAR) AS malformed FROM feed",
    "create_if_absent": UNIQUE_ROWS,
    "jdbc_append_roundtrip": UNIQUE_ROWS,
    "jdbc_merge_twice": f"""
  SELECT {ROW}, (SELECT n FROM waves WHERE wave = 0) AS added_1,
         (SELECT count(*) FROM uniq) - (SELECT n FROM waves WHERE wave = 0) AS added_2
  FROM (SELECT * FROM early
        UNION ALL SELECT * EXCLUDE (place) FROM uniq
        WHERE event_id NOT IN (SELECT event_id FROM early))""",
    "jdbc_subquery": UNIQUE_ACTIONS,
    "full_refresh": UNIQUE_ROWS,
    "stream_parquet": f"SELECT {ROW} FROM clean",
    "stream_unique_parquet": FIRST_ROWS,
    "stream_batch_sink": f"SELECT {ROW}, CAST(wave AS BIGINT) AS batch_id FROM first_arrived",
    "compacted_batches": f"SELECT {ROW}, CAST(wave AS BIGINT) AS batch_id FROM first_arrived",
    "stream_unique_batch_sink": f"SELECT {ROW}, CAST(wave AS BIGINT) AS batch_id FROM first_arrived",
    "stream_to_database": FIRST_ROWS,
    "stream_two_sinks": f"""
  SELECT {ROW}, 'files' AS sink FROM per_wave
  UNION ALL SELECT {ROW}, 'database' FROM first_arrived""",
    "stream_quarantine": f"""
  SELECT {TEXTS}, CAST(CASE WHEN file_no <= 3 THEN 0 WHEN file_no <= 7 THEN 1 ELSE 2 END AS BIGINT)
         AS batch_id, reason FROM broken WHERE reason IS NOT NULL
  UNION ALL
  SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), CAST(user_id AS VARCHAR), action,
         CAST(product_id AS VARCHAR), product_name, category, CAST(quantity AS VARCHAR), source,
         CAST(wave AS BIGINT), 'stored' FROM first_arrived""",
    "stream_unique_quarantine": f"""
  SELECT {TEXTS}, CAST(CASE WHEN file_no <= 3 THEN 0 WHEN file_no <= 7 THEN 1 ELSE 2 END AS BIGINT)
         AS batch_id, reason FROM broken WHERE reason IS NOT NULL
  UNION ALL
  SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), CAST(user_id AS VARCHAR), action,
         CAST(product_id AS VARCHAR), product_name, category, CAST(quantity AS VARCHAR), source,
         CAST(wave AS BIGINT), 'stored' FROM first_arrived""",
    # The watermark of a delivery: the newest whole millisecond of earlier ones, less 20 days.
    "stream_remembered_keys": f""",
marks AS (
  SELECT wave, max(epoch_ms(event_time)) AS newest FROM clean GROUP BY wave),
told AS (
  SELECT p.*, epoch_ms(event_time) < coalesce((SELECT max(newest) FROM marks m
         WHERE m.wave < p.wave) - 20 * 86400000::BIGINT, 0) AS is_late FROM per_wave p),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY event_id, is_late ORDER BY wave) AS arrival FROM told)
SELECT {ROW}, CASE WHEN is_late THEN 'late' ELSE 'stored' END AS fate
FROM counted WHERE is_late OR arrival = 1""",
    "stream_interval": FIRST_ROWS,
    "kept_counts": UNIQUE_ACTIONS,
    "redelivered_keys": """,
sizes AS (SELECT wave, count(*) AS size FROM per_wave GROUP BY wave),
pairs AS (
  SELECT a.wave AS earlier, b.wave AS later, a.size AS size_a, b.size AS size_b,
         (SELECT count(*) FROM per_wave x JOIN per_wave y USING (event_id)
          WHERE x.wave = a.wave AND y.wave = b.wave) AS shared
  FROM sizes a JOIN sizes b ON a.wave < b.wave),
figures AS (
  SELECT earlier, later, 'union' AS measure, size_a + size_b - shared AS exact FROM pairs
  UNION ALL SELECT earlier, later, 'repeated', shared FROM pairs
  UNION ALL SELECT earlier, later, 'new', size_b - shared FROM pairs)
SELECT CAST(earlier AS BIGINT) AS earlier, CAST(later AS BIGINT) AS later, measure,
       exact AS estimate, exact, TRUE AS within FROM figures""",
    "price_quantiles": """,
ranks(rank) AS (SELECT unnest([0.0::DOUBLE, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])),
prices AS (SELECT action, count(price) AS n, CAST(min(price) AS DOUBLE) AS lowest,
                  CAST(max(price) AS DOUBLE) AS highest FROM first_arrived GROUP BY action)
SELECT action, n, rank, CASE rank WHEN 0 THEN lowest WHEN 1 THEN highest END AS edge,
       TRUE AS within FROM prices, ranks WHERE n > 0""",
    "metric_quantiles": """,
ranks(rank) AS (SELECT unnest([0.0::DOUBLE, 0.5, 1.0])),
measures(measure) AS (SELECT unnest(['rows', 'seconds', 'rows_per_s']))
SELECT measure, (SELECT count(*) FROM waves) AS n, rank,
       CASE WHEN measure = 'rows' THEN CAST(CASE rank
         WHEN 0 THEN (SELECT min(n) FROM waves) WHEN 1 THEN (SELECT max(n) FROM waves)
         ELSE (SELECT quantile_disc(n, 0.5) FROM waves) END AS DOUBLE) END AS value,
       TRUE AS within FROM measures, ranks""",
    "reject_drift": f""",
planted AS (
  SELECT * REPLACE (CASE WHEN file_no = 5 AND regexp_matches(event_id, '[02468]$')
                         THEN 'x' || user_id ELSE user_id END AS user_id)
  FROM feed WHERE file_no <= 7),
{BROKEN.strip().replace("broken AS", "told AS").replace("FROM feed f", "FROM planted f")},
reasons(reason) AS (SELECT unnest(['bad_action', 'missing_event_id', 'bad_event_time',
                                   'bad_user_id', 'bad_product_id'])),
shares AS (
  SELECT b.file_no, r.reason, count(*) FILTER (t.reason = r.reason) AS rejected,
         count(*) FILTER (t.reason = r.reason) / count(*) AS share
  FROM (SELECT DISTINCT file_no FROM planted) b CROSS JOIN reasons r
  JOIN told t ON t.file_no = b.file_no GROUP BY b.file_no, r.reason),
averaged AS (
  SELECT *, (SELECT avg(share) FROM shares o WHERE o.reason = s.reason AND o.file_no < 3) AS mean
  FROM shares s),
summed AS (
  SELECT *, sum(share - mean - 0.01::DOUBLE) OVER (PARTITION BY reason ORDER BY file_no) AS total
  FROM averaged),
cusum AS (
  SELECT *, total - least(min(total) OVER (PARTITION BY reason ORDER BY file_no), 0) AS statistic
  FROM summed)
SELECT CAST(file_no AS BIGINT) AS batch_id, reason, rejected, round(statistic, 6) AS statistic,
       statistic > 0.05 AS flagged FROM cusum""",
    "recorded_triggers": """,
sizes AS (
  SELECT CASE WHEN file_no <= 3 THEN 0 WHEN file_no <= 7 THEN 1 ELSE 2 END AS wave,
         count(*) AS input_rows FROM feed GROUP BY 1)
SELECT CAST(wave AS BIGINT) AS batch_id, input_rows,
       input_rows > 0.9 * (SELECT max(input_rows) FROM sizes) AS behind FROM sizes""",
    "replay_after_reset": UNIQUE_ROWS,
    "batch_metrics": """
  SELECT CAST(CASE wave WHEN 0 THEN 0 ELSE wave + 1 END AS BIGINT) AS batch_id, n AS rows,
         FALSE AS skipped, TRUE AS timed FROM waves
  UNION ALL SELECT 1, 0, TRUE, FALSE""",
    "trigger_progress": """
  SELECT CAST(CASE WHEN file_no <= 3 THEN 0 WHEN file_no <= 7 THEN 1 ELSE 2 END AS BIGINT)
         AS batch_id, count(*) > 0 AS had_input, FALSE AS behind FROM feed GROUP BY 1""",
    "days_behind": """
  SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, count(*) AS input_rows,
         epoch_us(max(event_time)) - epoch_us(min(event_time)) > 86000 * CAST(1000000 AS BIGINT) AS behind
  FROM clean GROUP BY 1""",
    "latest_stored": """
  SELECT event_id, action, product_id, source FROM first_arrived
  ORDER BY wave DESC, event_id LIMIT 5""",
    "metrics_summary": """
  SELECT 'rows' AS measure, count(*) AS batches, CAST(min(n) AS DOUBLE) AS lowest,
         CAST(max(n) AS DOUBLE) AS highest, avg(n) AS mean,
         CAST(quantile_disc(n, 0.5) AS DOUBLE) AS typical FROM waves""",
    "stored_at_per_batch": """
  SELECT CAST(wave AS BIGINT) AS batch_id, CAST(1 AS BIGINT) AS times FROM waves""",
}


# Queries whose rows come through a stream.
STREAMED = {n for n in _BODIES if n.startswith("stream_") and n != "stream_mixed_headers"} | {
    "batch_metrics", "trigger_progress", "metrics_summary", "latest_stored", "stored_at_per_batch",
    "stored_lookups", "kept_counts", "redelivered_keys", "price_quantiles", "metric_quantiles",
    "recorded_triggers", "compacted_batches",
}


def oracle() -> dict[str, str]:
    """SQL by query name. Only the raw tables are registered there, so each carries the feed."""
    return {
        name: f"WITH {(DELIVERED if name in STREAMED else FEED).strip()},\n{TYPED.strip()},\n"
        f"{BROKEN.strip()}\n{body.strip()}"
        for name, body in _BODIES.items()
    }
