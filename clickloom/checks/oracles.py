"""The same queries in DuckDB SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

_AD_EVENTS = """
  timed AS (
    SELECT event_id AS n, CAST(floor(epoch(ts)) AS BIGINT) AS sec, user_id, event_type AS kind,
           value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS campaign
    FROM events
  ),
  ad AS (
    SELECT printf('evt_%08d', n) AS event_id, n, 'ad_event' AS event_type, sec AS timestamp,
           strftime(make_timestamp(sec * 1000000), '%Y-%m-%dT%H:%M:%S') AS event_time,
           printf('user_%06d', user_id) AS uid, campaign,
           CASE WHEN kind IN ('click', 'purchase') THEN 1 ELSE 0 END AS click,
           CASE WHEN kind = 'purchase' THEN 1 ELSE 0 END AS conversion,
           CASE WHEN kind = 'purchase' THEN sec + 60 + (n * 7919) % 259141 END AS conversion_timestamp,
           CASE WHEN kind IN ('click', 'purchase') THEN value ELSE 0.0 END AS cost
    FROM timed
  )"""

_PROCESSED = (
    _AD_EVENTS
    + """,
  processed AS (
    SELECT event_id, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS event_date, uid,
           campaign, click, conversion,
           CASE WHEN conversion = 1 THEN conversion_timestamp - timestamp END AS conversion_delay_sec,
           round(cost, 4) AS cost
    FROM ad
  ),
  first_state AS (
    SELECT event_id, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS event_date, uid,
           campaign, click,
           CASE WHEN conversion_timestamp < epoch(DATE '2024-01-25') THEN conversion ELSE 0 END AS conversion,
           CASE WHEN conversion_timestamp < epoch(DATE '2024-01-25')
                THEN conversion_timestamp - timestamp END AS conversion_delay_sec,
           round(cost, 4) AS cost
    FROM ad
  ),
  first_load AS (SELECT * FROM first_state WHERE event_date < '2024-01-25'),
  recent AS (
    SELECT * FROM processed
    WHERE CAST(event_date AS DATE) >= DATE '2024-01-30' - INTERVAL 7 DAY
  )"""
)

_CORRECTED = (
    _AD_EVENTS
    + """,
  sent AS (
    SELECT event_id, timestamp, uid, campaign, click, conversion, conversion_timestamp, cost,
           timestamp AS sent_at
    FROM ad
    UNION ALL
    SELECT event_id, timestamp, uid, campaign, click, 1, timestamp + 60, cost + 1,
           timestamp + 86400
    FROM ad WHERE click = 1
  ),
  newest AS (
    SELECT event_id, strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS event_date, uid,
           campaign, click, conversion,
           CASE WHEN conversion = 1 THEN conversion_timestamp - timestamp END AS conversion_delay_sec,
           round(cost, 4) AS cost
    FROM sent
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY sent_at DESC) = 1
  )"""
)

_MOVED = (
    _AD_EVENTS
    + """,
  moved AS (
    SELECT strftime(make_timestamp((timestamp + CASE WHEN n % 7 = 0 THEN 86400 ELSE 0 END) * 1000000), '%Y-%m-%d')
             AS event_date,
           CAST(campaign + CASE WHEN n % 7 = 0 THEN 1000 ELSE 0 END AS INTEGER) AS campaign, click, conversion, cost
    FROM ad
  )"""
)

_FEED = (
    _AD_EVENTS
    + """,
  impressions AS (
    SELECT event_id, 'impression' AS event_type, timestamp,
           CAST(NULL AS BIGINT) AS impression_timestamp, uid, campaign, round(cost, 4) AS cost,
           CAST(NULL AS BIGINT) AS conversion_delay_sec
    FROM ad
  ),
  clicks AS (
    SELECT event_id, 'click' AS event_type,
           timestamp + 1 + CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) % 30 AS timestamp,
           timestamp AS impression_timestamp, uid, campaign, CAST(NULL AS DOUBLE) AS cost,
           CAST(NULL AS BIGINT) AS conversion_delay_sec
    FROM ad WHERE click <> 0
  ),
  conversions AS (
    SELECT event_id, 'conversion' AS event_type, conversion_timestamp AS timestamp,
           timestamp AS impression_timestamp, uid, campaign, CAST(NULL AS DOUBLE) AS cost,
           conversion_timestamp - timestamp AS conversion_delay_sec
    FROM ad WHERE conversion <> 0 AND conversion_timestamp > timestamp
  ),
  feed AS (
    SELECT * FROM impressions UNION ALL SELECT * FROM clicks UNION ALL SELECT * FROM conversions
  )"""
)

_ISO = "strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%dT%H:%M:%S') AS event_time"

_RATES = """
  round(CASE WHEN impressions > 0 THEN clicks * 100.0 / impressions ELSE 0 END, 6) AS ctr,
  round(CASE WHEN clicks > 0 THEN conversions * 100.0 / clicks ELSE 0 END, 6) AS cvr"""

_CPA = "round(CASE WHEN conversions > 0 THEN total_cost / conversions END, 6) AS cpa"


def _with(definitions: str, query: str) -> str:
    return f"WITH {definitions}\n{query}"


def _grouped(source: str, where: str = "TRUE") -> str:
    return f"""
    SELECT event_date AS summary_date, campaign, count(*) AS impressions,
           CAST(sum(click) AS BIGINT) AS clicks, CAST(sum(conversion) AS BIGINT) AS conversions,
           sum(cost) AS total_cost
    FROM {source} WHERE {where} GROUP BY event_date, campaign"""


def _summary(groups: str) -> str:
    return f"""
    SELECT summary_date, campaign, impressions, clicks, conversions,
           round(total_cost, 4) AS total_cost, {_RATES}, {_CPA}
    FROM ({groups})"""


def _merged(target: str, source: str) -> str:
    columns = ("event_date", "uid", "campaign", "click", "conversion", "conversion_delay_sec", "cost")
    chosen = ", ".join(
        f"CASE WHEN s.event_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return (
        f"SELECT coalesce(s.event_id, t.event_id) AS event_id, {chosen} "
        f"FROM {target} t FULL OUTER JOIN {source} s ON t.event_id = s.event_id"
    )


_RAW_COLUMNS = """
  CAST(n % 3 AS INTEGER) AS kafka_partition, n // 3 AS kafka_offset,
  strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS kafka_timestamp,
  event_id, event_type, timestamp, event_time, uid, campaign, click, conversion,
  conversion_timestamp, round(cost, 4) AS cost,
  strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS event_timestamp"""

_EVENT_COLUMNS = """
  event_id, event_type, timestamp, event_time, uid, campaign, click, conversion,
  conversion_timestamp, round(cost, 4) AS cost"""

_STATS = f"""
  SELECT impressions AS total, clicks, conversions, round(total_cost, 4) AS total_cost,
         round(avg_delay_hours, 6) AS avg_delay_hours, campaigns, min_ts, max_ts, {_RATES}, {_CPA},
         strftime(make_timestamp(min_ts * 1000000), '%Y-%m-%d %H:%M') || ' ~ ' ||
         strftime(make_timestamp(max_ts * 1000000), '%Y-%m-%d %H:%M') AS period
  FROM (
    SELECT count(*) AS impressions, CAST(sum(click) AS BIGINT) AS clicks,
           CAST(sum(conversion) AS BIGINT) AS conversions, sum(cost) AS total_cost,
           coalesce(avg(CASE WHEN conversion <> 0 AND conversion_timestamp > timestamp
                             THEN conversion_timestamp - timestamp END) / 3600, 0) AS avg_delay_hours,
           count(DISTINCT campaign) AS campaigns, min(timestamp) AS min_ts, max(timestamp) AS max_ts
    FROM ad
  )"""

_DAMAGED = """
  SELECT CAST(n % 3 AS INTEGER) AS kafka_partition, n // 3 AS kafka_offset,
         strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS kafka_timestamp,
         CASE WHEN click = 1 THEN event_id END AS event_id,
         CASE WHEN click = 1 THEN event_type END AS event_type,
         CASE WHEN click = 1 THEN timestamp END AS timestamp,
         CASE WHEN click = 1 THEN event_time END AS event_time,
         CASE WHEN click = 1 THEN uid END AS uid,
         CASE WHEN click = 1 AND conversion = 0 THEN campaign END AS campaign,
         CASE WHEN click = 1 THEN click END AS click,
         CASE WHEN click = 1 THEN conversion END AS conversion,
         CASE WHEN click = 1 THEN conversion_timestamp END AS conversion_timestamp,
         CASE WHEN click = 1 THEN round(cost, 4) END AS cost
  FROM ad"""

# Moved from the log's own start to the base, 2026-04-01T00:00:00 in UTC.
_REBASED = """
  SELECT timestamp - 1704067200 + epoch(TIMESTAMP '2026-04-01 00:00:00')::BIGINT AS timestamp, uid,
         CAST(campaign AS VARCHAR) AS campaign,
         CAST(CASE WHEN click = 0 THEN 0 ELSE click END AS BIGINT) AS click,
         CAST(conversion AS BIGINT) AS conversion,
         conversion_timestamp - 1704067200 + epoch(TIMESTAMP '2026-04-01 00:00:00')::BIGINT
           AS conversion_timestamp,
         cost
  FROM ad"""

_NUMBERED = "row_number() OVER (ORDER BY timestamp, event_id) - 1"


def all_sql() -> dict[str, str]:
    return {
        "ad_events_adapter": _with(_AD_EVENTS, f"SELECT {_EVENT_COLUMNS} FROM ad"),
        "raw_projection": _with(_AD_EVENTS, f"SELECT {_RAW_COLUMNS} FROM ad"),
        "raw_scan": _with(
            _AD_EVENTS,
            f"SELECT {_RAW_COLUMNS}, fmt, TRUE AS landed_right FROM ad CROSS JOIN (VALUES ('parquet'), ('json')) f(fmt)",
        ),
        "csv_roundtrip": _with(
            _AD_EVENTS,
            "SELECT timestamp, '\"a\", ' || uid || '\"' AS uid, campaign, click, conversion, "
            "conversion_timestamp, round(cost, 4) AS cost FROM ad",
        ),
        "silver_transform": _with(_PROCESSED, "SELECT * FROM processed"),
        "silver_dedup_latest": _with(_CORRECTED, "SELECT * FROM newest"),
        "silver_dedup_any": _with(_PROCESSED, "SELECT DISTINCT * FROM processed"),
        "silver_recent_prefiltered": _with(
            _CORRECTED,
            "SELECT * FROM newest WHERE CAST(event_date AS DATE) >= DATE '2024-01-30' - INTERVAL 7 DAY",
        ),
        "recent_window": _with(_PROCESSED, "SELECT * FROM recent"),
        "campaign_summary": _with(_PROCESSED, _summary(_grouped("recent"))),
        "campaign_summary_all_days": _with(_PROCESSED, _summary(_grouped("processed"))),
        "merge_processed": _with(_PROCESSED, _merged("first_load", "recent")),
        "merge_far_dates": _with(
            _AD_EVENTS
            + ", far AS (SELECT *, CASE WHEN n % 50 = 0 THEN timestamp * 1000 ELSE timestamp END AS t FROM ad)",
            "SELECT event_id, CAST(t // 86400 AS INTEGER) AS event_day, uid, campaign, click, conversion, "
            "CASE WHEN conversion = 1 THEN conversion_timestamp - t END AS conversion_delay_sec, "
            "round(cost, 4) AS cost FROM far",
        ),
        "merge_processed_plan": _with(_PROCESSED, _merged("first_load", "recent")),
        "merge_summary": _with(
            _PROCESSED
            + ", t AS ("
            + _grouped("first_load", "event_date >= '2024-01-18'")
            + "), s AS ("
            + _grouped("recent")
            + ")",
            _summary(
                "SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s "
                "WHERE s.summary_date = t.summary_date AND s.campaign = t.campaign)"
            ),
        ),
        "full_refresh_dynamic": _with(
            _PROCESSED,
            "SELECT * FROM recent UNION ALL SELECT * FROM first_load "
            "WHERE event_date NOT IN (SELECT event_date FROM recent)",
        ),
        "append_batch": _with(
            _PROCESSED, "SELECT * FROM first_load UNION ALL SELECT * FROM recent"
        ),
        "backfill_range": _with(
            _PROCESSED
            + ", range_rows AS (SELECT * FROM processed "
            + "WHERE event_date BETWEEN '2024-01-10' AND '2024-01-20')",
            _merged("first_state", "range_rows"),
        ),
        "dataset_stats": _with(_AD_EVENTS, _STATS),
        "stats_for_display": _with(
            _AD_EVENTS,
            "SELECT * REPLACE (round(total_cost, 2) AS total_cost, round(ctr, 2) AS ctr, round(cvr, 2) AS cvr, "
            f"round(cpa, 2) AS cpa, round(avg_delay_hours, 1) AS avg_delay_hours) FROM ({_STATS})",
        ),
        "scan_stats": _with(
            _AD_EVENTS,
            "SELECT count(*) AS total_rows, min(CASE WHEN click <> 0 THEN timestamp END) AS min_ts, "
            "max(CASE WHEN click <> 0 THEN timestamp END) AS max_ts FROM ad",
        ),
        "fanout_all": _with(
            _FEED,
            f"SELECT *, {_ISO} FROM feed "
            # no time can be shown for the last second, and none be added to it
            "UNION ALL SELECT 'x' || event_id, 'impression', 9223372036854775807, NULL, uid, campaign, "
            "round(cost, 4), NULL, NULL FROM ad WHERE n % 500 = 0 "
            "UNION ALL SELECT 'x' || event_id, 'click', NULL, 9223372036854775807, uid, campaign, "
            "NULL, NULL, NULL FROM ad WHERE n % 500 = 0",
        ),
        "fanout_impressions": _with(
            _FEED, "SELECT event_id, event_type, timestamp, uid, campaign, cost FROM impressions"
        ),
        "fanout_clicks": _with(
            _FEED,
            "SELECT event_id, event_type, timestamp, impression_timestamp, uid, campaign FROM clicks",
        ),
        "fanout_conversions": _with(
            _FEED,
            "SELECT event_id, event_type, timestamp, impression_timestamp, uid, campaign, "
            "conversion_delay_sec FROM conversions",
        ),
        "fanout_union": _with(_FEED, "SELECT * FROM feed"),
        "conversions_with_timestamp": _with(
            _AD_EVENTS,
            "SELECT event_id, 'conversion' AS event_type, conversion_timestamp AS timestamp, "
            "timestamp AS impression_timestamp, uid, campaign, "
            "conversion_timestamp - timestamp AS conversion_delay_sec FROM ad "
            "WHERE conversion <> 0 AND conversion_timestamp IS NOT NULL",
        ),
        "fanout_summary": _with(
            _FEED,
            f"""SELECT impressions, clicks, conversions, round(avg_delay_hours, 6) AS avg_delay_hours,
            {_RATES} FROM (
              SELECT count(*) FILTER (event_type = 'impression') AS impressions,
                     count(*) FILTER (event_type = 'click') AS clicks,
                     count(*) FILTER (event_type = 'conversion') AS conversions,
                     coalesce(avg(conversion_delay_sec) / 3600, 0) AS avg_delay_hours
              FROM feed)""",
        ),
        "topic_counters": _with(
            _FEED,
            "SELECT 'ad-' || event_type || 's' AS topic, count(*) AS messages FROM feed "
            "GROUP BY event_type",
        ),
        "feed_messages": _with(
            _FEED,
            f"""SELECT uid AS key, 'ad-' || event_type || 's' AS topic,
            'event_id,event_type,timestamp,event_time,uid,campaign' ||
              CASE event_type WHEN 'impression' THEN ',cost' WHEN 'click' THEN ''
                              ELSE ',conversion_delay_sec' END AS fields,
            event_id, event_type, timestamp, {_ISO}, uid, campaign, cost, conversion_delay_sec FROM feed""",
        ),
        "relink_events": _with(
            _FEED,
            "SELECT i.event_id, i.timestamp, i.uid, i.campaign, i.cost, "
            "c.timestamp AS click_timestamp, v.timestamp AS conversion_timestamp, "
            "v.conversion_delay_sec FROM impressions i "
            "LEFT JOIN clicks c USING (event_id) LEFT JOIN conversions v USING (event_id)",
        ),
        "message_encode_decode": _with(_AD_EVENTS, _DAMAGED),
        "dead_letters": _with(
            _AD_EVENTS,
            "SELECT CAST(n % 3 AS INTEGER) AS kafka_partition, n // 3 AS kafka_offset, "
            "strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS kafka_timestamp, "
            "'{\"event_id\":\"' || event_id || '\",\"event_type\":\"ad_event\",\"timestamp\":' || timestamp || "
            "',\"event_time\":\"' || event_time || '\",\"uid\":\"' || uid || '\",\"campaign\":' || campaign || "
            "',\"click\":0,\"conversion\":0,\"conversion_timestamp\":null,\"' AS payload "
            "FROM ad WHERE click = 0",
        ),
        "tsv_prepare": _with(
            _AD_EVENTS,
            f"SELECT * FROM ({_REBASED}) UNION ALL SELECT * REPLACE (NULL AS conversion_timestamp) "
            f"FROM ({_REBASED}) WHERE conversion = 1",
        ),
        "sample_exact": _with(
            _AD_EVENTS,
            f"SELECT {_EVENT_COLUMNS} FROM ad QUALIFY row_number() OVER "
            "(ORDER BY md5('42:' || event_id), event_id) <= (SELECT count(*) // 4 FROM ad)",
        ),
        "sample_of_copies": _with(
            _AD_EVENTS,
            "SELECT event_id AS row, CASE WHEN n % 3 = 0 THEN 'the same line' ELSE uid END AS line FROM ad "
            "QUALIFY row_number() OVER (ORDER BY md5('42:' || event_id), event_id) "
            "<= (SELECT count(*) // 4 FROM ad)",
        ),
        "row_index": _with(
            _AD_EVENTS, f"SELECT timestamp, event_id, {_NUMBERED} AS row_idx FROM ad"
        ),
        "numbered_events": _with(
            _AD_EVENTS + f", numbered AS (SELECT *, {_NUMBERED} AS i FROM ad)",
            "SELECT printf('evt_%08d', i) AS event_id, event_type, timestamp, event_time, uid, "
            "campaign, click, conversion, conversion_timestamp, round(cost, 4) AS cost FROM numbered",
        ),
        "time_order": _with(
            _AD_EVENTS, f"SELECT {_EVENT_COLUMNS} FROM ad ORDER BY timestamp, event_id"
        ),
        "head_slice": _with(
            _AD_EVENTS, f"SELECT {_EVENT_COLUMNS} FROM ad ORDER BY timestamp, event_id LIMIT 1000"
        ),
        "tail_slice": _with(
            _AD_EVENTS,
            f"SELECT {_EVENT_COLUMNS} FROM ad "
            f"QUALIFY {_NUMBERED} >= (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM ad)",
        ),
        "max_events": _with(
            _AD_EVENTS, f"SELECT {_EVENT_COLUMNS} FROM ad ORDER BY timestamp, event_id LIMIT 5000"
        ),
        "max_events_as_given": _with(
            _AD_EVENTS
            + ", numbered AS (SELECT *, row_number() OVER (ORDER BY n % 3, n % 5, n DESC) - 1 AS i FROM ad)",
            "SELECT printf('evt_%08d', i) AS event_id, event_type, timestamp, event_time, uid, "
            "campaign, click, conversion, conversion_timestamp, round(cost, 4) AS cost FROM numbered "
            "WHERE i < 5000",
        ),
        "interevent_gap": _with(
            _AD_EVENTS
            + """, every AS (
            SELECT event_id, uid, timestamp FROM ad UNION ALL
            SELECT 'x' || event_id, uid, CASE WHEN n % 1000 = 0 THEN 9223372036854775807
                                              ELSE -9223372036854775808 END FROM ad WHERE n % 500 = 0),
            apart AS (
            SELECT *, timestamp::HUGEINT - lag(timestamp) OVER
              (PARTITION BY uid ORDER BY timestamp, event_id) AS gap FROM every)""",
            "SELECT event_id, uid, timestamp, CASE WHEN gap BETWEEN -9223372036854775808 "
            "AND 9223372036854775807 THEN gap::BIGINT END AS gap_sec FROM apart",
        ),
        "health_freshness": _with(
            _PROCESSED,
            "SELECT '2024-02-01 00:00:00' AS newest_update, max(event_date) AS newest_event_date, "
            "CAST(86400 AS BIGINT) AS update_age_sec, "
            "CAST(date_diff('day', CAST(max(event_date) AS DATE), DATE '2024-02-02') AS INTEGER) "
            "AS event_age_days FROM processed",
        ),
        "health_rows_per_day": _with(
            _PROCESSED, "SELECT event_date, count(*) AS rows FROM processed GROUP BY event_date"
        ),
        "health_rows_from_footers": _with(
            _PROCESSED, "SELECT event_date, count(*) AS rows FROM processed GROUP BY event_date"
        ),
        "health_duplicates": _with(
            _CORRECTED,
            "SELECT event_id, count(*) AS copies FROM sent GROUP BY event_id HAVING count(*) > 1",
        ),
        "health_files": _with(
            _PROCESSED,
            "SELECT DISTINCT event_date, TRUE AS has_files, TRUE AS mean_fits, TRUE AS largest_fits FROM processed",
        ),
        "compacted_summary": _with(_PROCESSED, _summary(_grouped("processed"))),
        "compacted_raw": _with(_AD_EVENTS, f"SELECT {_RAW_COLUMNS}, TRUE AS landed_right FROM ad"),
        "compacted": _with(_PROCESSED, "SELECT * FROM first_load UNION ALL SELECT * FROM recent"),
        "stream_ingest": _with(_AD_EVENTS, f"SELECT {_RAW_COLUMNS}, TRUE AS landed_right FROM ad"),
        "stream_resume": _with(_AD_EVENTS, f"SELECT {_RAW_COLUMNS}, TRUE AS landed_right FROM ad"),
        "stream_upsert": _with(_PROCESSED, "SELECT * FROM processed"),
        "stream_upsert_out_of_order": _with(_CORRECTED, "SELECT * FROM newest"),
        "stream_deduplicated": _with(_AD_EVENTS, f"SELECT {_RAW_COLUMNS}, TRUE AS landed_right FROM ad"),
        "stream_replayed": _with(
            _AD_EVENTS,
            'SELECT run, event_id, uid, (n % 3)::INTEGER AS partition, n // 3 AS "offset", TRUE AS arrived '
            "FROM ad, (VALUES (1), (2)) AS runs (run)",
        ),
        "stream_counters": _with(
            _FEED,
            "SELECT 'ad-' || event_type || 's' AS topic, count(*) AS messages FROM feed "
            "GROUP BY event_type",
        ),
        "stream_relink": _with(
            _FEED,
            "SELECT i.event_id, i.timestamp, i.uid, i.campaign, i.cost, "
            "c.timestamp AS click_timestamp, v.timestamp AS conversion_timestamp, "
            "v.conversion_delay_sec FROM impressions i "
            "LEFT JOIN clicks c USING (event_id) LEFT JOIN conversions v USING (event_id)",
        ),
        "stream_gaps": _with(
            _AD_EVENTS,
            "SELECT event_id, uid, timestamp, timestamp - lag(timestamp) OVER "
            "(PARTITION BY uid ORDER BY timestamp, event_id) AS gap_sec FROM ad",
        ),
        "stream_from_offsets": _with(
            _AD_EVENTS
            + """,
  sent AS (
    SELECT event_id, CAST(n % 3 AS INTEGER) AS kafka_partition, n // 3 AS kafka_offset,
           timestamp < epoch(DATE '2024-01-25') AS early
    FROM ad
  )""",
            "SELECT 'earliest' AS start, event_id, kafka_partition, kafka_offset FROM sent "
            "UNION ALL SELECT 'offsets', event_id, kafka_partition, kafka_offset FROM sent "
            "WHERE kafka_offset >= CASE kafka_partition WHEN 0 THEN 100 WHEN 2 THEN 250 ELSE 0 END "
            "UNION ALL SELECT 'latest', s.event_id, s.kafka_partition, s.kafka_offset FROM sent s JOIN "
            "(SELECT kafka_partition, max(kafka_offset) FILTER (early) AS last FROM sent GROUP BY kafka_partition) e "
            "ON s.kafka_partition = e.kafka_partition AND NOT s.early AND s.kafka_offset > coalesce(e.last, -1)",
        ),
        "stream_gold": _with(_MOVED, _summary(_grouped("moved"))),
        "stream_gold_out_of_order": _with(_MOVED, _summary(_grouped("moved"))),
        "merge_hashed_keys": _with(
            _PROCESSED,
            "SELECT md5(event_id) AS event_id, event_date, uid, campaign, click, conversion, conversion_delay_sec, "
            "CASE WHEN CAST('0x' || substr(md5(event_id), 1, 4) AS INTEGER) % 100 = 0 "
            "THEN round(cost + 1, 4) ELSE cost END AS cost FROM processed",
        ),
        "period_sketches": _with(
            _PROCESSED,
            "SELECT count(*) AS events, CAST(sum(click) AS BIGINT) AS clicks, "
            "CAST(sum(conversion) AS BIGINT) AS conversions, TRUE AS users_near, TRUE AS campaigns_near "
            "FROM processed WHERE event_date BETWEEN '2024-01-10' AND '2024-01-20'",
        ),
        "bronze_to_gold": _with(_PROCESSED, _summary(_grouped("recent"))),
    }
