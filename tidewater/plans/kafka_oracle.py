"""DuckDB oracle SQL of the Kafka-side queries."""

RECORDS = """
rec AS (
  SELECT 'events' AS topic, CAST(event_id % 8 AS INTEGER) AS "partition",
         CAST(event_id // 8 AS BIGINT) AS "offset", event_id, user_id, props
  FROM events
),
bounds AS (
  SELECT topic, "partition",
         CAST(min(CASE WHEN "partition" % 2 = 0 THEN greatest("offset", 10) ELSE "offset" END) AS BIGINT) AS earliest,
         CAST(max("offset") + 1 AS BIGINT) AS latest
  FROM rec GROUP BY topic, "partition"
),
commits AS (
  SELECT topic, "partition", earliest, latest,
         CAST(CASE "partition" % 8 WHEN 1 THEN (earliest + latest) // 2 WHEN 2 THEN earliest - 1
              WHEN 3 THEN latest + 5 WHEN 4 THEN earliest WHEN 5 THEN latest
              WHEN 7 THEN earliest + 1 END AS BIGINT) AS committed
  FROM bounds
)"""

POLICY_SQL = {
    "zero": "coalesce(committed, 0)",
    "latest": "CASE WHEN committed IS NULL THEN 0 ELSE latest END",
    "resume_latest": ("CASE WHEN committed IS NULL THEN earliest "
                      "WHEN committed < earliest OR committed > latest THEN latest ELSE committed END"),
    "group": ("CASE WHEN (SELECT count(committed) FROM commits) = 0 THEN 0 "
              "WHEN committed IS NULL THEN earliest "
              "WHEN committed < earliest OR committed > latest THEN latest ELSE committed END"),
    "group_latest": ("CASE WHEN (SELECT count(committed) FROM commits) = 0 THEN 0 "
                     "WHEN committed IS NULL THEN earliest ELSE latest END"),
    "resume_earliest": "CASE WHEN committed IS NULL THEN earliest ELSE greatest(committed, earliest) END",
}

ORACLE = {
    **{f"start_offsets_{p}": f"""
WITH {RECORDS}
SELECT topic, "partition", committed, earliest, latest, CAST({expr} AS BIGINT) AS start_offset
FROM commits""" for p, expr in POLICY_SQL.items()},

    "batch_progress": f"""
WITH {RECORDS}
SELECT CAST("offset" // 250 AS BIGINT) AS batch_id, topic, "partition",
       min("offset") AS from_offset, max("offset") + 1 AS until_offset, count(*) AS records
FROM rec GROUP BY ALL""",

    "decode_text_json": f"""
WITH {RECORDS}
SELECT topic, "partition", "offset", CAST(user_id AS VARCHAR) AS key, props AS value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM rec""",

    "decode_rejects": f"""
WITH {RECORDS}
SELECT 'json' AS format, topic, "partition", "offset",
       CASE WHEN event_id % 89 = 0 THEN 'null_value' ELSE 'bad_json' END AS reason
FROM rec WHERE event_id % 89 = 0 OR event_id % 83 = 1
UNION ALL
SELECT 'registry', topic, "partition", "offset", 'bad_magic' FROM rec WHERE event_id % 97 = 0""",

    "decode_bytes_header": f"""
WITH {RECORDS}
SELECT topic, "partition", "offset",
       CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS magic,
       CAST(16909060 + user_id AS BIGINT) AS schema_id,
       CASE WHEN event_id % 97 = 0 THEN 'bad_magic' ELSE 'ok' END AS status,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE octet_length(encode(props)) END AS body_bytes,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE props END AS body_text
FROM rec""",
}
