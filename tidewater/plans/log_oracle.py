"""DuckDB oracle SQL of the streams over a record log."""

from tidewater.plans.kafka_oracle import POLICY_SQL

#: Retained records; the log's first part, its bounds and the group's commits in it.
_LOG = """
rec AS (
  SELECT 'events' AS topic, CAST(event_id % 8 AS INTEGER) AS "partition",
         CAST(event_id // 8 AS BIGINT) AS "offset"
  FROM events WHERE event_id % 2 = 1 OR event_id // 8 >= 10
),
cuts AS (SELECT topic, "partition", (max("offset") + 1) * 3 // 4 AS cut FROM rec GROUP BY ALL),
bounds AS (
  SELECT topic, "partition", min("offset") AS earliest, max("offset") + 1 AS latest
  FROM rec JOIN cuts USING (topic, "partition") WHERE "offset" < cut GROUP BY ALL
),
commits AS (
  SELECT topic, "partition", earliest, latest,
         CASE WHEN {commits} THEN CASE "partition" % 8
              WHEN 1 THEN (earliest + latest) // 2 WHEN 2 THEN earliest - 1
              WHEN 3 THEN latest + 5 WHEN 4 THEN earliest WHEN 5 THEN latest
              WHEN 7 THEN earliest + 1 END END AS committed
  FROM bounds
),
starts AS (SELECT topic, "partition", {policy} AS start_offset FROM commits)"""


def _started(policy: str, commits: bool = True) -> str:
    return f"""
WITH {_LOG.format(commits="true" if commits else "false", policy=POLICY_SQL[policy])}
SELECT topic, "partition", min("offset") AS first_offset, max("offset") + 1 AS until_offset,
       count(*) AS records
FROM rec LEFT JOIN starts USING (topic, "partition")
WHERE "offset" >= coalesce(start_offset, 0) GROUP BY ALL"""


ORACLE = {**{f"stream_started_{p}": _started(p) for p in POLICY_SQL},
          "stream_started_group_first_use": _started("group", commits=False)}
