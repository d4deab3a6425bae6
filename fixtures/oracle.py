"""Reference results as DuckDB SQL over the given tables, one statement per registered query.

None of these statements shares code with the Spark side: they start from ``events`` directly,
without the JSON text, the landing zone or the raw table in between. Where a model uses a window frame
or a rank, its statement uses lists or a count of the rows ahead instead, so that a wrong frame or
rank on one side cannot be repeated on the other.
"""

from __future__ import annotations

FEED = """
WITH src AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
stg AS (
  SELECT
    CAST(event_id AS VARCHAR) AS event_id,
    CASE event_type WHEN 'purchase' THEN 'PushEvent' WHEN 'error' THEN 'IssuesEvent'
      WHEN 'click' THEN 'PullRequestEvent' WHEN 'view' THEN 'WatchEvent'
      WHEN 'signup' THEN 'ForkEvent' END AS event_type,
    user_id AS actor_id,
    'user_' || user_id AS actor_login,
    k % 7 AS repo_id,
    'org/repo_' || (k % 7) AS repo_name,
    ts AS event_timestamp,
    CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS extracted_at,
    'org/repo_' || (k % 7) AS source_repo,
    CASE WHEN event_type = 'purchase' AND k % 10 <> 0 THEN k % 10 END AS push_commit_count,
    CASE WHEN event_type = 'error'
      THEN CASE k % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'reopened' END
      END AS issue_action,
    CASE WHEN event_type = 'click'
      THEN CASE k % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'reopened' END
      END AS pr_action,
    CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS INTEGER) AS is_star_event,
    CAST(ts AS DATE) AS landing_date,
    k
  FROM src
)
"""

# Counters per group. Commits are unknown (NULL) when a group holds only pushes without a size.
_COUNTERS = """
    count(*) AS events,
    count(*) FILTER (event_type = 'PushEvent') AS pushes,
    count(*) FILTER (event_type = 'IssuesEvent') AS issues,
    count(*) FILTER (event_type = 'PullRequestEvent') AS pulls,
    count(*) FILTER (event_type = 'WatchEvent') AS stars,
    count(*) FILTER (event_type = 'ForkEvent') AS forks,
    if(bool_and(event_type = 'PushEvent' AND push_commit_count IS NULL), NULL,
      coalesce(sum(push_commit_count), 0))::BIGINT AS commits"""

DAILY = FEED + f""",
days AS (
  SELECT repo_name, event_timestamp::DATE AS activity_date,
    count(DISTINCT actor_login) AS people, {_COUNTERS}
  FROM stg GROUP BY ALL
),
daily AS (
  SELECT repo_name, activity_date, events AS total_activity, people AS unique_contributors,
    pushes AS push_events, commits AS total_commits, issues AS issue_events, pulls AS pr_events,
    stars AS star_events, forks AS fork_events,
    list_avg(list_slice(list(events) OVER so_far, -7, -1)) AS week_avg
  FROM days WINDOW so_far AS (PARTITION BY repo_name ORDER BY activity_date)
)
"""

TOP = FEED + f""",
pairs AS (
  SELECT actor_login AS contributor, repo_name, count(DISTINCT event_type) AS types,
    min(event_timestamp) AS first_commit, max(event_timestamp) AS final_commit, {_COUNTERS}
  FROM stg GROUP BY ALL
),
ranked AS (
  SELECT contributor, repo_name, events AS total_events, types AS event_types_used,
    pushes AS push_count, commits AS commit_count, issues AS issue_count, pulls AS pr_count,
    first_commit, final_commit,
    (final_commit::DATE - first_commit::DATE)::BIGINT AS active_days,
    (2 * commits + 5 * pulls + issues)::BIGINT AS contribution_score,
    1 + (SELECT count(*) FROM pairs ahead
      WHERE ahead.repo_name = pairs.repo_name AND ahead.events > pairs.events) AS contributor_rank
  FROM pairs
),
top AS (SELECT * FROM ranked WHERE contributor_rank <= 20)
"""

TRENDS = FEED + """,
hourly AS (
  SELECT repo_name, event_type, date_trunc('hour', event_timestamp) AS event_hour,
    count(*) AS event_count, count(DISTINCT actor_login) AS unique_users
  FROM stg GROUP BY ALL
),
trends AS (
  SELECT *, lag(event_count) OVER w AS prev_hour_count,
    event_count - lag(event_count) OVER w AS over_hour_change
  FROM hourly WINDOW w AS (PARTITION BY repo_name, event_type ORDER BY event_hour)
)
"""

# The dirty variant: which records break, by k (see fixtures/envelope.py).
DIRTY = FEED + """,
dirty AS (
  SELECT *, k IN (3, 13, 23, 27, 33, 37, 43, 53, 63, 73) AS broken,
    CASE WHEN k <> 33 THEN event_type END AS dirty_type,
    CASE WHEN k NOT IN (3, 73) THEN actor_login END AS dirty_login,
    CASE WHEN k <> 53 THEN repo_name END AS dirty_repo,
    CASE WHEN k <> 13 THEN event_timestamp END AS dirty_time
  FROM stg
)
"""

# Overlapping pulls: events from 18:00 on arrive twice.
COPIES = FEED + """,
copies AS (
  SELECT stg.* REPLACE (CAST(landing_date + 1 + delay AS TIMESTAMP) AS extracted_at), delay
  FROM stg, (VALUES (0), (1)) AS pulls(delay)
  WHERE delay = 0 OR hour(event_timestamp) >= 18
)
"""

# Text of a landed record, without the fields that are absent.
_RECORD = """'{"id":"' || event_id || '","type":"' || event_type || '","actor":{"id":' || actor_id
  || ',"login":"' || actor_login || '","url":"https://feed.example/u/' || actor_id
  || '"},"repo":{"id":' || repo_id || ',"name":"' || repo_name || '","url":"https://feed.example/r/'
  || repo_id || '"},"created_at":"' || replace(CAST(event_timestamp AS VARCHAR), ' ', 'T')
  || 'Z","payload":' || payload || ',"_extracted_at":"' || replace(CAST(extracted_at AS VARCHAR), ' ', 'T')
  || 'Z","_source_repo":"' || source_repo || '"}'"""

PAYLOAD = FEED + """,
full_rows AS (
  SELECT *, CASE WHEN push_commit_count IS NOT NULL THEN '{"size":' || push_commit_count || '}'
    WHEN coalesce(issue_action, pr_action) IS NOT NULL
      THEN '{"action":"' || coalesce(issue_action, pr_action) || '"}'
    ELSE '{}' END AS payload
  FROM stg
)
"""

_STAGED = """event_id, event_type, actor_id, actor_login, repo_id, repo_name, event_timestamp,
  extracted_at, source_repo, push_commit_count, issue_action, pr_action, is_star_event"""

ORACLE = {
    "stg_events": FEED + f"SELECT {_STAGED} FROM stg",
    "stg_payload": PAYLOAD + "SELECT event_id, payload FROM full_rows",
    "feed_daily_activity": DAILY + "SELECT * FROM daily ORDER BY repo_name, activity_date",
    "daily_activity": DAILY + "SELECT * FROM daily ORDER BY repo_name, activity_date",
    "top_contributors": TOP + "SELECT * FROM top ORDER BY repo_name, contribution_score DESC",
    "event_trends": TRENDS + "SELECT * FROM trends ORDER BY repo_name, event_type, event_hour DESC",
    "repo_health": DAILY + """
SELECT repo_name, activity_date, total_activity, unique_contributors, week_avg,
  (total_activity - week_avg) / week_avg * 100 AS pct_above_avg
FROM daily
WHERE repo_name = 'org/repo_1' AND activity_date >= DATE '2024-01-31' - 30
ORDER BY activity_date DESC""",
    "repo_health_now": DAILY + """
SELECT repo_name, activity_date, total_activity, unique_contributors, week_avg,
  (total_activity - week_avg) / week_avg * 100 AS pct_above_avg
FROM daily WHERE repo_name = 'org/repo_1' AND activity_date >= CURRENT_DATE - 36500
ORDER BY activity_date DESC""",
    "top_contributors_report": TOP + """
SELECT contributor, repo_name, commit_count, pr_count, contribution_score, contributor_rank
FROM top WHERE repo_name = 'org/repo_1' AND contributor_rank <= 10
ORDER BY contribution_score DESC""",
    "trend_anomalies": TRENDS + """
SELECT repo_name, event_type, event_hour, event_count, over_hour_change FROM trends
WHERE abs(over_hour_change) > 1
  AND event_hour >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR
ORDER BY abs(over_hour_change) DESC""",
    "daily_rank": DAILY + """
SELECT activity_date, repo_name, total_activity,
  CAST(rank() OVER (PARTITION BY activity_date ORDER BY total_activity DESC) AS BIGINT)
    AS daily_rank
FROM daily""",
    "commit_velocity": DAILY + """
SELECT repo_name, activity_date, total_commits AS commits, lag(total_commits) OVER w AS prev_commits,
  total_commits - lag(total_commits) OVER w AS commit_change
FROM daily WINDOW w AS (PARTITION BY repo_name ORDER BY activity_date)""",
    "issue_pr_trends": FEED + """
SELECT repo_name, CAST(event_timestamp AS DATE) AS activity_date,
  CASE event_type WHEN 'IssuesEvent' THEN 'issue' ELSE 'pull_request' END AS kind,
  coalesce(issue_action, pr_action) AS action, count(*) AS events
FROM stg WHERE event_type IN ('IssuesEvent', 'PullRequestEvent') GROUP BY ALL""",
    "engagement": DAILY + """
SELECT repo_name, activity_date, star_events AS stars, fork_events AS forks,
  CAST(sum(star_events) OVER w AS BIGINT) AS total_stars,
  CAST(sum(fork_events) OVER w AS BIGINT) AS total_forks
FROM daily WINDOW w AS (PARTITION BY repo_name ORDER BY activity_date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "retention": FEED + """,
weeks AS (
  SELECT DISTINCT repo_name, actor_login,
    CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start FROM stg
)
SELECT a.repo_name, a.week_start, count(*) AS contributors, count(b.actor_login) AS retained,
  count(b.actor_login) / count(*) AS retention_rate
FROM weeks a LEFT JOIN weeks b
  ON b.repo_name = a.repo_name AND b.actor_login = a.actor_login
  AND b.week_start = a.week_start + 7
GROUP BY a.repo_name, a.week_start""",
    "contributor_growth": FEED + """,
periods AS (
  SELECT repo_name, CAST(date_trunc('week', event_timestamp) AS DATE) AS period_start,
    count(DISTINCT actor_login) AS contributors
  FROM stg GROUP BY ALL
)
SELECT *, lag(contributors) OVER w AS prev_contributors,
  (contributors - lag(contributors) OVER w) / lag(contributors) OVER w * 100 AS growth_pct
FROM periods WINDOW w AS (PARTITION BY repo_name ORDER BY period_start)""",
    "validate_events": DIRTY + """
SELECT event_id, event_type, actor_id, actor_login, repo_name, event_timestamp
FROM dirty WHERE NOT broken""",
    "validated_dump": DIRTY + """
SELECT event_type, count(*) AS events, count(*) FILTER (k = 93) AS with_unknown_field
FROM dirty WHERE NOT broken GROUP BY event_type""",
    "validate_summary": DIRTY + """,
tagged AS (
  SELECT unnest(CASE k
    WHEN 3 THEN ['actor.login', 'any'] WHEN 13 THEN ['created_at', 'any']
    WHEN 23 THEN ['id', 'any'] WHEN 27 THEN ['repo.id', 'any'] WHEN 33 THEN ['type', 'any']
    WHEN 37 THEN ['actor.display_login', 'any'] WHEN 43 THEN ['actor.id', 'any']
    WHEN 53 THEN ['repo.name', 'any'] WHEN 63 THEN ['actor.url', 'repo.url', 'any']
    WHEN 73 THEN ['actor.id', 'actor.login', 'actor.url', 'any'] ELSE ['valid'] END) AS reason
  FROM dirty
)
SELECT reason, count(*) FILTER (found) AS records FROM (
  SELECT reason, true AS found FROM tagged
  UNION ALL SELECT unnest(['id', 'type', 'created_at', 'actor.id', 'actor.login',
    'actor.display_login', 'actor.url', 'repo.id', 'repo.name', 'repo.url', 'any', 'valid']), false
) GROUP BY reason""",
    "dq_unique": COPIES + """
SELECT event_id, count(*) AS copies FROM copies GROUP BY event_id HAVING count(*) > 1""",
    "dq_not_null": DIRTY + """,
hours AS (
  SELECT DISTINCT dirty_repo, dirty_type, date_trunc('hour', dirty_time) AS event_hour FROM dirty
),
days AS (SELECT DISTINCT dirty_repo, CAST(dirty_time AS DATE) AS activity_date FROM dirty),
pairs AS (
  SELECT dirty_login, dirty_repo,
    rank() OVER (PARTITION BY dirty_repo ORDER BY count(*) DESC) AS r
  FROM dirty GROUP BY dirty_login, dirty_repo
)
SELECT 'not_null' AS check_name, model, column_name, failures FROM (
  SELECT 'stg_events' AS model, 'event_id' AS column_name,
    count(*) FILTER (event_id IS NULL) AS failures FROM dirty
  UNION ALL SELECT 'stg_events', 'event_type', count(*) FILTER (dirty_type IS NULL) FROM dirty
  UNION ALL SELECT 'stg_events', 'repo_name', count(*) FILTER (dirty_repo IS NULL) FROM dirty
  UNION ALL SELECT 'stg_events', 'event_timestamp', count(*) FILTER (dirty_time IS NULL) FROM dirty
  UNION ALL SELECT 'daily_activity', 'repo_name', count(*) FILTER (dirty_repo IS NULL) FROM days
  UNION ALL SELECT 'daily_activity', 'activity_date',
    count(*) FILTER (activity_date IS NULL) FROM days
  UNION ALL SELECT 'top_contributors', 'contributor',
    count(*) FILTER (dirty_login IS NULL) FROM pairs WHERE r <= 20
  UNION ALL SELECT 'event_trends', 'event_hour', count(*) FILTER (event_hour IS NULL) FROM hours
)""",
    "dq_accepted_values": FEED + """
SELECT event_type, count(*) AS events FROM stg
WHERE event_type NOT IN ('PushEvent', 'IssuesEvent', 'PullRequestEvent', 'WatchEvent')
GROUP BY event_type""",
    "dq_relationships": """
SELECT c_custkey, count(*) AS events FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
GROUP BY c_custkey""",
    "dq_row_count": FEED + """
SELECT CAST(event_timestamp AS DATE) AS activity_date, count(*) AS events,
  CAST(300 AS BIGINT) AS at_least, count(*) >= 300 AS passed
FROM stg GROUP BY ALL""",
    "gate_nonempty": "SELECT count(*) AS event_count, true AS passed FROM events",
    "gate_dq": TRENDS + """
SELECT 'unique' AS check_name, 'stg_events' AS model, 'event_id' AS column_name,
  (SELECT count(*) FROM (SELECT event_id FROM stg GROUP BY event_id HAVING count(*) > 1))
    AS failures
UNION ALL SELECT 'not_null', 'stg_events', 'event_id',
  count(*) FILTER (event_id IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'stg_events', 'event_type',
  count(*) FILTER (event_type IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'stg_events', 'repo_name',
  count(*) FILTER (repo_name IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'stg_events', 'event_timestamp',
  count(*) FILTER (event_timestamp IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'daily_activity', 'repo_name',
  count(*) FILTER (repo_name IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'daily_activity', 'activity_date',
  count(*) FILTER (event_timestamp IS NULL) FROM stg
UNION ALL SELECT 'accepted_values', 'stg_events', 'is_star_event',
  count(*) FILTER (is_star_event NOT IN (0, 1)) FROM stg
UNION ALL SELECT 'row_count', 'daily_activity', 'activity_date',
  if(count(*) = 0, 1, 0)::BIGINT FROM stg
UNION ALL SELECT 'relationships', 'top_contributors', 'repo_name',
  count(*) FILTER (repo_name NOT IN (SELECT repo_name FROM stg)) FROM stg
UNION ALL SELECT 'not_null', 'top_contributors', 'contributor',
  count(*) FILTER (actor_login IS NULL) FROM stg
UNION ALL SELECT 'not_null', 'event_trends', 'event_hour',
  count(*) FILTER (event_hour IS NULL) FROM trends""",
    "ingest_landing": FEED + f"""
SELECT {_STAGED}, CAST(year(landing_date) AS INTEGER) AS year,
  CAST(month(landing_date) AS INTEGER) AS month, CAST(day(landing_date) AS INTEGER) AS day,
  true AS in_own_folder, true AS has_load_time
FROM stg""",
    "ingest_read_back": FEED + f"SELECT {_STAGED} FROM stg",
    "landing_inventory": PAYLOAD + f"""
SELECT landing_date, CAST(sum(strlen({_RECORD}) + 1) AS BIGINT) AS bytes
FROM full_rows GROUP BY landing_date""",
    "ingest_quarantine": FEED + """
SELECT CAST(year(landing_date) AS INTEGER) AS year,
  CAST(month(landing_date) AS INTEGER) AS month, CAST(day(landing_date) AS INTEGER) AS day,
  count(*) FILTER (k <> 13) AS loaded, count(*) FILTER (k = 13) AS quarantined
FROM stg GROUP BY ALL""",
    "ingest_metrics": FEED + """
SELECT 'load-1' AS load_id, count(*) FILTER (k <> 13) AS rows_loaded,
  count(*) FILTER (k = 13) AS rows_quarantined FROM stg""",
    "ingest_incremental": FEED + """
SELECT CASE WHEN landing_date <= DATE '2024-01-03' THEN 1 ELSE 3 END AS run,
  landing_date, count(*) AS events
FROM stg GROUP BY ALL""",
    "ingest_pruned": FEED + f"""
SELECT {_STAGED} FROM stg
WHERE landing_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "ingest_union": FEED + """
SELECT source_repo, event_type, count(*) AS events, sum(actor_id)::BIGINT AS actor_id_sum
FROM stg GROUP BY ALL""",
    "ingest_stamp": FEED + """
SELECT event_id, extracted_at, source_repo FROM stg""",
    "ingest_dedup": COPIES + f"""
SELECT {_STAGED} FROM copies
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY extracted_at DESC) = 1""",
    "ingest_accounting": DIRTY + """,
pulled AS (
  SELECT dirty.*, landing_date + delay AS pull_date, delay, k = 17 AS damaged,
    CASE k WHEN 3 THEN 'actor.login' WHEN 13 THEN 'created_at' WHEN 23 THEN 'id'
      WHEN 27 THEN 'repo.id' WHEN 33 THEN 'type' WHEN 37 THEN 'actor.display_login'
      WHEN 43 THEN 'actor.id' WHEN 53 THEN 'repo.name' WHEN 63 THEN 'actor.url'
      WHEN 73 THEN 'actor.id' END AS reason
  FROM dirty, (VALUES (0), (1)) AS pulls(delay)
  WHERE delay = 0 OR hour(event_timestamp) >= 18
),
fates AS (
  SELECT pull_date, CASE WHEN damaged THEN 'quarantined' WHEN broken THEN 'rejected:' || reason
    WHEN delay < max(delay) OVER (PARTITION BY event_id) THEN 'copies' ELSE 'staged' END AS outcome
  FROM pulled
)
SELECT pull_date AS landing_date, outcome, count(*) AS records FROM fates GROUP BY ALL
UNION ALL SELECT pull_date, 'landed', count(*) FROM fates GROUP BY ALL""",
    "full_build": TOP + """
SELECT 'rows_loaded' AS stage,
  count(*) + count(*) FILTER (hour(event_timestamp) >= 18) AS records FROM stg
UNION ALL SELECT 'rows_quarantined', 0
UNION ALL SELECT 'rows_rejected', 0
UNION ALL SELECT 'stg_events', count(*) FROM stg
UNION ALL SELECT 'daily_activity',
  count(*) FROM (SELECT DISTINCT repo_name, CAST(event_timestamp AS DATE) FROM stg)
UNION ALL SELECT 'top_contributors', count(*) FROM top
UNION ALL SELECT 'event_trends',
  count(*) FROM (SELECT DISTINCT repo_name, event_type, date_trunc('hour', event_timestamp) FROM stg)
UNION ALL SELECT 'checks_passed', 12""",
    "build_materialized": DAILY + "SELECT * FROM daily",
    "build_incremental": DAILY + TOP.removeprefix(FEED) + TRENDS.removeprefix(FEED) + """
SELECT 'daily_activity' AS model, repo_name, CAST(activity_date AS VARCHAR) AS key,
  total_activity AS events, unique_contributors AS people, week_avg AS value FROM daily
UNION ALL SELECT 'event_trends', repo_name, event_type || ' ' || strftime(event_hour, '%Y-%m-%d %H'),
  event_count, unique_users, CAST(over_hour_change AS DOUBLE) FROM trends
UNION ALL SELECT 'top_contributors', repo_name, contributor, total_events, event_types_used,
  CAST(contribution_score AS DOUBLE) FROM top""",
    "ingest_arrays": FEED + """
SELECT landing_date, count(*) AS events, sum(actor_id)::BIGINT AS actor_id_sum, CAST(0 AS BIGINT) AS quarantined
FROM stg GROUP BY landing_date""",
    "ingest_compacted": FEED + """
SELECT landing_date, count(*) AS events, count(DISTINCT event_id) AS event_ids, true AS packed
FROM stg GROUP BY landing_date""",
    "build_insights": FEED + """,
weeks AS (
  SELECT DISTINCT repo_name, actor_login,
    CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start FROM stg
),
periods AS (
  SELECT repo_name, week_start, count(actor_login) AS contributors FROM weeks GROUP BY ALL
)
SELECT 'retention' AS metric, a.repo_name, a.week_start, count(*) AS contributors,
  count(b.actor_login) AS other, true AS estimate_is_near
FROM weeks a LEFT JOIN weeks b ON b.repo_name = a.repo_name AND b.actor_login = a.actor_login
  AND b.week_start = a.week_start + 7
WHERE a.actor_login IS NOT NULL
GROUP BY a.repo_name, a.week_start
UNION ALL
SELECT 'growth', repo_name, week_start, contributors,
  lag(contributors) OVER (PARTITION BY repo_name ORDER BY week_start), true
FROM periods""",
}
