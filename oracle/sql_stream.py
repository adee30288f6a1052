"""Batch-mode oracle SQL for the streaming keys that have one (SS2 to SS5)."""

from oracle.catalog_sql import SQL

# a request is answered anew at the first event at least one hour after its key's last answer
ANSWERED = """
WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS ts, value FROM events),
a AS (SELECT user_id, event_type, min(ts) AS ts FROM e GROUP BY ALL
  UNION ALL SELECT a.user_id, a.event_type, min(e.ts) AS ts FROM a JOIN e ON e.user_id IS NOT DISTINCT FROM a.user_id
    AND e.event_type IS NOT DISTINCT FROM a.event_type AND e.ts >= a.ts + INTERVAL 1 HOUR GROUP BY ALL),
answered AS (SELECT a.user_id, a.event_type, a.ts, min(e.event_id) AS event_id FROM a JOIN e ON e.user_id IS NOT DISTINCT FROM a.user_id
  AND e.event_type IS NOT DISTINCT FROM a.event_type AND e.ts = a.ts GROUP BY ALL)"""

SQL["SS2_stream_dedupe_ttl"] = ANSWERED + """
SELECT sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') AS request_key, user_id, event_type, event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM answered"""

SQL["SS3_stream_window_stats"] = ANSWERED + """,
w AS (SELECT date_trunc('day', e.ts) AS ws, count(*) AS total, count_if(x.event_id IS NOT NULL) AS misses,
        count_if(e.event_type = 'error') AS errors, CAST(sum(CAST(e.value AS DECIMAL(20, 6))) AS DOUBLE) / NULLIF(count(e.value), 0) AS mean_value
      FROM e LEFT JOIN answered x ON x.event_id = e.event_id GROUP BY 1)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
  total, CAST(total - misses AS BIGINT) AS hits, CAST(misses AS BIGINT) AS misses, CAST(total - misses AS DOUBLE) / total AS hit_rate,
  CAST(errors AS BIGINT) AS errors, CAST(errors AS DOUBLE) / total AS error_rate, mean_value
FROM w"""

SQL["SS5_stream_running_totals"] = """
SELECT l_suppkey AS team_id, CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(count_if(l_returnflag <> 'R') AS BIGINT) AS wins, count(*) AS games,
  CAST(count_if(l_returnflag <> 'R') AS DOUBLE) / count(*) * 162 AS pace_wins
FROM lineitem GROUP BY 1, 2"""

# members: smoothed error rates by one feature, fitted on slice 0; weights before batch b from cross-validation (b = 0)
# or from the scores of the last five batches before it
_SS4_MEMBERS = ("hour", "user_id", "k")
_SS4_FEATURE = " UNION ALL ".join(f"SELECT event_id, slice, label, '{m}' AS model, {m} AS v FROM s" for m in _SS4_MEMBERS)
SQL["SS4_stream_ensemble_weights"] = f"""
WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, hour(CAST(ts AS TIMESTAMP))::BIGINT AS hour, user_id,
    CAST(trunc(CAST(props->>'$.k' AS DOUBLE)) AS BIGINT) AS k, CAST(event_type = 'error' AS BIGINT) AS label
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL),
s AS MATERIALIZED (SELECT *, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM e)) * 8
    // ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM e) + 1) AS slice FROM e),
x AS MATERIALIZED ({_SS4_FEATURE}),
base AS (SELECT avg(label) AS b FROM s WHERE slice = 0),
rate AS (SELECT model, v, (sum(label) + 20.0 * (SELECT b FROM base)) / (count(*) + 20.0) AS r FROM x WHERE slice = 0 AND v IS NOT NULL GROUP BY ALL),
folds AS (SELECT f, avg(label) FILTER (event_id % 5 <> f) AS b FROM s, range(5) t(f) WHERE slice = 0 GROUP BY f),
frate AS (SELECT f, model, v, (sum(label) FILTER (event_id % 5 <> f) + 20.0 * any_value(b)) / (count(*) FILTER (event_id % 5 <> f) + 20.0) AS r
  FROM x JOIN folds ON true WHERE slice = 0 AND v IS NOT NULL GROUP BY ALL HAVING count(*) FILTER (event_id % 5 <> f) > 0),
cv AS (SELECT x.model, avg(CAST(CAST(coalesce(r, b) >= b AS BIGINT) = label AS DOUBLE)) AS score FROM x JOIN folds ON folds.f = x.event_id % 5
  LEFT JOIN frate ON frate.f = folds.f AND frate.model = x.model AND frate.v = x.v WHERE slice = 0 GROUP BY 1),
p AS MATERIALIZED (SELECT x.event_id, x.slice - 1 AS batch_id, x.label, x.model, coalesce(r, (SELECT b FROM base)) AS p
  FROM x LEFT JOIN rate ON rate.model = x.model AND rate.v = x.v WHERE slice > 0),
sc AS (SELECT batch_id, model, avg(CAST(CAST(p >= (SELECT b FROM base) AS BIGINT) = label AS DOUBLE)) AS score, count(*) AS n_events,
  avg(p) AS mean_member, avg(label) AS error_rate FROM p GROUP BY ALL),
h AS (SELECT a.batch_id, a.model, b.score, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY a.batch_id, a.model) AS n
  FROM sc a JOIN sc b ON a.model = b.model AND b.batch_id BETWEEN a.batch_id - 4 AND a.batch_id
  WINDOW w AS (PARTITION BY a.batch_id, a.model ORDER BY b.batch_id)),
raw AS (SELECT batch_id, model, greatest(0.1, sum(score * exp(-1 + CASE WHEN n > 1 THEN i / (n - 1.0) ELSE 0 END))
    / sum(exp(-1 + CASE WHEN n > 1 THEN i / (n - 1.0) ELSE 0 END))) AS s FROM h GROUP BY ALL
  UNION ALL SELECT -1, model, greatest(0.1, score) FROM cv),
wt AS (SELECT batch_id, model, s / sum(s) OVER (PARTITION BY batch_id) AS w FROM raw)
SELECT sc.batch_id, sc.model, n_events, sc.score, u.w AS weight_used, n.w AS weight_next,
  sum(u.w * mean_member) OVER (PARTITION BY sc.batch_id) AS mean_p, error_rate, n.w / u.w AS weight_change
FROM sc JOIN wt u ON u.batch_id = sc.batch_id - 1 AND u.model = sc.model JOIN wt n ON n.batch_id = sc.batch_id AND n.model = sc.model"""
