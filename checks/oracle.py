"""The registered queries restated as SQL over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def millis(start: str, end: str) -> str:
    """Whole milliseconds between two times, floored."""
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 1000.0) AS BIGINT)"


LATENCY = f"(SELECT *, {millis('ts', AS_OF)} AS latency_ms FROM events)"


def statistics(value: str, digits: int = 3) -> str:
    return (
        f'count({value}) AS n, min({value}) AS "min", max({value}) AS "max", '
        f'round(avg({value}), {digits}) AS "mean", '
        f'round(stddev_samp({value}), {digits}) AS "stddev"'
    )


QUANTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}


def snapshot(value: str) -> str:
    exact = ", ".join(
        f"round(quantile_cont({value}, {q}), 3) AS {name}" for name, q in QUANTILES.items()
    )
    return f"{statistics(value)}, {exact}"


# Event stream and latency

ORACLE["event_source"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

ORACLE["event_map"] = (
    "SELECT event_id, CAST(round(value * 100) AS BIGINT) AS value_cents FROM events"
)

ORACLE["event_map_pandas"] = ORACLE["event_map"]

ORACLE["event_latency"] = f"SELECT event_id, latency_ms FROM {LATENCY}"

ORACLE["latency_summary"] = f"SELECT {snapshot('latency_ms')} FROM {LATENCY}"

ORACLE["latency_by_client"] = (
    f"SELECT user_id, {snapshot('latency_ms')} FROM {LATENCY} GROUP BY user_id"
)

ORACLE["latency_buckets"] = """
SELECT CAST(floor(value / 10) AS BIGINT) AS bucket,
       CAST(floor(value / 10) * 10 AS DOUBLE) AS lower, count(*) AS n
FROM events GROUP BY 1, 2
"""

ORACLE["latency_tumbling"] = f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period_start, {snapshot('latency_ms')}
FROM {LATENCY} GROUP BY 1
"""



def cumulative(rows: str, step: str, start: str) -> str:
    """Snapshots of all rows up to the end of each period, also of those without a row."""
    quantiles = ", ".join(
        f"round(quantile_cont(latency_ms, {q}), 3) AS {name}" for name, q in QUANTILES.items())
    return f"""
WITH ends AS (SELECT min({start}) AS lo, max({start}) AS hi FROM {rows}),
periods AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL {step})) AS TIMESTAMP) AS period_start FROM ends)
SELECT period_start, {statistics('latency_ms', 2)}, {quantiles}
FROM periods JOIN {rows} ON ts < period_start + INTERVAL {step}
GROUP BY period_start
"""


ORACLE["latency_cumulative"] = cumulative(LATENCY, "1 DAY", "CAST(date_trunc('day', ts) AS TIMESTAMP)")

WORKING = f"(SELECT * FROM {LATENCY} WHERE isodow(ts) < 6)"
QUARTER = "time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')"

ORACLE["quiet_cumulative"] = cumulative(WORKING, "6 HOURS", QUARTER)

ORACLE["quiet_tumbling"] = f"""
WITH ends AS (SELECT min({QUARTER}) AS lo, max({QUARTER}) AS hi FROM {WORKING}),
periods AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 6 HOURS)) AS TIMESTAMP) AS period_start FROM ends)
SELECT period_start, {snapshot('latency_ms')}
FROM periods LEFT JOIN {WORKING} ON {QUARTER} = period_start
GROUP BY period_start
"""

DECAY = f"""
    SELECT event_type, value,
           exp(-0.015 * (epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts)) / 3600000000.0) AS w
    FROM events
"""

ORACLE["latency_decayed"] = f"""
WITH weighted AS ({DECAY}),
sums AS (
    SELECT event_type, sum(w) AS weight, sum(w * value) / sum(w) AS mean
    FROM weighted GROUP BY event_type
)
SELECT event_type, round(weight, 6) AS weight, round(mean, 6) AS "mean",
       round(sqrt(sum(w * (value - mean) * (value - mean)) / weight), 6) AS "stddev"
FROM weighted JOIN sums USING (event_type)
GROUP BY event_type, weight, mean
"""

ORACLE["latency_decayed_quantile"] = f"""
WITH weighted AS ({DECAY}),
buckets AS (
    SELECT event_type, CAST(floor(value / 10) AS BIGINT) AS bucket, sum(w) AS w
    FROM weighted GROUP BY 1, 2
),
upto AS (
    SELECT event_type, bucket,
           sum(w) OVER (PARTITION BY event_type ORDER BY bucket) AS upto,
           sum(w) OVER (PARTITION BY event_type) AS total
    FROM buckets
)
SELECT event_type, min(bucket) AS bucket, CAST(min(bucket) * 10 AS DOUBLE) AS lower
FROM upto WHERE upto >= 0.5 * total GROUP BY event_type
"""

RESERVOIR = f"""
random AS (
    SELECT event_type, event_id, ts, value,
           (CAST('0x' || substring(md5(CAST(event_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u,
           0.015 * {millis('ts', 'max(ts) OVER (PARTITION BY event_type)')} / 3600000.0 AS age
    FROM events
),
sample AS (
    SELECT event_type, event_id, ts, value, exp(-age) AS weight FROM random
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ln(-ln(u)) + age, event_id) <= 1028
)
"""

ORACLE["decaying_reservoir"] = (
    f"WITH {RESERVOIR} SELECT * REPLACE (round(weight, 6) AS weight) FROM sample")

ORACLE["reservoir_snapshot"] = f"""
WITH {RESERVOIR},
shares AS (
    SELECT *, weight / sum(weight) OVER (PARTITION BY event_type) AS share FROM sample
),
upto AS (
    SELECT *, coalesce(sum(share) OVER (PARTITION BY event_type ORDER BY value, event_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(share * value) OVER (PARTITION BY event_type) AS centre
    FROM shares
)
SELECT event_type, count(value) AS n, min(value) AS "min", max(value) AS "max",
       round(any_value(centre), 6) AS "mean", round(sqrt(sum(share * (value - centre) ** 2)), 6) AS "stddev",
       {', '.join(f"max(value) FILTER (before <= {q}) AS {name}" for name, q in QUANTILES.items())}
FROM upto GROUP BY event_type
"""

def replayed(condition: str = "") -> str:
    """The summary of days from order to shipment, of those that meet a condition."""
    return f"""
WITH days AS (
    SELECT o_orderpriority,
           date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey {condition}
)
SELECT o_orderpriority, count(days) AS n, CAST(min(days) AS INTEGER) AS "min",
       CAST(max(days) AS INTEGER) AS "max", round(avg(days), 3) AS "mean",
       round(stddev_samp(days), 3) AS "stddev",
       {', '.join(f"round(quantile_cont(days, {q}), 3) AS {n}" for n, q in QUANTILES.items())},
       CAST(sum(CASE WHEN days < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative
FROM days GROUP BY o_orderpriority
"""


ORACLE["replay_latency"] = replayed()

ORACLE["stream_replay_latency"] = replayed(
    "AND l_shipdate >= o_orderdate - INTERVAL 30 DAY AND l_shipdate <= o_orderdate + INTERVAL 120 DAY")

ORACLE["keyed_lanes"] = """
SELECT user_id % 10 AS lane, count(*) AS n, count(DISTINCT user_id) AS n_keys
FROM events GROUP BY 1
"""

ORACLE["event_distinct"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
UNION
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id % 10 = 0
"""

# Counting

ORACLE["total_count"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"

ORACLE["running_count"] = (
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS running_count FROM events"
)

ORACLE["count_reconcile"] = """
WITH want AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
have AS (
    SELECT source, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY source
)
SELECT coalesce(want.source, have.source) AS source, coalesce(want.n, 0) AS expected,
       coalesce(have.n, 0) AS actual, coalesce(want.n, 0) - coalesce(have.n, 0) AS lost
FROM want FULL OUTER JOIN have ON want.source = have.source
"""

# Bounded buffer: each side numbered on its own, then joined on the number

SIDES = """
puts AS (
    SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
    FROM events WHERE event_type = 'view'
),
gets AS (
    SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
    FROM events WHERE event_type = 'click'
)
"""

ORACLE["fifo_match"] = f"""
WITH {SIDES}
SELECT user_id, n, puts.event_id AS put_id, puts.ts AS put_ts,
       gets.event_id AS get_id, gets.ts AS get_ts
FROM puts JOIN gets USING (user_id, n)
"""

ORACLE["buffer_wait"] = f"""
WITH {SIDES}
SELECT user_id, n, greatest(puts.ts, gets.ts) AS completed_at,
       greatest(0, {millis('gets.ts', 'puts.ts')}) AS consumer_wait_ms,
       greatest(0, {millis('puts.ts', 'gets.ts')}) AS dwell_ms
FROM puts JOIN gets USING (user_id, n)
"""

STATE = """
ahead AS (
    SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'put' ELSE 'get' END AS op,
           sum(CASE event_type WHEN 'view' THEN 1 ELSE -1 END)
               OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d
    FROM events WHERE event_type IN ('view', 'click')
),
state AS (
    SELECT event_id, user_id, op,
           CAST(least(3, greatest(0, d)) AS BIGINT) AS stored,
           CAST(greatest(0, d - 3) AS BIGINT) AS blocked_producers,
           CAST(greatest(0, -d) AS BIGINT) AS waiting_consumers
    FROM ahead
)
"""

ORACLE["buffer_state"] = f"WITH {STATE} SELECT * FROM state"

ORACLE["blocked_puts"] = f"""
WITH {SIDES},
timed AS (
    SELECT puts.user_id, puts.n, puts.event_id AS put_id, puts.ts AS put_ts,
           CASE WHEN puts.n <= 3 THEN puts.ts
                WHEN gets.ts IS NULL THEN NULL
                ELSE greatest(puts.ts, gets.ts) END AS admitted_at
    FROM puts LEFT JOIN gets ON puts.user_id = gets.user_id AND gets.n = puts.n - 3
)
SELECT user_id, n, put_id, put_ts, admitted_at, {millis('put_ts', 'admitted_at')} AS blocked_ms
FROM timed
"""

ORACLE["buffer_saturation"] = f"""
WITH {STATE}
SELECT user_id, count(*) AS n,
       round(avg(CASE WHEN stored = 3 THEN 1.0 ELSE 0.0 END), 6) AS full_share,
       round(avg(CASE WHEN stored = 0 THEN 1.0 ELSE 0.0 END), 6) AS empty_share,
       round(avg(CASE WHEN blocked_producers > 0 THEN 1.0 ELSE 0.0 END), 6) AS blocked_share,
       max(stored) AS peak_stored
FROM state GROUP BY user_id
"""

ORACLE["buffer_leftover"] = """
WITH totals AS (
    SELECT user_id, count(*) FILTER (event_type = 'view') AS puts,
           count(*) FILTER (event_type = 'click') AS gets
    FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id
)
SELECT user_id, puts, gets, least(3, greatest(0, puts - gets)) AS "left",
       greatest(0, puts - gets - 3) AS still_blocked, greatest(0, gets - puts) AS still_waiting
FROM totals
"""

# Allocation of limited stock

REQUESTS = """
requests AS (
    SELECT event_id, ts, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY day ORDER BY ts, event_id) AS turn,
           row_number() OVER (ORDER BY ts, event_id) AS place
    FROM requests
)
"""

ORACLE["allocate_fcfs"] = (
    f"WITH {REQUESTS} SELECT event_id, day, turn <= 50 AS granted FROM ranked"
)

ORACLE["granted_requests"] = (
    f"WITH {REQUESTS} SELECT event_id, day, turn FROM ranked WHERE turn <= 50"
)

ORACLE["allocate_quantity"] = f"""
WITH {REQUESTS},
demand AS (
    SELECT event_id, day, event_id % 3 + 1 AS requested,
           sum(event_id % 3 + 1) OVER (PARTITION BY day ORDER BY ts, event_id) AS upto
    FROM requests
)
SELECT event_id, day, CAST(requested AS BIGINT) AS requested,
       CAST(least(requested, greatest(0, 100 - (upto - requested))) AS BIGINT) AS granted
FROM demand
"""

ORACLE["assign_round_robin"] = (
    f"WITH {REQUESTS} SELECT event_id, (place - 1) % 10 AS seller FROM ranked"
)

ORACLE["sales_tally"] = f"""
WITH {REQUESTS}
SELECT (place - 1) % 10 AS seller, count(*) AS n_sold FROM ranked GROUP BY 1
"""

AUDIT = """
sold AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey),
audit AS (
    SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, coalesce(n, 0) AS n_sold,
           CASE WHEN o_orderkey IS NULL THEN 'unknown' WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'once'
                ELSE 'duplicate' END AS status
    FROM orders FULL JOIN sold ON o_orderkey = l_orderkey
)
"""

ORACLE["exactly_once_audit"] = f"WITH {AUDIT} SELECT * FROM audit"

ORACLE["audit_summary"] = (
    f"WITH {AUDIT} SELECT status, count(*) AS n_items FROM audit GROUP BY status"
)

# Threshold triggers

COUNTED = """
counted AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
)
"""

ORACLE["nth_event"] = f"WITH {COUNTED} SELECT * EXCLUDE (rn) FROM counted WHERE rn = 5"

ORACLE["threshold_gate"] = f"WITH {COUNTED} SELECT * EXCLUDE (rn) FROM counted WHERE rn >= 5"

ORACLE["gate_delay"] = f"""
WITH {COUNTED},
reached AS (
    SELECT user_id, min(ts) AS first_ts, max(ts) FILTER (rn = 5) AS reached_ts
    FROM counted GROUP BY user_id
)
SELECT *, {millis('first_ts', 'reached_ts')} AS delay_ms FROM reached
"""

# Lock order, fair turns, latest value

EDGES = """
steps AS (
    SELECT event_type AS wanted,
           lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS held
    FROM events
),
edges AS (
    SELECT held, wanted, count(*) AS n FROM steps
    WHERE held IS NOT NULL AND held <> wanted GROUP BY held, wanted
)
"""

ORACLE["lock_order_edges"] = f"WITH {EDGES} SELECT * FROM edges"

ORACLE["lock_order_inversion"] = f"""
WITH {EDGES}
SELECT a.held AS "first", a.wanted AS "second", a.n AS n_forward, b.n AS n_backward
FROM edges a JOIN edges b ON a.held = b.wanted AND a.wanted = b.held AND a.held < a.wanted
"""

ORACLE["lock_order_cycles"] = """
WITH RECURSIVE steps AS (
    SELECT event_type || '-' || (user_id % 4) AS wanted,
           lag(event_type || '-' || (user_id % 4)) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS held
    FROM events
),
edges AS (
    SELECT held, wanted FROM steps WHERE held IS NOT NULL AND held <> wanted
    GROUP BY held, wanted HAVING held < wanted OR count(*) % 5 = 0
),
reach AS (
    SELECT held AS a, wanted AS b FROM edges
    UNION SELECT reach.a, edges.wanted FROM reach JOIN edges ON reach.b = edges.held
)
SELECT r.a AS resource, max(r.b) AS cycle, count(*) AS size
FROM reach r JOIN reach s ON r.a = s.b AND r.b = s.a GROUP BY r.a
"""

TURNS = "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM documents"

ORACLE["fair_interleave"] = TURNS

ORACLE["fair_quota"] = f"SELECT * FROM ({TURNS}) WHERE turn <= 10"

ORACLE["latest_per_key"] = f"""
WITH latest AS (
    SELECT user_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT c_custkey, coalesce(event_type, 'unset') AS value, event_type IS NULL AS defaulted
FROM customer LEFT JOIN latest ON c_custkey = user_id
"""

# Measures and stages

ORACLE["stacked_adjustment"] = """
SELECT p_type, count(*) AS n, round(sum(p_retailprice), 2) AS base_total,
       round(sum(p_retailprice + 2), 2) AS adjusted_total, CAST(count(*) * 5 AS BIGINT) AS second_total
FROM part GROUP BY p_type
"""

ORACLE["instrumented_stage"] = """
SELECT event_type, count(*) AS rows_before, count(*) FILTER (value > 10) AS rows_after
FROM events GROUP BY event_type
"""

ORACLE["observed_stage"] = "SELECT count(*) AS rows_before, count(*) FILTER (value > 10) AS rows_after FROM events"

# Request routing

ROUTED = """
requests AS (
    SELECT event_id, user_id, CASE WHEN event_id % 97 <> 0 THEN event_type END AS service,
           CASE WHEN event_id % 11 = 0 THEN 'part' ELSE 'greet' END AS method,
           CASE WHEN event_id % 13 = 0 THEN 'string,int' ELSE 'string' END AS types
    FROM events
),
services AS (
    SELECT * FROM (VALUES ('click', 'ClickImpl', ''), ('view', 'ViewImpl', ', have a look'),
                          ('purchase', 'PurchaseImpl', ', thank you')) AS s(service, name, more)
),
looked_up AS (
    SELECT requests.*, name, more,
           name IS NOT NULL AND method = 'greet'
               AND (types = 'string' OR requests.service = 'purchase') AS found
    FROM requests LEFT JOIN services USING (service)
),
routed AS (
    SELECT event_id, user_id, service, method, CASE WHEN found THEN name END AS impl,
           CASE WHEN found THEN 'hello ' || CAST(user_id AS VARCHAR) || more END AS result,
           CASE WHEN found THEN NULL
                WHEN name IS NULL THEN coalesce(service, 'null') || ' not found'
                ELSE service || '.' || method || '(' || types || ') not found' END AS error
    FROM looked_up
)
"""

ORACLE["route_requests"] = f"WITH {ROUTED} SELECT * FROM routed"

ORACLE["route_requests_as_of"] = """
WITH requests AS (
    SELECT event_id, user_id, ts, CASE WHEN event_id % 97 <> 0 THEN event_type END AS service,
           CASE WHEN event_id % 11 = 0 THEN 'part' ELSE 'greet' END AS method,
           CASE WHEN event_id % 13 = 0 THEN 'string,int' ELSE 'string' END AS types
    FROM events
),
registered AS (
    SELECT service, TIMESTAMP '2024-01-03 12:00:00' + INTERVAL (5 * (seq - 1)) DAY AS at, name, methods, answer
    FROM (VALUES ('click', 1, 'ClickImpl', ['greet(string)'], 'hello %s'),
                 ('view', 2, 'OldViewImpl', ['greet(string)', 'part(string)'], 'wait'),
                 ('view', 3, 'ViewImpl', ['greet(string)'], 'hello %s, have a look'),
                 ('purchase', 4, 'PurchaseImpl', ['greet(string)', 'greet(string,int)'], 'hello %s, thank you')
    ) AS r(service, seq, name, methods, answer)
),
looked_up AS (
    SELECT q.*, name, answer, coalesce(list_contains(methods, method || '(' || types || ')'), false) AS found
    FROM requests q ASOF LEFT JOIN registered r ON q.service = r.service AND q.ts >= r.at
)
SELECT event_id, user_id, service, method, CASE WHEN found THEN name END AS impl,
       CASE WHEN found THEN replace(answer, '%s', CAST(user_id AS VARCHAR)) END AS result,
       CASE WHEN found THEN NULL
            WHEN name IS NULL THEN coalesce(service, 'null') || ' not found'
            ELSE service || '.' || method || '(' || types || ') not found' END AS error
FROM looked_up
"""

ORACLE["dead_letters"] = (
    f"WITH {ROUTED} SELECT event_id, service, method, error FROM routed WHERE impl IS NULL"
)

ORACLE["dispatch_summary"] = f"""
WITH {ROUTED}
SELECT service, impl, count(*) AS n_requests, count(DISTINCT user_id) AS n_callers,
       count(error) AS n_failed
FROM routed GROUP BY service, impl
"""

# Addresses and storage


def quoted(path: str) -> str:
    """Every printable ASCII character that a path may not hold, as its code in hex."""
    may = "[A-Za-z0-9/._~!$&()*+,;=:@-]"
    return (f"array_to_string(list_transform(string_split({path}, ''), lambda c: CASE WHEN "
            f"regexp_matches(c, '^{may}$') OR c = chr(39) OR unicode(c) NOT BETWEEN 32 AND 126 "
            "THEN c ELSE '%' || upper(hex(c)) END), '')")


PATH = "regexp_replace(url, '^(?:[^:/]+:)?//[^/]*', '')"

SPLIT = f"""
split AS (
    SELECT page_id, nullif(regexp_extract(url, '^([^:/]+):/', 1), '') AS scheme,
           nullif(regexp_extract(url, '^(?:[^:/]+:)?//([^/]*)', 1), '') AS authority,
           {PATH} AS path, {quoted(PATH)} AS path_quoted
    FROM pages
)
"""

ORACLE["uri_split"] = f"WITH {SPLIT} SELECT * FROM split"

ORACLE["authority_rollup"] = (
    f"WITH {SPLIT} SELECT scheme, authority, count(*) AS n FROM split GROUP BY scheme, authority"
)

ORACLE["scheme_route"] = f"""
WITH {SPLIT}
SELECT page_id, scheme,
       CASE scheme WHEN 'https' THEN 'WebFileSystem' WHEN 'file' THEN 'LocalFileSystem'
                   WHEN 'hdfs' THEN 'DistributedFileSystem' END AS file_system
FROM split
"""

ORACLE["load_uri"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"

ORACLE["clean_container_path"] = (
    "SELECT page_id, regexp_replace(url || '!/x', '!.*$', '') AS container FROM pages"
)

# Logs

LOGS = """
logs AS (
    SELECT event_id, ts, event_type AS logger, props AS message,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG'
                ELSE 'INFO' END AS level,
           CAST(event_id % 100 AS INTEGER) AS line
    FROM events
)
"""
TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')"
STDOUT_LINE = f"{TIME} || ' ' || rpad(level, 5, ' ') || ' [' || logger || '] - ' || message"
FILE_LINE = (
    f"'[' || {TIME} || '] ' || rpad(level, 5, ' ') || ' [' || logger || ':' || "
    "CAST(line AS VARCHAR) || '] - ' || message"
)

ORACLE["log_render"] = f"""
WITH {LOGS} SELECT event_id, {STDOUT_LINE} AS stdout_line, {FILE_LINE} AS file_line FROM logs
"""

ORACLE["log_parse"] = f"""
WITH {LOGS}
SELECT event_id, date_trunc('milliseconds', ts) AS ts, level, logger, line, message,
       {FILE_LINE} AS raw
FROM logs
"""

ORACLE["log_level_filter"] = f"""
WITH {LOGS} SELECT event_id, level, logger FROM logs WHERE level IN ('INFO', 'WARN', 'ERROR')
"""

ORACLE["log_daily_roll"] = f"""
WITH {LOGS} SELECT CAST(ts AS DATE) AS log_date, {FILE_LINE} AS text FROM logs
"""

ORACLE["log_level_daily"] = f"""
WITH {LOGS} SELECT CAST(ts AS DATE) AS log_date, level, count(*) AS n FROM logs GROUP BY 1, 2
"""

# Structured Streaming

ORACLE["stream_events"] = ORACLE["event_source"]

ORACLE["stream_latency"] = "SELECT event_id, true AS in_range FROM events"

ORACLE["stream_latency_tumbling"] = f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period_start, {snapshot('latency_ms')}
FROM {LATENCY} WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events)
GROUP BY 1
"""

ORACLE["stream_counts"] = "SELECT user_id, count(*) AS n FROM events GROUP BY user_id"

ORACLE["stream_distinct"] = ORACLE["event_source"]

ORACLE["stream_nth_event"] = (
    f"WITH {COUNTED} SELECT user_id, ts, event_id FROM counted WHERE rn = 5"
)

# A day of views and clicks is closed once an hour has passed after it.
CLOSED = """
WITH closed AS (
    SELECT * FROM events WHERE event_type IN ('view', 'click')
    AND CAST(ts AS DATE) + INTERVAL 1 DAY < (
        SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_type IN ('view', 'click'))
),
"""

ORACLE.update({f"stream_{name}": CLOSED + ORACLE[name].strip().removeprefix("WITH").replace("FROM events", "FROM closed")
               for name in ("buffer_state", "blocked_puts")})

ORACLE["stream_latest_per_key"] = ORACLE["latest_per_key"]

ORACLE["stream_routing"] = ORACLE["route_requests"]

ORACLE["stream_log_etl"] = f"""
WITH {LOGS}
SELECT CAST(ts AS DATE) AS log_date, level, count(*) AS n FROM logs
WHERE level IN ('INFO', 'WARN', 'ERROR') GROUP BY 1, 2
UNION ALL SELECT NULL, NULL, count(*) FROM events WHERE event_type = 'error'
"""

ORACLE["load_uri_events"] = ORACLE["event_source"]

ORACLE["periodic_report"] = ORACLE["latency_summary"]

ORACLE["storage_report"] = " UNION ALL ".join(
    f"SELECT '{name}.parquet' AS dataset, CAST(1 AS BIGINT) AS files, count(*) AS n_rows FROM {name}"
    for name in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations"))

ORACLE.update({f"hot_{name}": ORACLE[name] for name in (
    "latency_by_client", "latency_tumbling", "buffer_state", "fifo_match", "lock_order_edges")})
