"""Views of the supplied tables as log lines, telemetry, events, matrices and documents.

Each view exists twice, for Spark and as SQL, and is computed from whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.ordering import with_line_numbers

KEY = b"registered-queries-demo-key"
# results are compared at six digits; the cut lies off the middle, where exact ties fall
TIE = 0.5001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round6(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value.cast("double") * 1e6 + TIE).cast("double") / 1e6


def sql6(value: str) -> str:
    return f"floor(CAST({value} AS DOUBLE) * 1e6 + {TIE}) / 1e6"


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# --- telemetry ------------------------------------------------------------------------------


def telemetry(spark, sf_dir) -> DataFrame:
    return telemetry_view(events(spark, sf_dir))


def telemetry_view(e: DataFrame) -> DataFrame:
    kind = "CASE WHEN event_type IN ('signup','error') THEN 'AUTH' WHEN event_type = 'view' THEN 'DNS' ELSE 'NETWORK' END"
    ip = "concat('10.0.', user_id % 5, '.', event_id % 254 + 1)"
    return e.selectExpr(
        "ts AS timestamp", f"{kind} AS event_type", "concat('u', user_id % 10) AS user",
        f"CASE WHEN event_type <> 'view' THEN {ip} END AS source_ip",
        "CASE WHEN event_type IN ('signup','error') THEN concat('h', user_id % 7) END AS host",
        "CASE event_type WHEN 'signup' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE' END AS status",
        "CASE WHEN event_type IN ('click','purchase') THEN 1024 + event_id % 50 END AS port",
        "CASE WHEN event_type IN ('click','purchase') THEN CAST(floor(value * 100) AS BIGINT) END AS bytes",
        f"CASE WHEN event_type = 'view' THEN {ip} END AS client_ip",
        "CASE WHEN event_type = 'view' THEN concat('d', event_id % 97, '.example.com') END AS query_domain",
    )


TELEMETRY_SQL = """
telemetry AS (
  SELECT ts AS timestamp,
    CASE WHEN event_type IN ('signup','error') THEN 'AUTH' WHEN event_type = 'view' THEN 'DNS' ELSE 'NETWORK' END AS event_type,
    'u' || (user_id % 10) AS usr,
    '10.0.' || (user_id % 5) || '.' || (event_id % 254 + 1) AS source_ip,
    CASE WHEN event_type IN ('signup','error') THEN 'h' || (user_id % 7) END AS host,
    CASE event_type WHEN 'signup' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE' END AS status,
    CASE WHEN event_type IN ('click','purchase') THEN 1024 + event_id % 50 END AS port,
    CASE WHEN event_type IN ('click','purchase') THEN CAST(floor(value * 100) AS BIGINT) END AS bytes,
    CASE WHEN event_type = 'view' THEN 'd' || (event_id % 97) || '.example.com' END AS query_domain,
    date_trunc('hour', ts) AS hour_bucket
  FROM events)"""


def pseudonym_sql(value: str) -> str:
    block = KEY.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()
    digest = f"sha256(unhex('{inner}') || encode({value}))"
    return f"'ps_' || substr(sha256(unhex('{outer}') || unhex({digest})), 1, 16)"


def features_sql(window: str, where: str = "true") -> str:
    """CTEs ending in ``features``, the matrix by definition: gaps event by event, z from sums of integers."""
    entity = "usr" if window == "user-hour" else "coalesce(host, source_ip)"
    low = "MEDIUM" if window == "user-hour" else "LOW"
    return f"""{TELEMETRY_SQL},
work AS (SELECT *, {entity} AS entity FROM telemetry WHERE {entity} IS NOT NULL AND {where}),
domains AS (SELECT DISTINCT query_domain FROM work WHERE query_domain IS NOT NULL),
letters AS (SELECT query_domain, c, count(*) AS k FROM (SELECT query_domain, unnest(string_split(query_domain, '')) AS c FROM domains) GROUP BY 1, 2),
entropy AS (SELECT query_domain, -sum(k / length(query_domain) * log2(k / length(query_domain))) AS h FROM letters GROUP BY 1),
gaps AS (
  SELECT entity, hour_bucket, sum(gap) / count(gap) / 6e7 AS gap FROM (
    SELECT entity, hour_bucket,
      epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY entity ORDER BY timestamp)) AS gap
    FROM work WHERE event_type = 'AUTH') GROUP BY 1, 2),
counts AS (
  SELECT entity, hour_bucket, count(*) AS n,
    count(*) FILTER (event_type = 'AUTH' AND status = 'SUCCESS') AS succ,
    count(*) FILTER (event_type = 'AUTH' AND status = 'FAILURE') AS fail,
    count(DISTINCT source_ip) AS ips,
    avg(CAST(h AS DECIMAL(18, 12))) FILTER (event_type = 'DNS') AS ent, avg(length(query_domain)) FILTER (event_type = 'DNS') AS len,
    coalesce(sum(bytes) FILTER (event_type = 'NETWORK'), 0) AS bytes,
    count(DISTINCT port) FILTER (event_type = 'NETWORK') AS ports
  FROM work LEFT JOIN entropy USING (query_domain) GROUP BY 1, 2),
joined AS (SELECT * FROM counts LEFT JOIN gaps USING (entity, hour_bucket)),
scored AS (
  SELECT *, avg(gap) OVER () AS mean_gap, count(*) OVER h * fail - sum(fail) OVER h AS above,
    sqrt(CAST(count(*) OVER h * sum(fail * fail) OVER h - sum(fail) OVER h * sum(fail) OVER h AS DOUBLE)) AS s
  FROM joined WINDOW h AS (PARTITION BY hour_bucket)),
features AS (
  SELECT strftime(hour_bucket, '%Y-%m-%d_%H') || '_' || {pseudonym_sql('entity')} AS window_id,
    {pseudonym_sql('entity')} AS entity_id, entity AS entity_label,
    strftime(hour_bucket, '%Y-%m-%d_%H') AS hour, CAST(date_part('hour', hour_bucket) AS INTEGER) AS hour_of_day,
    succ AS login_success_count, fail AS login_failure_count, ips AS unique_source_ips,
    CASE WHEN succ + fail = 0 THEN 0.0 ELSE fail / CAST(succ + fail AS DOUBLE) END AS failure_ratio,
    succ / CAST(n AS DOUBLE) AS success_rate, coalesce(gap, mean_gap, 0.0) AS time_since_last_login_min,
    date_part('hour', hour_bucket) BETWEEN 9 AND 17 AS is_business_hours,
    coalesce(ent, 0.0) AS dns_query_entropy, coalesce(len, 0.0) AS domain_length,
    CAST(bytes AS DOUBLE) AS bytes_transferred, ports AS unique_dest_ports,
    CASE WHEN s > 0 THEN above / s ELSE 0.0 END AS peer_deviation,
    CASE WHEN s > 0 AND abs(above / s) > 1e-12 THEN 'HIGH' ELSE '{low}' END AS privacy_risk
  FROM scored)"""


# --- raw log lines --------------------------------------------------------------------------


def log_lines(spark, sf_dir) -> DataFrame:
    """A line per event with its id: five time layouts, blanks, noise, comments and bad addresses."""
    e = events(spark, sf_dir)
    iso, plus2 = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "ts + INTERVAL 2 HOURS"
    time = (
        f"CASE event_id % 4 WHEN 0 THEN {iso} WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") "
        f"WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') ELSE date_format({plus2}, \"yyyy-MM-dd'T'HH:mm:ss'+0200'\") END"
    )
    e = e.withColumn("time", F.expr(time)).withColumn(
        "verb", F.expr("element_at(array('ALLOW','deny','Drop',' permit ','reject','zap'), cast(event_id % 6 + 1 AS INT))")
    )
    line = """CASE
      WHEN event_id % 53 = 0 THEN concat('noise ', event_id)
      WHEN event_id % 59 = 0 THEN concat('# comment ', event_id)
      WHEN event_type IN ('click','purchase') THEN concat(time, ',10.0.0.', event_id % 300, ',203.0.113.', event_id % 254,
        ',443,', CASE WHEN event_id % 7 = 0 THEN concat('"', verb, '"') ELSE verb END, ',', CAST(floor(value * 100) AS BIGINT))
      WHEN event_type = 'view' THEN concat('query_time=',
        CASE WHEN event_id % 3 = 0 THEN date_format(ts + INTERVAL 2 HOURS, "dd/MMM/yyyy:HH:mm:ss '+0200'") ELSE time END,
        '|client=192.168.1.', event_id % 300, '|domain=d', event_id % 97, '.example.com|type=A',
        CASE WHEN event_id % 5 = 0 THEN '' ELSE '|response=NXDOMAIN' END)
      ELSE concat('  ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' user', user_id, '  host ',
        CASE WHEN event_type = 'signup' THEN 'SUCCESS' ELSE 'Failed' END, ' 2001:db8::', event_id % 100) END"""
    return e.select(F.col("event_id").alias("line_id"), F.expr(line).alias("value"))


# what the lines say, taken from the events and not from the text
LOG_LINES_SQL = """
lines AS (
  SELECT event_id AS line_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, user_id, event_type, event_id,
    CASE WHEN event_id % 53 = 0 THEN 'unknown' WHEN event_id % 59 = 0 THEN 'comment'
      WHEN event_type IN ('click','purchase') THEN 'firewall' WHEN event_type = 'view' THEN 'dns' ELSE 'auth' END AS kind
  FROM events),
parsed AS (
  SELECT line_id, iso AS timestamp, kind AS log_type,
    CASE kind WHEN 'firewall' THEN CASE WHEN event_id % 300 <= 255 THEN '10.0.0.' || (event_id % 300) END
      WHEN 'dns' THEN CASE WHEN event_id % 300 <= 255 THEN '192.168.1.' || (event_id % 300) END
      ELSE '2001:db8::' || (event_id % 100) END AS source_ip,
    CASE WHEN kind = 'firewall' THEN '203.0.113.' || (event_id % 254) END AS target_ip,
    CASE kind WHEN 'dns' THEN 'd' || (event_id % 97) || '.example.com' WHEN 'auth' THEN 'user' || user_id END AS "user",
    CASE kind WHEN 'firewall' THEN ['ALLOW','DENY','DENY','ALLOW','DENY','ZAP'][event_id % 6 + 1]
      WHEN 'dns' THEN CASE WHEN event_id % 5 = 0 THEN 'QUERY' ELSE 'RESPONSE' END
      ELSE CASE WHEN event_type = 'signup' THEN 'SUCCESS' ELSE 'FAILURE' END END AS action
  FROM lines WHERE kind NOT IN ('unknown', 'comment'))"""


# --- normalized events with faults ----------------------------------------------------------

_NOISY = """
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 10 = 3 THEN concat('e', event_id - event_id % 1000) ELSE concat('e', event_id) END AS event_id,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 'bad' WHEN event_id % 79 = 0 THEN '2099-01-01T00:00:00Z' ELSE {iso} END AS timestamp,
  CASE WHEN event_id % 71 = 0 THEN '' WHEN event_id % 31 = 0 THEN '999.1.1.1' WHEN event_id % 3 = 0 THEN concat('10.0.0.', event_id % 250) ELSE concat('203.0.113.', event_id % 250) END AS source_ip,
  CASE WHEN event_id % 37 = 0 THEN 'fd00::1' WHEN event_id % 41 = 0 THEN '1::2::3' END AS target_ip,
  CASE event_type WHEN 'signup' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE' WHEN 'click' THEN 'ALLOW' WHEN 'view' THEN 'deny' END AS action,
  CASE WHEN event_id % 2 = 0 THEN 'success' ELSE 'failure' END AS status,
  CASE WHEN event_type = 'view' THEN 'dns' ELSE 'firewall' END AS log_type,
  CASE WHEN event_id % 43 = 0 THEN 'x,-5' WHEN event_id % 47 = 0 THEN 'x,1000000000001' ELSE concat('x,', event_id) END AS original_line
"""
AS_OF = "2025-01-15 00:00:00"


def noisy_events(spark, sf_dir) -> DataFrame:
    """Events with missing, wrong and repeated values, numbered by event id."""
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    columns = [c.strip() for c in _NOISY.format(iso=iso).strip().split(",\n")]
    noisy = events(spark, sf_dir).selectExpr("event_id AS seq", *columns)
    return with_line_numbers(noisy, ["seq"]).drop("seq")


NOISY_SQL = f"""
noisy AS (
  SELECT row_number() OVER (ORDER BY seq) AS line_number, * EXCLUDE (seq) FROM (
    SELECT event_id AS seq, {_NOISY.format(iso="strftime(ts, '%Y-%m-%dT%H:%M:%SZ')")} FROM events))"""


# --- feature matrix with faults -------------------------------------------------------------

_MATRIX = """
  concat('w', event_id - CASE WHEN event_id % 40 = 7 THEN 1 ELSE 0 END) AS window_id,
  CASE WHEN event_id % 40 IN (6, 7) THEN 'same' ELSE concat('x', event_id) END AS entity_id,
  '2024-01-01_00' AS hour,
  CAST(event_id % 24 AS INT) AS hour_of_day,
  CASE WHEN event_id % 301 = 0 THEN -1 ELSE event_id % 9 END AS login_success_count,
  CASE WHEN event_id % 499 = 0 THEN 900 ELSE event_id % 4 END AS login_failure_count,
  event_id % 3 + 1 AS unique_source_ips,
  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 307 = 0 THEN 1.5 ELSE (event_id % 4) / 4.0 END AS failure_ratio,
  CASE WHEN event_id % 311 = 0 THEN -0.25 ELSE (event_id % 8) / 8.0 END AS success_rate,
  value AS time_since_last_login_min,
  CASE WHEN event_id % 401 = 0 THEN 'maybe' WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS is_business_hours,
  (event_id % 7) / 4.0 AS dns_query_entropy,
  (event_id % 5) * 2.0 AS domain_length,
  CASE WHEN event_id % 997 = 1 THEN 5000000.0 ELSE (event_id % 1000) * 1.0 END AS bytes_transferred,
  event_id % 6 AS unique_dest_ports,
  'extra' AS surprise
"""


def faulty_matrix(spark, sf_dir) -> DataFrame:
    """A matrix with every fault the checks look for; ``line_number`` is the event id plus 2."""
    doubles = ("failure_ratio", "success_rate", "dns_query_entropy", "domain_length", "bytes_transferred")
    columns = [c.strip() for c in _MATRIX.strip().split(",\n")]
    m = events(spark, sf_dir).selectExpr("event_id + 2 AS line_number", *columns)
    return m.withColumns({c: F.col(c).cast("double") for c in doubles})


MATRIX_SQL = f"matrix AS (SELECT event_id + 2 AS line_number, {_MATRIX} FROM events)"


# --- event documents ------------------------------------------------------------------------

_DOCUMENT = """to_json(named_struct(
  'event', named_struct('event_id', concat('E', event_id), 'timestamp', '2026-07-15T09:41:00Z', 'source', event_type,
    'event_type', CASE WHEN event_id % 11 = 0 THEN 'unheard' ELSE 'authentication' END, 'severity', 'high'),
  'enrichment', named_struct(
    'threat_intel_matches', array(
      named_struct('indicator', '1.1.1.1', 'indicator_type', 'ip', 'source', 'feed', 'match_type', 'exact'),
      named_struct('indicator', props, 'indicator_type', 'url', 'source', 'feed',
        'match_type', CASE WHEN event_id % 13 = 0 THEN 'guess' ELSE 'heuristic' END)),
    'asset_context', named_struct('asset_id', concat('A', user_id), 'criticality', 'low'),
    'related_events', array(named_struct('event_id', concat('E', event_id + 1), 'relationship', 'same_asset'))),
  'confidence', CASE WHEN event_id % 17 <> 0 THEN named_struct('scale', '0-100',
    'overall_score', CASE WHEN event_id % 19 = 0 THEN 101 ELSE event_id % 101 END, 'overall_label', 'low',
    'applies_to', CASE WHEN event_id % 23 = 0 THEN cast(array() AS array<string>) ELSE array('event.severity') END) END,
  'approval', named_struct('approval_status', CASE WHEN event_id % 2 = 0 THEN 'pending' ELSE 'approved' END,
    'approver_id', CASE WHEN event_id % 2 = 1 OR event_id % 29 = 0 THEN concat('user', user_id) END,
    'approval_timestamp', CASE WHEN event_id % 2 = 1 AND event_id % 31 <> 0 THEN '2026-07-15T09:55:00Z' END),
  'audit_trail', array(named_struct('actor', 'edr', 'actor_type', 'system', 'action', 'triaged', 'timestamp', '2026-07-15T09:41:05Z')),
  'note', CASE WHEN event_id % 37 = 0 THEN 'unexpected' END))"""


def event_documents(spark, sf_dir) -> DataFrame:
    """A JSON document per event, with one kind of fault per divisor of its id."""
    whole = F.expr(_DOCUMENT)
    text = F.when(F.col("event_id") % 41 == 0, F.substring(whole, 2, 40)).otherwise(whole)
    return events(spark, sf_dir).select("event_id", text.alias("doc"))
