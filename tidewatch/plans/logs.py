"""Queries on raw lines and normalized events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import net, text, times
from tidewatch.operators import event_checks, log_parsing, reports
from tidewatch.operators.ordering import previous_row, with_line_numbers
from tidewatch.plans import inputs
from tidewatch.plans.inputs import AS_OF, LOG_LINES_SQL, NOISY_SQL, round6, sql6
from tidewatch.session import materialize

_EVENT = ["line_id", "timestamp", "source_ip", "target_ip", "user", "action", "status", "log_type"]
STATUS_SQL = """CASE WHEN action IN ('ALLOW','SUCCESS','QUERY','RESPONSE') THEN 'success'
  WHEN action IN ('DENY','FAILURE') THEN 'failure' ELSE 'unknown' END AS status"""


def log_events(spark, sf):
    events, _ = log_parsing.normalize_logs(inputs.log_lines(spark, sf), id_from=["line_id"])
    return events.select(*_EVENT)


def log_events_firewall(spark, sf):
    events, _ = log_parsing.normalize_logs(inputs.log_lines(spark, sf), "firewall", ["line_id"])
    return events.select(*_EVENT)


def log_rejects(spark, sf):
    _, rejects = log_parsing.normalize_logs(inputs.log_lines(spark, sf), id_from=["line_id"])
    return rejects.select("line_id", "line", "reject_reason")


def log_outcomes(spark, sf):
    return log_parsing.parse_counts(log_parsing.parse_lines(inputs.log_lines(spark, sf), id_from=["line_id"]))


def log_quality(spark, sf):
    """The whole chain of the flagship job: raw lines, events, checks, summary."""
    events, _ = log_parsing.normalize_logs(inputs.log_lines(spark, sf), id_from=["line_id"])
    numbered = with_line_numbers(events, ["line_id"])
    issues = event_checks.run_event_checks(numbered, dt.datetime.fromisoformat(AS_OF))
    return reports.issues_by_check(issues, [(n, g) for n, g, _ in event_checks.CHECKS])


def _noisy_issues(spark, sf):
    noisy = inputs.noisy_events(spark, sf)
    return noisy, event_checks.run_event_checks(noisy, dt.datetime.fromisoformat(AS_OF))


def event_issues(spark, sf):
    return _noisy_issues(spark, sf)[1].select(
        "line_number", "check_no", "check_group", "check_type", "severity", "description", "recommended_action"
    )


def event_issue_counts(spark, sf):
    return reports.issues_by_check(_noisy_issues(spark, sf)[1], [(n, g) for n, g, _ in event_checks.CHECKS])


def event_totals(spark, sf):
    noisy, issues = _noisy_issues(spark, sf)
    return reports.issue_totals(noisy, materialize(issues, "issues"))


def event_valid_records(spark, sf):
    noisy, issues = _noisy_issues(spark, sf)
    return reports.valid_records(noisy, issues).select("line_number", "event_id")


def event_first_errors(spark, sf):
    return reports.first_error_lines(_noisy_issues(spark, sf)[1])


def event_recommendations(spark, sf):
    issues = _noisy_issues(spark, sf)[1]
    firsts = reports.top_recommendations(issues, ["check_no", "line_number", "description"])
    return firsts.select("check_type", "check_no", "line_number", "recommended_action")


def duplicate_events(spark, sf):
    return event_checks.duplicate_ids(inputs.noisy_events(spark, sf))


def rapid_events(spark, sf):
    """Time since the record before, for every record with a valid time."""
    noisy = inputs.noisy_events(spark, sf)
    timed = noisy.select("line_number", times.parse_event_time(F.col("timestamp")).alias("t"))
    pairs = previous_row(timed, "line_number", F.col("t").isNotNull(), ["t", "line_number"])
    return pairs.select(
        "line_number", F.col("prev_line_number").alias("prev_line"),
        ((F.unix_micros("t") - F.unix_micros("prev_t")) / F.lit(1000000)).alias("gap_sec"),
    )


def numbered_lines(spark, sf):
    return inputs.noisy_events(spark, sf).select("line_number", "event_id", "timestamp")


def timestamp_layouts(spark, sf):
    e = inputs.events(spark, sf)
    layout = """element_at(array(
      date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
      date_format(ts, 'yyyy-M-d H:m:s'), date_format(ts - INTERVAL 3 HOURS, "yyyy-MM-dd'T'HH:mm:ss'-0300'"),
      date_format(ts + INTERVAL 2 HOURS, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"),
      date_format(ts + INTERVAL 2 HOURS, "dd/MMM/yyyy:HH:mm:ss '+0200'"),
      concat('  ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' '), 'not-a-timestamp', ''), cast(event_id % 9 + 1 AS INT))"""
    return e.select("event_id", times.normalize_timestamp(F.expr(layout)).alias("iso"))


def address_classes(spark, sf):
    e = inputs.events(spark, sf)
    ip = F.expr(
        """element_at(array(
      concat('10.', user_id % 300, '.0.', event_id % 256), concat('172.', event_id % 64, '.1.1'),
      concat('192.168.', event_id % 256, '.9'), concat('8.8.', event_id % 256, '.', user_id % 280),
      concat('fd', lpad(lower(hex(event_id % 256)), 2, '0'), '::', lower(hex(user_id))), concat('2001:db8::', event_id % 100, ':1'),
      concat('01.2.3.', event_id % 9), concat('1:2:3:4:5:6:7:8:', event_id % 9)), cast(event_id % 8 + 1 AS INT))"""
    )
    rows = e.select("event_id", ip.alias("ip"))
    return rows.select(
        "event_id", net.is_valid_ip(F.col("ip")).alias("is_valid"), net.is_valid_ipv4(F.col("ip")).alias("is_v4"),
        net.is_private_ip(F.col("ip")).alias("is_private"),
    )


def network_matches(spark, sf):
    """Addresses in any of a table of networks, prefix lengths 8 to 24 and not on byte borders."""
    nets = inputs.table(spark, sf, "nation").selectExpr(
        "concat('10.', n_nationkey % 5, '.', n_nationkey * 10, '.0/', 8 + n_nationkey % 17) AS cidr"
    ).distinct()
    flows = inputs.events(spark, sf).selectExpr("concat('10.', user_id % 7, '.', event_id % 256, '.1') AS ip")
    return net.match_networks(flows, "ip", nets).select("ip", "cidr")


def document_entropy(spark, sf):
    found = text.entropy_by_row(inputs.table(spark, sf, "documents"), "doc_id", "text")
    return found.select("doc_id", round6("entropy").alias("entropy"), "n_chars")


def customer_pseudonyms(spark, sf):
    c = inputs.table(spark, sf, "customer")
    return c.select("c_custkey", text.pseudonymize(F.col("c_name"), inputs.KEY).alias("token"))


QUERIES = {
    f.__name__: f
    for f in (
        log_events, log_events_firewall, log_rejects, log_outcomes, log_quality, event_issues, event_issue_counts,
        event_totals, event_valid_records, event_first_errors, event_recommendations, duplicate_events, rapid_events,
        numbered_lines, timestamp_layouts, address_classes, network_matches, document_entropy, customer_pseudonyms,
    )
}

_ISSUES_CTE = f"""
{NOISY_SQL},
timed AS (
  SELECT *, CASE WHEN timestamp IS NOT NULL AND timestamp <> 'bad' THEN strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') END AS t FROM noisy),
flags AS (
  SELECT *, source_ip LIKE '999%' AS bad_s, target_ip = '1::2::3' AS bad_t,
    source_ip LIKE '10.%' AS priv_s, target_ip = 'fd00::1' AS priv_t,
    min(line_number) OVER (PARTITION BY event_id) AS first_line FROM timed),
pairs AS (
  SELECT line_number, t, lag(t) OVER (ORDER BY line_number) AS pt, lag(line_number) OVER (ORDER BY line_number) AS pl
  FROM timed WHERE t IS NOT NULL),
issues AS (
  SELECT line_number, 1 AS check_no, 'Missing Fields' AS check_group, 'Missing Fields' AS check_type, 'ERROR' AS severity,
    'Missing or null critical fields: ' || concat_ws(', ',
      CASE WHEN event_id IS NULL THEN 'event_id' END, CASE WHEN timestamp IS NULL THEN 'timestamp' END,
      CASE WHEN coalesce(source_ip, '') = '' THEN 'source_ip' END, CASE WHEN action IS NULL THEN 'action' END) AS description
  FROM flags WHERE event_id IS NULL OR timestamp IS NULL OR source_ip = '' OR action IS NULL
  UNION ALL SELECT line_number, 2, 'IP Validation', 'IP Validation', 'ERROR',
    'source_ip ''' || source_ip || ''' is not a valid IPv4 or IPv6 address.' FROM flags WHERE bad_s
  UNION ALL SELECT line_number, 2, 'IP Validation', 'IP Validation', 'ERROR',
    'target_ip ''' || target_ip || ''' is not a valid IPv4 or IPv6 address.' FROM flags WHERE bad_t
  UNION ALL SELECT line_number, 2, 'IP Validation', 'IP Validation', 'WARNING',
    'source_ip ''' || source_ip || ''' is a private/RFC-1918 IP address in log_type=''' || log_type || '''.' FROM flags WHERE priv_s
  UNION ALL SELECT line_number, 2, 'IP Validation', 'IP Validation', 'WARNING',
    'target_ip ''' || target_ip || ''' is a private/RFC-1918 IP address in log_type=''' || log_type || '''.' FROM flags WHERE priv_t
  UNION ALL SELECT line_number, 3, 'Timestamp Anomalies', 'Timestamp Anomaly', 'ERROR', 'Timestamp field is missing or empty.' FROM flags WHERE timestamp IS NULL
  UNION ALL SELECT line_number, 3, 'Timestamp Anomalies', 'Timestamp Anomaly', 'ERROR', 'Timestamp ''bad'' cannot be parsed as ISO 8601.' FROM flags WHERE timestamp = 'bad'
  UNION ALL SELECT line_number, 3, 'Timestamp Anomalies', 'Timestamp Anomaly', 'WARNING',
    'Timestamp ''' || timestamp || ''' is in the future (now=2025-01-15T00:00:00Z).' FROM flags WHERE t > TIMESTAMP '{AS_OF}'
  UNION ALL SELECT line_number, 3, 'Timestamp Anomalies', 'Timestamp Anomaly', 'WARNING',
    'Timestamp ''' || timestamp || ''' is older than 1 year.' FROM flags WHERE t < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
  UNION ALL SELECT line_number, 4, 'Duplicate Detection', 'Duplicate Detection', 'ERROR',
    'Duplicate event_id ''' || event_id || ''' first seen at line ' || first_line || '.' FROM flags WHERE event_id IS NOT NULL AND line_number > first_line
  UNION ALL SELECT line_number, 5, 'Suspicious Patterns', 'Suspicious Pattern', 'WARNING',
    'Impossible combination: action=''' || upper(action) || ''', status=''' || status || '''.' FROM flags
    WHERE (upper(action), status) IN (('DENY','success'),('ALLOW','failure'),('SUCCESS','failure'),('FAILURE','success'))
  UNION ALL SELECT line_number, 5, 'Suspicious Patterns', 'Suspicious Pattern', 'WARNING', 'Negative byte count (-5) in record.' FROM flags WHERE original_line = 'x,-5'
  UNION ALL SELECT line_number, 5, 'Suspicious Patterns', 'Suspicious Pattern', 'WARNING',
    'Extreme byte count (1,000,000,000,001) exceeds 1 TB.' FROM flags WHERE original_line = 'x,1000000000001'
  UNION ALL SELECT line_number, 5, 'Suspicious Patterns', 'Suspicious Pattern', 'INFO',
    'Rapid sequential event: ' || printf('%.3f', abs(epoch_us(t) - epoch_us(pt)) / 1e6) || 's after line ' || pl || '.'
    FROM pairs WHERE abs(epoch_us(t) - epoch_us(pt)) < 1000000)"""

_ADVISED = "advised AS (SELECT *, CASE " + " ".join(
    f"WHEN description LIKE '{like}' THEN '{event_checks.ADVICE[key].format(field=field)}'"
    for like, key, field in (
        ("Missing or null%", "missing", ""), ("source_ip%not a valid%", "invalid_ip", "source_ip"), ("target_ip%not a valid%", "invalid_ip", "target_ip"),
        ("%is a private%", "private_ip", ""), ("Timestamp field is missing%", "no_time", ""), ("%cannot be parsed%", "bad_time", ""),
        ("%in the future%", "future", ""), ("%older than%", "old", ""), ("Duplicate event_id%", "duplicate", ""), ("Impossible%", "impossible", ""),
        ("Negative byte%", "negative", ""), ("Extreme byte%", "extreme", ""), ("Rapid%", "rapid", ""),
    )
) + " END AS recommended_action FROM issues)"

_BY_CHECK = """
SELECT c.check_no, c.check_group, count(*) FILTER (severity = 'ERROR') AS errors,
  count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS info,
  count(*) FILTER (severity = 'ERROR') = 0 AS pass,
  CASE WHEN count(*) FILTER (severity = 'ERROR') > 0 THEN 'ERROR' WHEN count(*) FILTER (severity = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS verdict
FROM (VALUES (1, 'Missing Fields'), (2, 'IP Validation'), (3, 'Timestamp Anomalies'), (4, 'Duplicate Detection'), (5, 'Suspicious Patterns')) c(check_no, check_group)
LEFT JOIN issues i ON i.check_group = c.check_group GROUP BY 1, 2"""

ORACLES = {
    "log_events": f"WITH {LOG_LINES_SQL} SELECT *, {STATUS_SQL} FROM parsed",
    "log_events_firewall": f"WITH {LOG_LINES_SQL} SELECT *, {STATUS_SQL} FROM parsed WHERE log_type = 'firewall'",
    "log_rejects": f"WITH {LOG_LINES_SQL} SELECT line_id, 'noise ' || line_id AS line, 'unknown format' AS reject_reason FROM lines WHERE kind = 'unknown'",
    "log_outcomes": f"""WITH {LOG_LINES_SQL} SELECT kind AS log_type,
        CASE WHEN kind = 'unknown' THEN 'unknown format' ELSE 'parsed' END AS outcome, count(*) AS n_lines
        FROM lines WHERE kind <> 'comment' GROUP BY 1, 2""",
    "log_quality": f"""WITH {LOG_LINES_SQL},
        numbered AS (SELECT *, strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS t, row_number() OVER (ORDER BY line_id) AS line_number FROM parsed),
        paired AS (SELECT *, lag(t) OVER (ORDER BY line_number) AS pt FROM numbered),
        issues AS (
          SELECT 'Missing Fields' AS check_group, 'ERROR' AS severity FROM paired WHERE source_ip IS NULL
          UNION ALL SELECT 'IP Validation', 'WARNING' FROM paired WHERE source_ip LIKE '10.%' OR source_ip LIKE '192.168.%'
          UNION ALL SELECT 'Timestamp Anomalies', 'WARNING' FROM paired WHERE t < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
          UNION ALL SELECT 'Suspicious Patterns', 'INFO' FROM paired WHERE abs(epoch_us(t) - epoch_us(pt)) < 1000000)
        {_BY_CHECK}""",
    "event_issues": f"WITH {_ISSUES_CTE}, {_ADVISED} SELECT * FROM advised",
    "event_issue_counts": f"WITH {_ISSUES_CTE} {_BY_CHECK}",
    "event_totals": f"""WITH {_ISSUES_CTE} SELECT (SELECT count(*) FROM noisy) AS total_records,
        (SELECT count(*) FROM noisy) - count(DISTINCT line_number) FILTER (severity = 'ERROR') AS valid_records,
        count(*) FILTER (severity = 'ERROR') AS error_count, count(*) FILTER (severity = 'WARNING') AS warning_count,
        count(*) FILTER (severity = 'INFO') AS info_count FROM issues""",
    "event_valid_records": f"""WITH {_ISSUES_CTE} SELECT line_number, event_id FROM noisy
        WHERE line_number NOT IN (SELECT line_number FROM issues WHERE severity = 'ERROR')""",
    "event_first_errors": f"""WITH {_ISSUES_CTE}, ranked AS (
        SELECT check_group, line_number, CAST(row_number() OVER (PARTITION BY check_group ORDER BY line_number) AS INTEGER) AS rank
        FROM (SELECT DISTINCT check_group, line_number FROM issues WHERE severity = 'ERROR')) SELECT * FROM ranked WHERE rank <= 5""",
    "event_recommendations": f"""WITH {_ISSUES_CTE}, {_ADVISED}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY check_type ORDER BY check_no, line_number, description) AS rn FROM advised)
        SELECT check_type, check_no, line_number, recommended_action FROM ranked WHERE rn = 1""",
    "duplicate_events": f"""WITH {NOISY_SQL}, firsts AS (SELECT event_id, line_number, min(line_number) OVER (PARTITION BY event_id) AS first_line FROM noisy)
        SELECT * FROM firsts WHERE event_id IS NOT NULL AND line_number > first_line""",
    "rapid_events": f"""WITH {NOISY_SQL}, timed AS (SELECT line_number, strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS t
        FROM noisy WHERE timestamp IS NOT NULL AND timestamp <> 'bad')
        SELECT line_number, lag(line_number) OVER w AS prev_line, (epoch_us(t) - epoch_us(lag(t) OVER w)) / 1000000 AS gap_sec
        FROM timed WINDOW w AS (ORDER BY line_number)""",
    "numbered_lines": f"WITH {NOISY_SQL} SELECT line_number, event_id, timestamp FROM noisy",
    "timestamp_layouts": """SELECT event_id, CASE WHEN event_id % 9 < 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso FROM events""",
    "address_classes": """SELECT event_id,
        CASE event_id % 8 WHEN 0 THEN user_id % 300 < 256 WHEN 3 THEN user_id % 280 < 256 WHEN 6 THEN false WHEN 7 THEN false ELSE true END AS is_valid,
        CASE event_id % 8 WHEN 0 THEN user_id % 300 < 256 WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN user_id % 280 < 256 ELSE false END AS is_v4,
        CASE event_id % 8 WHEN 0 THEN user_id % 300 < 256 WHEN 1 THEN event_id % 64 BETWEEN 16 AND 31 WHEN 2 THEN true WHEN 4 THEN true ELSE false END AS is_private
        FROM events""",
    "network_matches": """WITH nets AS (SELECT DISTINCT n_nationkey % 5 AS a, n_nationkey * 10 AS b, 8 + n_nationkey % 17 AS bits FROM nation),
        ips AS (SELECT DISTINCT user_id % 7 AS a, event_id % 256 AS b FROM events)
        SELECT '10.' || ips.a || '.' || ips.b || '.1' AS ip, '10.' || nets.a || '.' || nets.b || '.0/' || nets.bits AS cidr
        FROM ips JOIN nets ON ((10 * 256 + ips.a) * 256 + ips.b) * 256 // CAST(2 ** (32 - bits) AS BIGINT)
          = ((10 * 256 + nets.a) * 256 + nets.b) * 256 // CAST(2 ** (32 - bits) AS BIGINT)""",
    "document_entropy": f"""WITH letters AS (SELECT doc_id, c, count(*) AS k FROM (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents) GROUP BY 1, 2),
        sizes AS (SELECT doc_id, sum(k) AS n FROM letters GROUP BY 1),
        h AS (SELECT doc_id, -sum(k / n * log2(k / n)) AS h FROM letters JOIN sizes USING (doc_id) GROUP BY 1)
        SELECT doc_id, {sql6("coalesce(h, 0)")} AS entropy, length(text) AS n_chars FROM documents LEFT JOIN h USING (doc_id)""",
    "customer_pseudonyms": f"SELECT c_custkey, {inputs.pseudonym_sql('c_name')} AS token FROM customer",
}
