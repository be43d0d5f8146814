"""DuckDB SQL for every registered query, written against the ``events`` table.

The SQL derives telemetry arithmetically from ``events`` and never sees JSON, Kafka records or the
package's expressions, so it is an independent statement of each result.
"""

from __future__ import annotations


def _round(expression: str, digits: int) -> str:
    """Half-away-from-zero rounding on a decimal copy of the double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,12)), {digits}) AS DOUBLE)"


TELEMETRY = """
seed AS (
  SELECT event_id, ts, user_id % 35 AS i, day(ts) AS dd,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'click' THEN 'device_health' WHEN 'signup' THEN 'link_state'
              WHEN 'error' THEN 'security_alert' WHEN 'view' THEN 'interface_stats'
              WHEN 'purchase' THEN 'interface_stats' END AS event_type,
         ((event_id % 1000003) * 7919 + 104729) % 1000003 AS h1,
         ((event_id % 1000033) * 15485863 + 32452843) % 1000033 AS h2,
         ((event_id % 1000037) * 6700417 + 49979687) % 1000037 AS h3
  FROM events
),
placed AS (
  SELECT *,
    CASE WHEN i < 20 THEN 'SW-' || lpad(CAST(i + 1 AS VARCHAR), 3, '0')
         WHEN i < 30 THEN 'RTR-' || lpad(CAST(i - 19 AS VARCHAR), 3, '0')
         ELSE 'FW-' || lpad(CAST(i - 29 AS VARCHAR), 3, '0') END AS device_id,
    CASE WHEN i < 20 THEN 'Switch' WHEN i < 30 THEN 'Router' ELSE 'Firewall' END AS device_type,
    (['DC-East', 'DC-West', 'Branch-NY', 'Branch-LA', 'Branch-CHI'])
      [CASE WHEN i < 20 THEN i % 5 WHEN i < 30 THEN i % 3 ELSE i % 2 END + 1] AS location,
    (['Norrland', 'Alpenet', 'Quayside'])[i % 3 + 1] AS vendor, 'M' || (100 + i % 7) AS model
  FROM seed
),
calm AS (SELECT *, dd % 7 = 0 AND location LIKE 'DC%' AS quiet FROM placed),
readings AS (
  SELECT *,
    CASE WHEN event_type = 'device_health'
         THEN CAST(500 + h1 % (CASE WHEN quiet THEN 1900 ELSE 9301 END) AS DOUBLE) / 100 END AS cpu,
    CASE WHEN event_type = 'device_health'
         THEN CAST(2000 + h2 % (CASE WHEN quiet THEN 1900 ELSE 7501 END) AS DOUBLE) / 100 END AS mem,
    CASE WHEN event_type = 'device_health'
         THEN CAST(3000 + h3 % (CASE WHEN quiet THEN 1400 ELSE 5501 END) AS DOUBLE) / 100 END AS temp,
    CASE WHEN event_type = 'device_health' THEN 3600 + h2 * 31 END AS uptime_seconds,
    CASE WHEN event_type IN ('interface_stats', 'link_state')
         THEN 'port-' || (h1 % 4) || '/' || (h2 % 25) END AS interface_name,
    CASE WHEN event_type = 'interface_stats'
         THEN CAST(h1 % (CASE WHEN quiet THEN 4000 ELSE 15001 END) AS DOUBLE) / 1000 END AS loss,
    CASE WHEN event_type = 'interface_stats'
         THEN CAST(h2 % (CASE WHEN quiet THEN 7000 ELSE 10001 END) AS DOUBLE) / 100 END AS bandwidth,
    CASE WHEN event_type = 'interface_stats' THEN 1000 + h3 * 9 END AS bytes_in,
    CASE WHEN event_type = 'interface_stats' THEN 1000 + h1 * 9 END AS bytes_out,
    CASE WHEN event_type = 'security_alert'
         THEN (['port_scan_detected', 'auth_failure_spike', 'suspicious_traffic_pattern',
                'ddos_signature_matched', 'unauthorized_access_attempt'])
              [CASE WHEN quiet THEN 2 ELSE dd % 5 + 1 END] END AS alert_type,
    CASE WHEN event_type = 'security_alert' THEN '192.168.' || (h1 % 256) || '.' || (1 + h2 % 254) END AS source_ip,
    CASE WHEN event_type = 'security_alert' THEN '10.0.' || (h2 % 11) || '.' || (1 + h3 % 254) END AS destination_ip,
    CASE WHEN event_type = 'security_alert' THEN (['TCP', 'UDP', 'ICMP'])[dd % 3 + 1] END AS protocol,
    CASE WHEN event_type = 'security_alert' THEN 100 + h3 % 99901 END AS packet_count,
    CASE WHEN event_type = 'security_alert' THEN 1 + h1 % 65535 END AS port,
    CASE WHEN event_type = 'interface_stats' THEN h2 % 51 END AS errors_in,
    CASE WHEN event_type = 'interface_stats' THEN h3 % 51 END AS errors_out,
    CASE WHEN event_type = 'link_state'
         THEN CASE WHEN quiet OR k < 85 THEN 'up' WHEN k < 95 THEN 'down' ELSE 'flapping' END END AS link_state,
    CASE WHEN event_type = 'link_state'
         THEN (['operator_action', 'fiber_cut', 'speed_mismatch', 'power_loss'])[h2 % 4 + 1] END AS link_down_reason
  FROM calm
),
telemetry AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, device_id, device_type, location, vendor, model,
    CASE
      WHEN event_type = 'device_health' AND greatest(cpu - 90, mem - 90, temp - 80) > 0 THEN 'CRITICAL'
      WHEN event_type = 'device_health' AND greatest(cpu - 75, mem - 75, temp - 70) > 0 THEN 'WARNING'
      WHEN event_type = 'interface_stats' AND (loss > 10 OR bandwidth > 95) THEN 'CRITICAL'
      WHEN event_type = 'interface_stats' AND (loss > 5 OR bandwidth > 80) THEN 'WARNING'
      WHEN alert_type IN ('ddos_signature_matched', 'unauthorized_access_attempt') THEN 'CRITICAL'
      WHEN alert_type = 'port_scan_detected' THEN 'ERROR'
      WHEN event_type = 'security_alert' OR link_state = 'flapping' THEN 'WARNING'
      WHEN link_state = 'down' THEN 'CRITICAL'
      ELSE 'INFO' END AS severity,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp", ts AS event_ts,
    cpu, mem, temp, uptime_seconds, interface_name, loss, bandwidth, bytes_in, bytes_out, alert_type, source_ip,
    destination_ip, protocol, packet_count, link_state,
    CASE WHEN link_state = 'up' THEN 'down' WHEN link_state IS NOT NULL THEN 'up' END AS previous_state,
    link_down_reason, port, errors_in, errors_out, device_id AS kafka_key, CAST(i % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
    ts AS kafka_timestamp
  FROM readings
)"""

SILVER = """
silver AS (
  SELECT *,
    CAST(CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'ERROR' THEN 3 WHEN 'WARNING' THEN 2 ELSE 1 END AS INTEGER)
      AS severity_score,
    severity IN ('CRITICAL', 'ERROR') OR event_type = 'security_alert'
      OR (event_type = 'link_state' AND link_state = 'down') AS requires_action,
    CAST(hour(event_ts) AS INTEGER) AS event_hour, CAST(event_ts AS DATE) AS event_date,
    CAST(dayofweek(event_ts) + 1 AS INTEGER) AS event_weekday,
    severity = 'CRITICAL' AND event_type IN ('device_health', 'link_state') AS sla_breach_risk,
    cpu > 85 AND mem > 85 AS resource_anomaly,
    CASE WHEN location LIKE 'DC%' THEN 'Data Center' ELSE 'Branch' END AS location_type
  FROM telemetry
)"""

_SCORE = _round("100 - avg(cpu) * 0.40 - avg(mem) * 0.30 - (avg(temp) - 30) / 50 * 30", 1)

DEVICE_HEALTH = f"""
health AS (
  SELECT *, CASE WHEN health_score >= 80 THEN 'Healthy' WHEN health_score >= 60 THEN 'Degraded'
                 ELSE 'Critical' END AS health_status
  FROM (
    SELECT device_id, device_type, location, location_type, event_date, event_hour,
      avg(cpu) AS avg_cpu_pct, max(cpu) AS max_cpu_pct, avg(mem) AS avg_memory_pct, max(mem) AS max_memory_pct,
      avg(temp) AS avg_temp_celsius, max(temp) AS max_temp_celsius, count(event_id) AS sample_count,
      CAST(count(*) FILTER (severity_score >= 3) AS BIGINT) AS critical_count,
      greatest(0.0, {_SCORE}) AS health_score
    FROM silver WHERE event_type = 'device_health' GROUP BY ALL
  )
)"""

ALERT_SUMMARY = f"""
alert_days AS (
  SELECT *, {_round("CAST(alert_count AS DOUBLE) / affected_devices", 2)} AS alerts_per_device
  FROM (
    SELECT event_date, event_type, severity, location, location_type, device_type,
      count(event_id) AS alert_count, count(DISTINCT device_id) AS affected_devices,
      min(event_ts) AS first_alert_ts, max(event_ts) AS last_alert_ts
    FROM silver WHERE requires_action GROUP BY ALL
  )
)"""

RELIABILITY = f"""
reliability AS (
  SELECT *, availability_pct >= 99.9 AS sla_met FROM (
    SELECT *, {_round("100 - incident_rate_pct", 2)} AS availability_pct FROM (
      SELECT *, {_round("CAST(incident_count AS DOUBLE) / nullif(total_events, 0) * 100", 2)} AS incident_rate_pct
      FROM (
        SELECT location, location_type, device_type, event_date, count(event_id) AS total_events,
          CAST(count(*) FILTER (severity_score >= 3) AS BIGINT) AS incident_count,
          avg(loss) AS avg_packet_loss, max(loss) AS max_packet_loss, avg(bandwidth) AS avg_bandwidth_util,
          count(DISTINCT device_id) AS device_count,
          CAST(count(*) FILTER (requires_action) AS BIGINT) AS actionable_alerts
        FROM silver GROUP BY ALL
      )
    )
  )
)"""

THREATS = """
threats AS (
  SELECT *, CASE WHEN critical_count > 5 THEN 'High' WHEN alert_count > 10 THEN 'Medium' ELSE 'Low' END AS threat_level
  FROM (
    SELECT event_date, alert_type, location, device_type, protocol, count(event_id) AS alert_count,
      CAST(sum(packet_count) AS BIGINT) AS total_packets_flagged, count(DISTINCT device_id) AS affected_devices,
      CAST(count(*) FILTER (severity = 'CRITICAL') AS BIGINT) AS critical_count
    FROM silver WHERE event_type = 'security_alert' GROUP BY ALL
  )
)"""

EXECUTIVE = f"""
executive AS (
  SELECT event_date, CAST(sum(total_events) AS BIGINT) AS total_events,
    CAST(sum(incident_count) AS BIGINT) AS total_incidents,
    {_round("avg(availability_pct)", 2)} AS avg_availability_pct,
    CAST(count(*) FILTER (sla_met) AS BIGINT) AS locations_meeting_sla,
    count(DISTINCT location) AS total_locations,
    {_round("CAST(count(*) FILTER (sla_met) AS DOUBLE) / count(DISTINCT location) * 100", 1)} AS sla_compliance_pct
  FROM reliability GROUP BY event_date
)"""

DEVICE_SUMMARY = f"""
status_ranks AS (
  SELECT device_id, device_type, location, location_type, health_status,
    row_number() OVER (PARTITION BY device_id, device_type, location, location_type
                       ORDER BY count(*) DESC, health_status) AS rank
  FROM health GROUP BY device_id, device_type, location, location_type, health_status
),
device_summary AS (
  SELECT h.device_id, h.device_type, h.location, h.location_type, max(event_date) AS latest_date,
    {_round("avg(avg_cpu_pct)", 1)} AS avg_cpu, {_round("max(max_cpu_pct)", 1)} AS peak_cpu,
    {_round("avg(avg_memory_pct)", 1)} AS avg_memory, {_round("avg(health_score)", 1)} AS avg_health_score,
    CAST(sum(critical_count) AS BIGINT) AS total_critical_events,
    any_value(s.health_status) AS typical_health_status
  FROM health h JOIN status_ranks s
    ON s.rank = 1 AND s.device_id = h.device_id AND s.device_type = h.device_type
       AND s.location = h.location AND s.location_type = h.location_type
  GROUP BY h.device_id, h.device_type, h.location, h.location_type
)"""

_BASE = (TELEMETRY, SILVER)
_TABLES = {
    "health": (DEVICE_HEALTH,),
    "alert_days": (ALERT_SUMMARY,),
    "reliability": (RELIABILITY,),
    "threats": (THREATS,),
    "executive": (RELIABILITY, EXECUTIVE),
    "device_summary": (DEVICE_HEALTH, DEVICE_SUMMARY),
}


def _sql(select: str, *tables: str) -> str:
    ctes: list[str] = list(_BASE)
    for table in tables:
        ctes += [cte for cte in _TABLES[table] if cte not in ctes]
    return "WITH" + ",".join(ctes) + "\n" + select.strip()


# --- column lists --------------------------------------------------------------------------------

ENVELOPE = 'event_id, event_type, device_id, device_type, location, vendor, model, severity, "timestamp"'
COORDINATES = "kafka_key, 'network-events' AS kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"
FLAT = """cpu AS cpu_utilization_pct, mem AS memory_utilization_pct, temp AS temperature_celsius, uptime_seconds,
  interface_name, loss AS packet_loss_pct, bandwidth AS bandwidth_utilization, bytes_in, bytes_out, alert_type,
  source_ip, destination_ip, protocol, packet_count, link_state, previous_state, link_down_reason"""
DERIVED = """severity_score, requires_action, event_hour, event_date, event_weekday, sla_breach_risk,
  resource_anomaly, location_type"""
SILVER_COLUMNS = f"kafka_timestamp, {ENVELOPE}, event_ts, {FLAT}, {DERIVED}"
ALERT_COLUMNS = f"{COORDINATES}, 'kafka' AS _source, {ENVELOPE}, event_ts, {FLAT}, {DERIVED}"
PAYLOAD = {
    "cpu_utilization_pct": "cpu",
    "memory_utilization_pct": "mem",
    "temperature_celsius": "temp",
    "uptime_seconds": "uptime_seconds",
    "interface": "interface_name",
    "packet_loss_pct": "loss",
    "bandwidth_utilization": "bandwidth",
    "bytes_in": "bytes_in",
    "bytes_out": "bytes_out",
    "errors_in": "errors_in",
    "errors_out": "errors_out",
    "alert_type": "alert_type",
    "source_ip": "source_ip",
    "destination_ip": "destination_ip",
    "port": "port",
    "protocol": "protocol",
    "packet_count": "packet_count",
    "state": "link_state",
    "previous_state": "previous_state",
    "reason": "link_down_reason",
}
BRONZE_COLUMNS = f"""{COORDINATES}, {ENVELOPE}, 'kafka' AS _source, event_ts,
  {", ".join(f"CAST({column} AS VARCHAR) AS payload_{key}" for key, column in PAYLOAD.items())},
  CAST(CASE event_type WHEN 'device_health' THEN 4 WHEN 'interface_stats' THEN 7 WHEN 'security_alert' THEN 6
       ELSE 4 END AS INTEGER) AS payload_size"""

HEALTH_COLUMNS = f"""device_id, device_type, location, location_type, event_date, event_hour,
  {_round("avg_cpu_pct", 6)} AS avg_cpu_pct, max_cpu_pct, {_round("avg_memory_pct", 6)} AS avg_memory_pct,
  max_memory_pct, {_round("avg_temp_celsius", 6)} AS avg_temp_celsius, max_temp_celsius, sample_count,
  critical_count, health_score, health_status"""
RELIABILITY_COLUMNS = f"""location, location_type, device_type, event_date, total_events, incident_count,
  {_round("avg_packet_loss", 6)} AS avg_packet_loss, max_packet_loss,
  {_round("avg_bandwidth_util", 6)} AS avg_bandwidth_util, device_count, actionable_alerts, incident_rate_pct,
  availability_pct, sla_met"""
ALERT_DAY_COLUMNS = """event_date, event_type, severity, location, location_type, device_type, alert_count,
  affected_devices, alerts_per_device, first_alert_ts, last_alert_ts"""
THREAT_COLUMNS = """event_date, alert_type, location, device_type, protocol, alert_count, total_packets_flagged,
  affected_devices, critical_count, threat_level"""

HEALTH_SQL = _sql(f"SELECT {HEALTH_COLUMNS} FROM health", "health")
ALERTS_SQL = _sql(f"SELECT {ALERT_DAY_COLUMNS} FROM alert_days", "alert_days")
RELIABILITY_SQL = _sql(f"SELECT {RELIABILITY_COLUMNS} FROM reliability", "reliability")
THREATS_SQL = _sql(f"SELECT {THREAT_COLUMNS} FROM threats", "threats")
SILVER_SQL = _sql(f"SELECT {SILVER_COLUMNS} FROM silver")
BRONZE_SQL = _sql(f"SELECT {BRONZE_COLUMNS} FROM telemetry")
LAST_HOUR = "{0} > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AND {0} <= (SELECT max(ts) FROM events)"

_CRITICAL_24H = """SELECT event_date, event_type, severity, location, device_type, alert_count, affected_devices,
  first_alert_ts, last_alert_ts
FROM alert_days
WHERE severity IN ('CRITICAL', 'ERROR') AND event_date >= CAST((SELECT max(ts) FROM events) AS DATE) - 1"""

DQ_SQL = _sql(
    """SELECT 'null_event_ids' AS "check", count(*) FILTER (event_id IS NULL) AS failed_rows FROM silver
    UNION ALL SELECT 'future_events', count(*) FILTER (event_ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY)
      FROM silver
    UNION ALL SELECT 'invalid_severity', count(*) FILTER (severity NOT IN ('INFO', 'WARNING', 'ERROR', 'CRITICAL'))
      FROM silver
    UNION ALL SELECT 'null_severity', count(*) FILTER (severity IS NULL) FROM silver"""
)

ORACLES: dict[str, str] = {
    # Bronze
    "bronze_parse": BRONZE_SQL,
    "bronze_variant": BRONZE_SQL,
    "silver_from_variant": SILVER_SQL,
    "bronze_metadata": _sql('SELECT event_id, "timestamp", event_ts, \'kafka\' AS _source FROM telemetry'),
    "batch_scan_bronze": BRONZE_SQL,
    "topk_latest_bronze": _sql(
        """SELECT event_id, event_type, device_id, severity, event_ts, kafka_timestamp FROM telemetry
        ORDER BY kafka_timestamp DESC, event_id LIMIT 10"""
    ),
    "encode_decode_roundtrip": BRONZE_SQL,
    "gate_recent_events": _sql(
        f"SELECT count(*) AS recent_events FROM telemetry WHERE {LAST_HOUR.format('kafka_timestamp')}"
    ),
    # Silver
    "silver_flatten": _sql(f"SELECT event_id, event_type, {FLAT} FROM silver"),
    "silver_enrich": SILVER_SQL,
    "classify_severity": _sql("SELECT event_id, event_type, severity, severity AS expected_severity FROM telemetry"),
    "filter_alerts": _sql(f"SELECT {ALERT_COLUMNS} FROM silver WHERE requires_action"),
    "silver_critical_sample": _sql(
        """SELECT event_id, event_type, device_id, location, severity, requires_action, event_ts FROM silver
        WHERE severity = 'CRITICAL' ORDER BY event_ts DESC, event_id LIMIT 5"""
    ),
    # Gold
    "gold_device_health": HEALTH_SQL,
    "gold_alert_summary": ALERTS_SQL,
    "gold_network_reliability": RELIABILITY_SQL,
    "gold_security_threats": THREATS_SQL,
    "gold_write_roundtrip": RELIABILITY_SQL,
    "gold_write_health": HEALTH_SQL,
    "gold_write_alerts": ALERTS_SQL,
    "gold_write_threats": THREATS_SQL,
    "gold_incremental_equals_full": ALERTS_SQL,
    "hourly_incremental_reliability": RELIABILITY_SQL,
    "hourly_incremental_health": HEALTH_SQL,
    "gold_audit": _sql(
        """SELECT 'device_health_kpis' AS table_name, count(*) AS row_count FROM health
        UNION ALL SELECT 'alert_summary', count(*) FROM alert_days
        UNION ALL SELECT 'network_reliability', count(*) FROM reliability
        UNION ALL SELECT 'security_threats', count(*) FROM threats""",
        "health",
        "alert_days",
        "reliability",
        "threats",
    ),
    # Aggregate functions
    "agg_avg_max_min": _sql(
        f"""SELECT device_type, {_round("avg(cpu)", 6)} AS avg_cpu, max(cpu) AS max_cpu, min(cpu) AS min_cpu,
        {_round("avg(loss)", 6)} AS avg_loss, max(loss) AS max_loss, min(event_ts) AS first_ts,
        max(event_ts) AS last_ts FROM silver GROUP BY device_type"""
    ),
    "agg_count_nonnull": _sql(
        """SELECT event_type, count(*) AS all_rows, count(event_id) AS ids, count(cpu) AS cpu_readings,
        count(packet_count) AS packet_readings, count(link_state) AS link_readings FROM silver GROUP BY event_type"""
    ),
    "agg_count_distinct": _sql(
        """SELECT location, event_date, count(DISTINCT device_id) AS devices, count(DISTINCT event_type) AS event_types
        FROM silver GROUP BY location, event_date"""
    ),
    "agg_conditional_sum": _sql(
        """SELECT location, CAST(count(*) FILTER (severity_score >= 3) AS BIGINT) AS incidents,
        CAST(count(*) FILTER (requires_action) AS BIGINT) AS actionable,
        CAST(sum(packet_count) FILTER (severity = 'CRITICAL') AS BIGINT) AS critical_packets
        FROM silver GROUP BY location"""
    ),
    "agg_mode": _sql(
        """SELECT location, severity AS typical_severity FROM (
          SELECT location, severity, row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, severity) AS rank
          FROM silver GROUP BY location, severity) WHERE rank = 1"""
    ),
    # Views and queries
    "vw_executive": _sql("SELECT * FROM executive", "executive"),
    "vw_device_health_summary": _sql("SELECT * FROM device_summary", "device_summary"),
    "vw_critical_alerts_24h": _sql(_CRITICAL_24H, "alert_days"),
    "vw_sla_breaches": _sql(
        f"""SELECT location, location_type, event_date, device_count, incident_count,
        {_round("availability_pct", 3)} AS availability_pct, {_round("99.9 - availability_pct", 3)} AS sla_gap_pct,
        actionable_alerts FROM reliability WHERE NOT sla_met""",
        "reliability",
    ),
    "q1_sla_compliance": _sql("SELECT * FROM executive ORDER BY event_date DESC LIMIT 7", "executive"),
    "q2_problem_devices": _sql(
        """SELECT device_id, location, total_critical_events, avg_health_score, typical_health_status
        FROM device_summary
        ORDER BY total_critical_events DESC, device_id, device_type, location, location_type LIMIT 5""",
        "device_summary",
    ),
    "q3_alert_trend": _sql(
        f"""SELECT *, {_round("CAST(total_alerts - prev_day AS DOUBLE) / nullif(prev_day, 0) * 100", 1)}
          AS day_over_day_pct
        FROM (
          SELECT *, lag(total_alerts) OVER (PARTITION BY severity ORDER BY event_date) AS prev_day
          FROM (
            SELECT event_date, severity, CAST(sum(alert_count) AS BIGINT) AS total_alerts,
              CAST(sum(affected_devices) AS BIGINT) AS devices_impacted
            FROM alert_days GROUP BY event_date, severity))""",
        "alert_days",
    ),
    "q4_threat_breakdown": _sql(
        """SELECT alert_type, threat_level, CAST(sum(alert_count) AS BIGINT) AS total_alerts,
        CAST(sum(total_packets_flagged) AS BIGINT) AS packets_flagged,
        CAST(sum(affected_devices) AS BIGINT) AS devices_affected,
        CAST(sum(critical_count) AS BIGINT) AS critical_alerts FROM threats GROUP BY alert_type, threat_level""",
        "threats",
    ),
    "q5_bandwidth_by_location": _sql(
        f"""SELECT location, location_type, {_round("avg(avg_bandwidth_util)", 1)} AS avg_bandwidth_pct,
        {_round("avg(avg_packet_loss)", 3)} AS avg_packet_loss_pct, count(DISTINCT event_date) AS days_monitored
        FROM reliability GROUP BY location, location_type""",
        "reliability",
    ),
    "topk_incident_locations": _sql(
        """SELECT location, location_type, device_count, incident_count, availability_pct, sla_met FROM reliability
        ORDER BY incident_count DESC, event_date DESC, location, location_type, device_type LIMIT 5""",
        "reliability",
    ),
    # Quality, gates, digest
    "dq_checks": DQ_SQL,
    "dq_checks_observed": DQ_SQL,
    "gate_critical_alerts": _sql(
        f"""SELECT count(*) AS critical_alerts FROM silver
        WHERE requires_action AND severity = 'CRITICAL' AND {LAST_HOUR.format('event_ts')}"""
    ),
    "alert_digest": _sql(
        f"""SELECT event_date, severity, count(*) AS alerts, min(event_ts) AS first_event_ts,
        max(event_ts) AS last_event_ts FROM silver
        WHERE requires_action AND {LAST_HOUR.format('event_ts')} GROUP BY event_date, severity"""
    ),
    # Serving load
    "load_serving_device_health": HEALTH_SQL,
    "load_serving_alert_summary": ALERTS_SQL,
    "load_serving_reliability": RELIABILITY_SQL,
    "load_serving_security": THREATS_SQL,
    "load_rejects": _sql(
        f"""SELECT {RELIABILITY_COLUMNS}, 'location: longer than 8' AS violation FROM reliability
        WHERE length(location) > 8""",
        "reliability",
    ),
    # Streams: same rows as the batch functions
    "stream_source_kafka_shape": BRONZE_SQL,
    "stream_bronze": BRONZE_SQL,
    "stream_silver": SILVER_SQL,
    "stream_alerts": _sql(f"SELECT {ALERT_COLUMNS} FROM silver WHERE requires_action"),
    "stream_restart_no_dup": SILVER_SQL,
    "stream_equals_batch": _sql(
        """SELECT event_date, event_type, count(*) AS stream_rows, count(*) AS batch_rows, TRUE AS same_rows
        FROM silver GROUP BY event_date, event_type"""
    ),
    "stream_progress": "SELECT 0::BIGINT AS batch_id, count(*) AS input_rows FROM events",
    # Extensions
    "ext_dedup_events": SILVER_SQL,
    "ext_dedup_stream": SILVER_SQL,
    "ext_rejects": _sql(
        f"""SELECT kafka_key, kafka_partition, kafka_offset,
        CASE WHEN event_type = 'link_state' THEN 'tombstone' ELSE 'malformed' END AS reason,
        CASE WHEN event_type = 'security_alert' THEN left(record, length(record) // 2) END AS raw_value
        FROM (
          SELECT *, CAST(json_object(
              'event_id', event_id, 'event_type', event_type, 'device_id', device_id, 'device_type', device_type,
              'location', location, 'vendor', vendor, 'model', model, 'severity', severity, 'timestamp', "timestamp",
              'payload', json_object('alert_type', alert_type, 'source_ip', source_ip, 'destination_ip', destination_ip,
                'port', port, 'protocol', protocol, 'packet_count', packet_count)) AS VARCHAR) AS record
          FROM telemetry WHERE event_type IN ('link_state', 'security_alert'))"""
    ),
    "ext_critical_alerts": _sql(f"SELECT {ALERT_COLUMNS} FROM silver WHERE severity = 'CRITICAL'"),
    "ext_windowed_health": _sql(
        f"""SELECT CAST(event_date AS TIMESTAMP) + to_hours(event_hour) AS window_start,
        CAST(event_date AS TIMESTAMP) + to_hours(event_hour + 1) AS window_end,
        {HEALTH_COLUMNS.replace("event_date, event_hour,", "")}
        FROM health""",
        "health",
    ),
    "ext_windowed_reliability": _sql(
        f"SELECT event_hour, {RELIABILITY_COLUMNS} FROM reliability", "reliability"
    ).replace("device_type, event_date, count", "device_type, event_date, event_hour, count"),
    "ext_live_gold_alerts": ALERTS_SQL,
    "ext_live_gold_threats": THREATS_SQL,
    "gold_reliability_monthly": _sql(
        f"""SELECT CAST(date_trunc('month', event_date) AS DATE) AS period_start,
        {RELIABILITY_COLUMNS.replace("event_date, ", "")} FROM reliability""",
        "reliability",
    ).replace("device_type, event_date, count", "device_type, date_trunc('month', event_date) AS event_date, count"),
    "ext_sla_by_location": _sql(
        f"""SELECT event_date, CAST(count(*) FILTER (met) AS BIGINT) AS locations_meeting_sla,
        count(*) AS total_locations,
        {_round("CAST(count(*) FILTER (met) AS DOUBLE) / count(*) * 100", 1)} AS location_compliance_pct
        FROM (SELECT event_date, location, bool_and(sla_met) AS met FROM reliability GROUP BY event_date, location)
        GROUP BY event_date""",
        "reliability",
    ),
}
