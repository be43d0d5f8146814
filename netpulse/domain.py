"""Fixed values of the telemetry domain.

Names, thresholds and labels below are part of the data contract: results are only comparable
with other consumers of the same topic when they are kept exactly as they are.
"""

# --- fixed values: vocabulary ------------------------------------------------------------------
DEVICE_HEALTH = "device_health"
INTERFACE_STATS = "interface_stats"
SECURITY_ALERT = "security_alert"
LINK_STATE = "link_state"
EVENT_TYPES = (DEVICE_HEALTH, INTERFACE_STATS, SECURITY_ALERT, LINK_STATE)

INFO, WARNING, ERROR, CRITICAL = "INFO", "WARNING", "ERROR", "CRITICAL"
SEVERITIES = (INFO, WARNING, ERROR, CRITICAL)
INCIDENT_SEVERITIES = (CRITICAL, ERROR)
SEVERITY_SCORES = {CRITICAL: 4, ERROR: 3, WARNING: 2}
DEFAULT_SEVERITY_SCORE = 1

LINK_DOWN = "down"
LINK_FLAPPING = "flapping"
DATA_CENTER_PREFIX = "DC"
DATA_CENTER, BRANCH = "Data Center", "Branch"

# --- fixed values: severity rules, metric -> (WARNING above, CRITICAL above) ---------------------
METRIC_LIMITS = {
    DEVICE_HEALTH: {
        "cpu_utilization_pct": (75, 90),
        "memory_utilization_pct": (75, 90),
        "temperature_celsius": (70, 80),
    },
    INTERFACE_STATS: {
        "packet_loss_pct": (5, 10),
        "bandwidth_utilization": (80, 95),
    },
}
CRITICAL_ALERT_TYPES = ("ddos_signature_matched", "unauthorized_access_attempt")
ERROR_ALERT_TYPES = ("port_scan_detected",)

# --- fixed values: KPI parameters ----------------------------------------------------------------
ANOMALY_PCT = 85
CPU_WEIGHT, MEMORY_WEIGHT = 0.40, 0.30
TEMP_BASE_C, TEMP_RANGE_C, TEMP_WEIGHT = 30, 50, 30
HEALTH_BANDS = ((80, "Healthy"), (60, "Degraded"))
HEALTH_FLOOR_LABEL = "Critical"
SLA_TARGET_PCT = 99.9
HIGH_THREAT_CRITICALS, MEDIUM_THREAT_ALERTS = 5, 10

# --- fixed values: topic -------------------------------------------------------------------------
TOPIC = "network-events"
TOPIC_PARTITIONS = 3
SOURCE_LABEL = "kafka"
