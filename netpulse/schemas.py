"""Row layouts: topic records, event envelope, payload extraction, serving contracts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


def _struct(*fields: tuple[str, str]) -> T.StructType:
    out = T.StructType()
    for name, kind in fields:
        out = out.add(name, kind, True)
    return out


# A record as the Kafka source delivers it; file landings use the same layout.
KAFKA_RECORD = _struct(
    ("key", "binary"),
    ("value", "binary"),
    ("topic", "string"),
    ("partition", "integer"),
    ("offset", "long"),
    ("timestamp", "timestamp"),
)

ENVELOPE_FIELDS = (
    "event_id",
    "event_type",
    "device_id",
    "device_type",
    "location",
    "vendor",
    "model",
    "severity",
    "timestamp",
)
EVENT = _struct(*[(name, "string") for name in ENVELOPE_FIELDS]).add(
    "payload", T.MapType(T.StringType(), T.StringType(), True), True
)

# Record column -> Bronze column.
RECORD_COLUMNS = {
    "key": "kafka_key",
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
}

# Payload key -> (Silver column, type), in column order. Fixed values.
PAYLOAD_COLUMNS = (
    ("cpu_utilization_pct", "cpu_utilization_pct", "double"),
    ("memory_utilization_pct", "memory_utilization_pct", "double"),
    ("temperature_celsius", "temperature_celsius", "double"),
    ("uptime_seconds", "uptime_seconds", "long"),
    ("interface", "interface_name", "string"),
    ("packet_loss_pct", "packet_loss_pct", "double"),
    ("bandwidth_utilization", "bandwidth_utilization", "double"),
    ("bytes_in", "bytes_in", "long"),
    ("bytes_out", "bytes_out", "long"),
    ("alert_type", "alert_type", "string"),
    ("source_ip", "source_ip", "string"),
    ("destination_ip", "destination_ip", "string"),
    ("protocol", "protocol", "string"),
    ("packet_count", "packet_count", "long"),
    ("state", "link_state", "string"),
    ("previous_state", "previous_state", "string"),
    ("reason", "link_down_reason", "string"),
)

BRONZE = _struct(
    ("kafka_key", "string"),
    ("kafka_topic", "string"),
    ("kafka_partition", "integer"),
    ("kafka_offset", "long"),
    ("kafka_timestamp", "timestamp"),
)
for _field in EVENT.fields:
    BRONZE = BRONZE.add(_field)
for _name, _kind in (
    ("_ingest_ts", "timestamp"),
    ("_batch_date", "date"),
    ("_source", "string"),
    ("event_ts", "timestamp"),
):
    BRONZE = BRONZE.add(_name, _kind, True)



def bronze_schema(payload: str = "map") -> T.StructType:
    """Bronze with its payload as a map of texts, or as a VARIANT that keeps types, nesting and unknown keys."""
    if payload == "map":
        return BRONZE
    return T.StructType([T.StructField(f.name, T.VariantType() if f.name == "payload" else f.dataType) for f in BRONZE.fields])


# Bronze columns that stop at Bronze (Alerts keep them).
SILVER_DROPS = ("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "_source")

DERIVED_COLUMNS = (
    ("severity_score", "integer"),
    ("requires_action", "boolean"),
    ("event_hour", "integer"),
    ("event_date", "date"),
    ("event_weekday", "integer"),
    ("sla_breach_risk", "boolean"),
    ("resource_anomaly", "boolean"),
    ("location_type", "string"),
    ("_silver_ts", "timestamp"),
)

ALERTS = T.StructType(
    [f for f in BRONZE.fields if f.name != "payload"]
    + _struct(*[(column, kind) for _, column, kind in PAYLOAD_COLUMNS], *DERIVED_COLUMNS).fields
)
SILVER = T.StructType([f for f in ALERTS.fields if f.name not in SILVER_DROPS])

CLOCK_COLUMNS = ("_ingest_ts", "_batch_date", "_silver_ts", "_gold_ts", "_sf_load_ts")


@dataclass(frozen=True)
class Field:
    """One serving column: type, longest text allowed, and whether null is refused."""

    name: str
    kind: str
    max_length: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Contract:
    """Declared layout of a serving table. ``keys`` identify a row; ``cluster_by`` orders files."""

    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    cluster_by: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, _struct((f.name, f.kind))[0].dataType, not f.required) for f in self.fields]
        )

    @property
    def gold_schema(self) -> T.StructType:
        """Layout of the Gold table behind this contract: zoned timestamps, no load time."""
        zoned = {"timestamp_ntz": "timestamp"}
        return _struct(*[(f.name, zoned.get(f.kind, f.kind)) for f in self.fields if f.name != "_sf_load_ts"])

    def with_limits(self, **limits: int) -> "Contract":
        """The same contract with other text limits for the named columns."""
        known = {f.name for f in self.fields}
        unknown = set(limits) - known
        if unknown:
            raise KeyError(f"no such column in {self.name}: {sorted(unknown)}")
        return replace(
            self,
            fields=tuple(replace(f, max_length=limits.get(f.name, f.max_length)) for f in self.fields),
        )


def _text(name: str, limit: int, required: bool = False) -> Field:
    return Field(name, "string", limit, required)


def _many(kind: str, *names: str) -> tuple[Field, ...]:
    return tuple(Field(name, kind) for name in names)


DEVICE_HEALTH_KPIS = Contract(
    "device_health_kpis",
    (
        _text("device_id", 20, required=True),
        _text("device_type", 30),
        _text("location", 50),
        _text("location_type", 20),
        Field("event_date", "date"),
        Field("event_hour", "integer"),
        *_many(
            "double",
            "avg_cpu_pct",
            "max_cpu_pct",
            "avg_memory_pct",
            "max_memory_pct",
            "avg_temp_celsius",
            "max_temp_celsius",
        ),
        *_many("long", "sample_count", "critical_count"),
        Field("health_score", "double"),
        _text("health_status", 20),
        Field("_gold_ts", "timestamp_ntz"),
        Field("_sf_load_ts", "timestamp_ntz"),
    ),
    keys=("device_id", "device_type", "location", "location_type", "event_date", "event_hour"),
    cluster_by=("event_date", "location"),
)

ALERT_SUMMARY = Contract(
    "alert_summary",
    (
        Field("event_date", "date"),
        _text("event_type", 30),
        _text("severity", 20),
        _text("location", 50),
        _text("location_type", 20),
        _text("device_type", 30),
        *_many("long", "alert_count", "affected_devices"),
        Field("alerts_per_device", "double"),
        *_many("timestamp_ntz", "first_alert_ts", "last_alert_ts", "_gold_ts", "_sf_load_ts"),
    ),
    keys=("event_date", "event_type", "severity", "location", "location_type", "device_type"),
    cluster_by=("event_date", "severity"),
)

NETWORK_RELIABILITY = Contract(
    "network_reliability",
    (
        _text("location", 50, required=True),
        _text("location_type", 20),
        _text("device_type", 30),
        Field("event_date", "date"),
        *_many("long", "total_events", "incident_count"),
        *_many("double", "avg_packet_loss", "max_packet_loss", "avg_bandwidth_util"),
        *_many("long", "device_count", "actionable_alerts"),
        *_many("double", "incident_rate_pct", "availability_pct"),
        Field("sla_met", "boolean"),
        *_many("timestamp_ntz", "_gold_ts", "_sf_load_ts"),
    ),
    keys=("location", "location_type", "device_type", "event_date"),
    cluster_by=("event_date", "location"),
)

SECURITY_THREATS = Contract(
    "security_threats",
    (
        Field("event_date", "date"),
        _text("alert_type", 60),
        _text("location", 50),
        _text("device_type", 30),
        _text("protocol", 10),
        *_many("long", "alert_count", "total_packets_flagged", "affected_devices", "critical_count"),
        _text("threat_level", 10),
        *_many("timestamp_ntz", "_gold_ts", "_sf_load_ts"),
    ),
    keys=("event_date", "alert_type", "location", "device_type", "protocol"),
    cluster_by=("event_date", "threat_level"),
)

CONTRACTS = {
    c.name: c for c in (DEVICE_HEALTH_KPIS, ALERT_SUMMARY, NETWORK_RELIABILITY, SECURITY_THREATS)
}
