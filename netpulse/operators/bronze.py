"""Topic records to Bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.functions.events import event_time
from netpulse.functions.utc import utc_date
from netpulse.schemas import BRONZE, ENVELOPE_FIELDS, EVENT, RECORD_COLUMNS


def parse_records(records: DataFrame, payload: str = "map") -> DataFrame:
    """Decode key and JSON value into the event envelope, keeping the record's coordinates.

    A value that is not a JSON object yields a row whose envelope columns are all null. The payload
    is a map of texts, or a ``variant``.
    """
    return _decoded(records, payload).select(*RECORD_COLUMNS.values(), *EVENT.names)


def with_metadata(parsed: DataFrame) -> DataFrame:
    """Stamp ingestion time and source, and type the event time."""
    stamped = parsed.withColumns(
        {
            "_ingest_ts": F.current_timestamp(),
            "_batch_date": utc_date(F.current_timestamp()),
            "_source": F.lit(domain.SOURCE_LABEL),
            "event_ts": event_time(F.col("timestamp")),
        }
    )
    return stamped.select(*BRONZE.names)


def to_bronze(records: DataFrame, drop_rejects: bool = False, payload: str = "map") -> DataFrame:
    """Bronze rows of ``records``; ``drop_rejects`` leaves out what :func:`rejects` returns."""
    parsed = parse_records(records, payload)
    return with_metadata(parsed.filter(~_unreadable()) if drop_rejects else parsed)


def rejects(records: DataFrame) -> DataFrame:
    """Records without a usable event, with the raw value and the reason."""
    reason = F.when(F.col("raw_value").isNull(), "tombstone").otherwise("malformed")
    return (
        _decoded(records)
        .filter(_unreadable())
        .select(*RECORD_COLUMNS.values(), "raw_value", reason.alias("reason"))
    )


def _decoded(records: DataFrame, payload: str = "map") -> DataFrame:
    # The event is expanded by a generator instead of a projection: filters on event fields then stay
    # above the JSON parse. Below it, each would parse the value again.
    coordinates = [
        (F.col(name).cast("string") if name == "key" else F.col(name)).alias(alias)
        for name, alias in RECORD_COLUMNS.items()
    ]
    text = F.col("value").cast("string")
    event = _event_with_variant(text) if payload == "variant" else F.from_json(text, EVENT)
    return records.select(*coordinates, F.col("value").alias("raw_value"), F.inline(F.array(event)))


def _event_with_variant(text: Column) -> Column:
    parsed = F.transform(F.array(F.try_parse_json(text)), _envelope)  # parsed once, by the array's element
    return F.get(parsed, F.lit(0))


def _envelope(event: Column) -> Column:
    fields = [F.try_variant_get(event, f"$.{name}", "string").alias(name) for name in ENVELOPE_FIELDS]
    return F.struct(*fields, F.try_variant_get(event, "$.payload", "variant").alias("payload"))


def _unreadable() -> Column:
    return F.coalesce(*[F.col(name) for name in ENVELOPE_FIELDS], F.to_json("payload")).isNull()
