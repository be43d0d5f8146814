"""Topic records: reading them from Kafka or from files, and encoding events into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.config import EngineConfig
from netpulse.schemas import ENVELOPE_FIELDS, KAFKA_RECORD


def _kafka_options(cfg: EngineConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.topic,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.min_partitions:
        options["minPartitions"] = str(cfg.min_partitions)
    return options


def stream_records(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """Unbounded records with the ``KAFKA_RECORD`` layout."""
    if cfg.record_source == "kafka":
        reader = spark.readStream.format("kafka").options(**_kafka_options(cfg))
        reader = reader.option("startingOffsets", cfg.starting_offsets)
        if cfg.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
        return reader.load().select(*KAFKA_RECORD.names)
    reader = spark.readStream.schema(KAFKA_RECORD)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.parquet(cfg.records_path)


def read_records(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """The records available now, as a batch."""
    if cfg.record_source == "kafka":
        return spark.read.format("kafka").options(**_kafka_options(cfg)).load().select(*KAFKA_RECORD.names)
    return spark.read.schema(KAFKA_RECORD).parquet(cfg.records_path)


def encode_events(
    events: DataFrame,
    *,
    partition: Column,
    offset: Column,
    timestamp: Column,
    topic: str = domain.TOPIC,
) -> DataFrame:
    """Events (envelope columns plus a struct or map ``payload``) as keyed JSON records.

    The key is the device, so a broker keeps each device's events in order. ``key`` and ``value``
    alone are what ``write.format("kafka")`` needs.
    """
    value = F.to_json(F.struct(*ENVELOPE_FIELDS, "payload"))
    return events.select(
        F.col("device_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )
