"""What was committed: one small record per micro-batch, kept next to the tables.

A record is written after the batch's rows and before Spark commits the batch. A batch that is
replayed after a failure has the same number, so it replaces its rows and its record. Records lie in
folders of BLOCK batches; a reader that knows how far it came opens the blocks from there on only,
without any clock.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.config import EngineConfig
from netpulse.sources import folders

BLOCK = 1000

RECORD = (
    "writer string, batch_id bigint, bounds string, rows bigint, dates array<date>, undated bigint, "
    "null_event_ids bigint, invalid_severity bigint, null_severity bigint, latest_event_us bigint"
)

_MEASURED = ("rows", "undated", "null_event_ids", "invalid_severity", "null_severity", "latest_event_us")


class BatchLog:
    """Numbered JSON records per writer below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def _block(self, writer: str, number: int) -> str:
        return f"{self.root}/writer={writer}/block={number // BLOCK:09d}"

    def put(self, writer: str, number: int, record: Mapping, replace: bool = True) -> None:
        text = json.dumps({"writer": writer, "batch_id": number, **record}, default=str)
        folders.put_text(self.spark, f"{self._block(writer, number)}/{number:012d}.json", text, replace)

    def writers(self) -> list[str]:
        found = folders.children(self.spark, self.root)
        return [name.removeprefix("writer=") for name in found if name.startswith("writer=")]

    def last(self, writer: str) -> int:
        """The highest number of a writer, -1 if there is none; lists one block."""
        place = f"{self.root}/writer={writer}"
        for block in reversed([name for name in folders.children(self.spark, place) if name.startswith("block=")]):
            numbers = [int(n.removesuffix(".json")) for n in folders.children(self.spark, f"{place}/{block}") if n.endswith(".json") and n[0] != "."]
            if numbers:
                return max(numbers)
        return -1

    def reach(self) -> dict[str, int]:
        return {writer: self.last(writer) for writer in self.writers()}

    def records(self, after: Mapping[str, int] | None = None, upto: Mapping[str, int] | None = None) -> DataFrame:
        """Records of all writers, beyond ``after`` and up to ``upto`` where they name the writer."""
        after, upto = after or {}, upto or {}
        rows = self.spark.createDataFrame([], self.schema)
        for writer in self.writers():
            place, low = f"{self.root}/writer={writer}", after.get(writer, -1)
            blocks = [name for name in folders.children(self.spark, place) if name >= f"block={(low + 1) // BLOCK:09d}"]
            if not blocks:
                continue
            read = self.spark.read.schema(self.schema).json([f"{place}/{block}" for block in blocks])
            own = read.where(F.col("batch_id") > low)
            rows = rows.unionByName(own.where(F.col("batch_id") <= upto[writer]) if writer in upto else own)
        return rows

    def record(self, writer: str, number: int) -> dict | None:
        place = f"{self._block(writer, number)}/{number:012d}.json"
        if not folders.exists(self.spark, place):
            return None
        return self.spark.read.schema(self.schema).json(place).first().asDict()


class ForeignWriterError(RuntimeError):
    """A query that does not own a table's batches wants to write there."""


class Ledger:
    """Committed micro-batches of one table: which event dates they hold, and what their rows failed."""

    def __init__(self, spark: SparkSession, cfg: EngineConfig, table: str):
        self.log = BatchLog(spark, cfg.table(f"ledger/{table}"), RECORD)

    def claim(self, writer: str, batch_id: int, bounds: str) -> None:
        """Refuse a writer with another checkpoint, and a known batch number with other source bounds.

        Either would put rows beside those already there: a new checkpoint cuts the source into
        batches of its own, whose numbers say nothing about the batches on disk.
        """
        others = [name for name in self.log.writers() if name != writer]
        if others:
            raise ForeignWriterError(
                f"{self.log.root} holds batches of query {others[0]}; restore its checkpoint or rebuild the table"
            )
        known = self.log.record(writer, batch_id)
        if known is not None and known["bounds"] != bounds:
            raise ForeignWriterError(f"batch {batch_id} was written from {known['bounds']}, not from {bounds}")

    def record(self, writer: str, batch_id: int, bounds: str, measured: Mapping) -> None:
        self.log.put(
            writer,
            batch_id,
            {
                **{name: measured[name] for name in _MEASURED},
                "bounds": bounds,
                "dates": sorted(measured["dates"]),
            },
        )

    def reach(self) -> dict[str, int]:
        """The last committed batch per writer."""
        return self.log.reach()

    def dates(self, after: Mapping[str, int], upto: Mapping[str, int]) -> list[date | None]:
        """Event dates with rows of the batches between: one entry per day, None for rows without a date."""
        records = self.log.records(after, upto)
        days = records.select(F.explode("dates").alias("day")).unionByName(
            records.where("undated > 0").select(F.lit(None).cast("date").alias("day"))
        )
        return [row.day for row in days.distinct().collect()]

    def counts(self, after: Mapping[str, int], upto: Mapping[str, int]) -> tuple[dict[str, int], int | None]:
        """Failing rows of the batches between, as counted while they were written, and their latest event
        time in microseconds since 1970."""
        names = ("null_event_ids", "invalid_severity", "null_severity")
        total = self.log.records(after, upto).agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names], F.max("latest_event_us").alias("latest")
        )
        row = total.first()
        return {name: row[name] for name in names}, row.latest
