"""Query monitoring: micro-batch progress as rows, in memory or as a table that outlives the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from netpulse.streaming.ledger import BatchLog

PROGRESS = (
    "query_id string, query_name string, batch_id bigint, batch_start string, "
    "input_rows bigint, input_rows_per_second double, processed_rows_per_second double, duration_ms bigint"
)
_NAMES = [column.split()[0] for column in PROGRESS.split(", ")]
#: Failures are logged under the query, numbered by the batch they ended.
_LOGGED = f"writer string, run_id string, {PROGRESS}"
_FAILED = "writer string, batch_id bigint, run_id string, exception string"


def _row(progress) -> tuple:
    return (
        str(progress.id),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        progress.durationMs.get("triggerExecution"),
    )


def progress_rows(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """The recent micro-batches Spark keeps for each query (about a hundred), one row per batch."""
    rows = [_row(progress) for query in queries for progress in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS)


class ProgressTable(StreamingQueryListener):
    """Keeps the progress of every query of a session; register with ``spark.streams.addListener``.

    Each batch becomes a small record below ``root`` as it ends, so nothing is held in memory and all
    batches of all drivers that wrote there are found again. A batch that is reported again, by an
    idle trigger or after a restart, replaces its record.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.batches = BatchLog(spark, f"{root}/batches", _LOGGED)
        self.failures = BatchLog(spark, f"{root}/failures", _FAILED)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = dict(zip(_NAMES, _row(progress)))
        if row["input_rows"] or "addBatch" in progress.durationMs:  # a batch ran; a trigger may find nothing
            self.batches.put(row["query_id"], row["batch_id"], {**row, "run_id": str(progress.runId)})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            query = str(event.id)
            at = self.batches.last(query) + 1
            self.failures.put(query, at, {"run_id": str(event.runId), "exception": event.exception})

    def settle(self) -> None:
        """Wait until events that were posted so far are logged; the listener runs behind the queries."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def rows(self, query_id: str | None = None) -> DataFrame:
        """One row per query and batch."""
        found = self.batches.records().select(*_NAMES)
        return found if query_id is None else found.where(F.col("query_id") == query_id)
