"""What every micro-batch of a stream did, kept as a table.

A listener gets the record of each finished micro-batch and writes it as one small JSON file, named by query,
run and batch, so that a record that is delivered again replaces itself.  Records outlive the query object,
which remembers its last hundred only.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from opslog.plans.upkeep import write_text

RECORD = """stream STRING, run STRING, batch BIGINT, started STRING, n_rows BIGINT, rows_per_second DOUBLE,
batch_millis BIGINT, write_millis BIGINT, watermark STRING, state_rows BIGINT, late_rows BIGINT"""


def record(progress) -> dict[str, object]:
    """The fields of a progress report that the table keeps; ``late_rows`` came behind the watermark."""
    took, states = progress.durationMs, progress.stateOperators
    return {
        "stream": progress.name or str(progress.id),
        "run": str(progress.runId),
        "batch": progress.batchId,
        "started": progress.timestamp,
        "n_rows": progress.numInputRows,
        "rows_per_second": progress.processedRowsPerSecond,
        "batch_millis": took.get("triggerExecution"),
        "write_millis": took.get("addBatch"),
        "watermark": progress.eventTime.get("watermark"),
        "state_rows": sum(s.numRowsTotal for s in states),
        "late_rows": sum(s.numRowsDroppedByWatermark for s in states),
    }


class ProgressTable(StreamingQueryListener):
    """``with ProgressTable(spark, path) as table: ...`` records all streams that run meanwhile."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()
        self.failed: list[str] = []
        self.changed = threading.Condition()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = record(event.progress)
        try:
            write_text(self.spark, f"{self.path}/run={row['run']}/batch-{row['batch']}.json", json.dumps(row))
        except Exception as error:  # a listener must not stop its stream: told by wait()
            self.failed.append(f"batch {row['batch']} of {row['stream']}: {error}")

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all its records are written."""
        query.awaitTermination()
        with self.changed:
            done = self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds)
        if self.failed or not done:
            raise RuntimeError(f"records are missing: {self.failed or 'the end was not reported'}")


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """All records.  ``batch_millis`` beyond the trigger's interval is a stream that falls behind."""
    rows = spark.read.schema(RECORD).json(f"{path}/run=*")
    return rows.withColumn("started", F.to_timestamp("started"))
