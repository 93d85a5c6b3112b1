"""Streaming ingestion: lines to partitioned raw tables.

Offsets and progress live in each query's checkpoint.  Every micro-batch of a raw table is written
under its own ``batch`` folder, named after the source, the run (the id that a checkpoint gives its query)
and the batch: a batch that is tried again replaces what its first try left behind, and other sources and
batch jobs that feed the same table never meet it.  No log of the file sink lies under the tables, so
retention, backfills and deletes may touch any folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from opslog.ingest.envelope import accepted, rejected
from opslog.ingest.metrics import host_metrics, switch_metrics
from opslog.plans.upkeep import drop_folders, partitions
from opslog.sinks.tables import save

BATCH_SECONDS = 10  # fixed value: the micro-batch interval of both applications
Parser = Callable[[DataFrame], DataFrame]
RESTARTS = ("refuse", "replace", "continue")


def paced(writer: DataStreamWriter, available_now: bool, seconds: int = BATCH_SECONDS) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def append(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, partition_by=("dt", "hh")
) -> StreamingQuery:
    """Append a stream through the file sink, for results that nothing but the stream touches."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return paced(writer, available_now).start(path)


def batch_name(source: str, run: str, batch_id: int) -> str:
    if not source or any(c in source for c in "./="):
        raise ValueError(f"{source!r} is no name for a source")
    return f"{source}.{run}.{batch_id}"


def write_batch(rows: DataFrame, path: str, name: str, partition_by=("dt", "hh")) -> None:
    """One micro-batch of one table; writing it again replaces it."""
    save(rows.withColumn("batch", F.lit(name)), path, [*partition_by, "batch"])


def _other_runs(rows: DataFrame, path: str, source: str, run: str, depth: int) -> list[str]:
    """Folders that an earlier checkpoint of the same source has written."""
    found = partitions(rows.sparkSession, path, depth)
    old = (f"{source}.", f"compact.{source}.")
    return [f for v, f in found if v["batch"].startswith(old) and not v["batch"].startswith(f"{source}.{run}.")]


def _begin(batch: DataFrame, batch_id: int, source: str, tables: dict[str, int], restart: str) -> str:
    """The run's id; at its first batch what an earlier run left is refused, replaced or kept."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "run"
    if batch_id == 0 and restart != "continue":
        old = [f for path, depth in tables.items() for f in _other_runs(batch, path, source, run, depth)]
        if old and restart == "refuse":
            raise RuntimeError(f"{source} has rows of another checkpoint, e.g. {old[0]}: replace them or continue beside them")
        drop_folders(batch.sparkSession, old)
    return run


def ingest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    source: str,
    available_now: bool = False,
    partition_by=("dt", "hh"),
    restart: str = "refuse",
) -> StreamingQuery:
    """A stream into a raw table that upkeep and backfills share.

    ``restart`` says what a new checkpoint of a known source does: ``refuse``, ``replace`` the rows of
    the earlier one (a full replay), or ``continue`` beside them (it starts at later lines).
    """
    if restart not in RESTARTS:
        raise ValueError(f"restart is one of {RESTARTS}")

    def write(batch: DataFrame, batch_id: int) -> None:
        run = _begin(batch, batch_id, source, {path: len(partition_by) + 1}, restart)
        write_batch(batch, path, batch_name(source, run, batch_id), partition_by)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return paced(writer, available_now).start()


def fan_out(
    lines: DataFrame,
    parse: Parser,
    split: Callable[[DataFrame], dict[str, DataFrame]],
    root: str,
    checkpoint: str,
    source: str,
    available_now: bool = False,
    restart: str = "refuse",
) -> StreamingQuery:
    """Parse each micro-batch once and write it to several tables and the quarantine.

    ``source`` names the stream (a topic): several of them may feed the same tables.
    ``restart`` as in ``ingest``.
    """
    if restart not in RESTARTS:
        raise ValueError(f"restart is one of {RESTARTS}")

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch).persist()
        try:
            tables = split(accepted(parsed))
            depths = {**{f"{root}/{name}": 3 for name in tables}, f"{root}/quarantine": 1}
            name_of = batch_name(source, _begin(batch, batch_id, source, depths, restart), batch_id)
            for name, rows in tables.items():
                write_batch(rows, f"{root}/{name}", name_of)
            write_batch(rejected(parsed), f"{root}/quarantine", name_of, ())
        finally:
            parsed.unpersist()

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return paced(writer, available_now).start()


def one_table(name: str) -> Callable[[DataFrame], dict[str, DataFrame]]:
    return lambda rows: {name: rows}


def agent_tables(rows: DataFrame) -> dict[str, DataFrame]:
    return host_metrics(rows)


def switch_table(rows: DataFrame) -> dict[str, DataFrame]:
    return {"network": switch_metrics(rows)}


def forward(lines: DataFrame, fmt: str, options: dict[str, str], checkpoint: str, available_now: bool = False):
    """Send lines on, e.g. alerts to a Kafka topic; nothing passes the driver."""
    writer = lines.select("value").writeStream.format(fmt).options(**options)
    return paced(writer.option("checkpointLocation", checkpoint), available_now).start()
