"""Statistics of a live stream that need more than one sum: pairs, uniques, rates, zero fill.

Each is a chain of watermarked aggregations in append mode.  A window's result is final when it appears, so
the next aggregation may take the window's own time as its event time: it closes in the same micro-batch.
State is one row per key and open window, and goes when the watermark passes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opslog.operators.dims import calendar, zero_fill
from opslog.operators.pairing import REQUEST, SUCCESS, pair_rate
from opslog.plans.upkeep import drop_folders, partitions, read_text, write_text
from opslog.sinks.tables import save
from opslog.spec import ALL, Grain, Level
from opslog.streaming.ingest import batch_name, paced

SETTLED = "settled"  # event time of a result: the end of the window that made it final


def timed(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """``rows`` with ``ts`` as event time; rows more than ``delay`` behind the newest one are late."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def pair_stream(
    log: DataFrame,
    session: Sequence[str],
    order_by: Sequence[str],
    horizon: int,
    delay: str,
    entity_from: str = "response",
    require_entity: bool = True,
) -> DataFrame:
    """``pair_requests`` on a stream: requests whose next row of the session is at most ``horizon`` seconds later.

    ``order_by`` starts with the event time and is unique in a session.  Rows of a session meet in windows of two
    horizons, one sliding over the next by one: every request of a window's first half finds there all
    rows that may answer it.  So the state is two short lists of rows per session and no row is compared with
    another one but its neighbour.  A request is settled one horizon after its own horizon ends.
    """
    ts = order_by[0]
    slide = F.window(ts, f"{2 * horizon} seconds", f"{horizon} seconds").alias("_w")
    row = F.struct(*order_by, "mode", "server_ip", "result")
    lists = timed(log, ts, delay).groupBy(slide, *session).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    limit = f"interval {int(horizon)} seconds"
    named = "AND length(p.answer.server_ip) > 0" if require_entity else ""
    found = F.expr(
        f"""filter(transform(_rows, (r, i) -> struct(r AS asked, get(_rows, i + 1) AS answer)), p ->
          p.asked.mode = '{REQUEST}' AND p.answer IS NOT NULL {named}
          AND p.asked.{ts} < _w.start + {limit} AND p.answer.{ts} <= p.asked.{ts} + {limit})"""
    )
    pairs = lists.select(F.window_time("_w").alias(SETTLED), *session, F.explode(found).alias("_p"))
    side = "answer" if entity_from == "response" else "asked"
    return pairs.select(
        SETTLED,
        *session,
        *[F.col(f"_p.asked.{c}").alias(c) for c in order_by],
        F.col(f"_p.{side}.server_ip").alias("server_ip"),
        F.coalesce(F.col("_p.answer.result") == SUCCESS, F.lit(False)).cast("int").alias("success"),
    )


def pair_rate_stream(pairs: DataFrame, keys: Sequence[str], horizon: int) -> DataFrame:
    """Counts and success rate of ``pair_stream`` per bucket of one horizon."""
    window = F.window(SETTLED, f"{int(horizon)} seconds").alias("_w")
    stats = pair_rate(pairs, [window, *keys])
    # A bucket's requests settle in the window after it.
    bucket = F.col("_w.start") - F.expr(f"interval {int(horizon)} seconds")
    return stats.select(bucket.alias("bucket"), *[c for c in stats.columns if c != "_w"])


def unique_stream(
    events: DataFrame, ts: str, delay: str, bucket: str, levels: Sequence[Level], client: str
) -> DataFrame:
    """uv and pv per bucket and entity of every level: first one row per client, then a count of those."""
    ids = list(dict.fromkeys(c for level in levels for c in level.ids))
    variants = [
        F.struct(F.lit(level.name).alias("level"), *[(F.col(c) if c in level.ids else F.lit(ALL)).alias(c) for c in ids])
        for level in levels
    ]
    placed = timed(events, ts, delay).select(ts, client, F.explode(F.array(*variants)).alias("_e"))
    placed = placed.select(ts, client, "_e.*")
    visits = placed.groupBy(F.window(ts, bucket).alias("_w"), "level", *ids, client).agg(F.count(F.lit(1)).alias("views"))
    again = visits.select(F.window_time("_w").alias(SETTLED), "level", *ids, "views")
    stats = again.groupBy(F.window(SETTLED, bucket).alias("_w"), "level", *ids).agg(
        F.count(F.lit(1)).alias("uv"), F.sum("views").alias("pv")
    )
    return stats.select(F.col("_w.start").alias("bucket"), "level", *ids, "uv", "pv")


def rate_stream(
    rows: DataFrame, ts: str, delay: str, entity: Sequence[str], slot: Grain, bucket: Grain, name: str = "tps"
) -> DataFrame:
    """``rate_per_slot`` on a stream: rows per slot, then average, minimum (0 unless every slot has rows) and maximum per bucket."""
    if bucket.seconds is None or slot.seconds is None:
        raise ValueError("slots must divide a bucket of constant length")
    slots = bucket.seconds // slot.seconds
    per_slot = timed(rows, ts, delay).groupBy(F.window(ts, f"{slot.seconds} seconds").alias("_w"), *entity).agg(F.count(F.lit(1)).alias("n"))
    again = per_slot.select(F.window_time("_w").alias(SETTLED), *entity, "n")
    stats = again.groupBy(F.window(SETTLED, f"{bucket.seconds} seconds").alias("_w"), *entity).agg(
        (F.sum("n").cast("double") / slots).alias(f"avg_{name}"),
        F.when(F.count(F.lit(1)) == slots, F.min("n")).otherwise(F.lit(0)).cast("bigint").alias(f"min_{name}"),
        F.max("n").alias(f"max_{name}"),
    )
    return stats.select(F.col("_w.start").alias("bucket"), *entity, f"avg_{name}", f"min_{name}", f"max_{name}")


# ---- zero fill --------------------------------------------------------------


def high_water(rows: DataFrame, path: str, name: str | None = None) -> int | None:
    """Start of the last bucket (epoch seconds) that batches other than ``name`` have filled."""
    found = [f for v, f in partitions(rows.sparkSession, f"{path}/marks", 1) if v["batch"] != name]
    marks = [json.loads(read_text(rows.sparkSession, f"{f}/mark"))["bucket"] for f in found]
    return max(marks, default=None)


def _fill(batch: DataFrame, dim: DataFrame, keys: Sequence[str], zeros: dict, grain: Grain, path: str, name: str) -> None:
    """One micro-batch of closed buckets, filled from the last stored bucket on."""
    spark = batch.sparkSession
    before = high_water(batch, path, name)
    new = batch if before is None else batch.filter(F.col("bucket") > F.timestamp_seconds(F.lit(before)))
    low, high = new.agg(F.unix_seconds(F.min("bucket")), F.unix_seconds(F.max("bucket"))).first()
    if high is None:
        return
    at = F.timestamp_seconds(F.lit(low)) if before is None else F.timestamp_seconds(F.lit(before)) + grain.step
    frame = calendar(dim, at, F.timestamp_seconds(F.lit(high)) + grain.step, grain)
    save(zero_fill(new, frame, ["bucket", *keys], zeros).withColumn("batch", F.lit(name)), f"{path}/rows", ["batch"])
    write_text(spark, f"{path}/marks/batch={name}/mark", json.dumps({"bucket": high}))
    old = sorted((f for v, f in partitions(spark, f"{path}/marks", 1) if v["batch"] != name), key=len)
    keep = {f for f in old if json.loads(read_text(spark, f"{f}/mark"))["bucket"] == before}
    drop_folders(spark, [f for f in old if f not in keep])


def fill_closed(
    stats: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    zeros: dict[str, object],
    grain: Grain,
    path: str,
    checkpoint: str,
    source: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Append-mode statistics into ``path``/rows with a row for every device of ``dim`` in every closed bucket.

    A bucket that appears is closed, and so are all before it.  What a micro-batch adds are the buckets after
    the stored high-water mark up to its newest one, each exactly once: the mark is stored after the
    rows, and a batch that is tried again replaces its own rows and starts from the mark of the batch before.
    Empty buckets after the newest row wait for the next row; a new checkpoint goes on from the mark.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "run"
        held = batch.persist()
        try:
            _fill(held, dim, keys, zeros, grain, path, batch_name(source, run, batch_id))
        finally:
            held.unpersist()

    writer = stats.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return paced(writer, available_now).start()


def filled(spark, path: str) -> DataFrame:
    """What ``fill_closed`` has written."""
    return spark.read.parquet(f"{path}/rows").drop("batch")

