"""Concurrent users per bucket.

A client counts once per entity and second, however many of its sessions overlap;
a session covers ``[on, off)`` in whole seconds.

Work per step, with every group bounded by time and never by the number of rows:

* sessions are cut at chunk borders, and each (entity, client, chunk, second) is
  reduced to its longest session before the first shuffle;
* inside a (entity, client, chunk), at most one row per second, each session
  keeps only the part that earlier ones have not covered;
* covered parts become +1/-1 steps, summed per (entity, second);
* a running sum over the seconds of a (entity, chunk) gives the segments, which
  are averaged per bucket without going down to single seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.functions.timekeys import epoch
from opslog.operators.sequence import both_neighbours
from opslog.spec import Grain

HOUR_SECONDS = 3600
# Seconds that the session zone's full hours lie after those of UTC: 0 but in half-hour zones.
# Daylight saving moves clocks by full hours, so any fixed moment tells.
ZONE_SHIFT = (
    "pmod(unix_seconds(from_utc_timestamp(timestamp_seconds(1700000000), current_timezone())) - 1700000000, 3600)"
)


def segments(
    sessions: DataFrame,
    entity: Sequence[str],
    client: Sequence[str],
    on: str,
    off: str,
    chunk_seconds: int = HOUR_SECONDS,
) -> DataFrame:
    """``(entity, chunk, sec, len, users)``: stretches with a constant number of users."""
    start, stop, shift = F.col("_on"), F.col("_off"), F.expr(ZONE_SHIFT)
    cut = (
        sessions.select(*entity, *client, epoch(on).alias("_on"), epoch(off).alias("_off"))
        .filter(stop > start)
        .withColumn("chunk", F.explode(F.sequence(_div(start + shift, chunk_seconds), _div(stop - 1 + shift, chunk_seconds))))
        .withColumn("sec", F.greatest(start, F.col("chunk") * chunk_seconds - shift))
        .withColumn("_end", F.least(stop, (F.col("chunk") + 1) * chunk_seconds - shift))
        .groupBy("sec", "chunk", *entity, *client)
        .agg(F.max("_end").alias("_end"))
    )
    earlier = (
        Window.partitionBy("chunk", *entity, *client)
        .orderBy("sec")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    fresh = (
        cut.withColumn("_reach", F.max("_end").over(earlier))
        .withColumn("sec", F.greatest("sec", F.coalesce("_reach", "sec")))
        .filter(F.col("_end") > F.col("sec"))
    )
    steps = (
        fresh.select(
            *entity,
            "chunk",
            F.explode(
                F.array(
                    F.struct(F.col("sec").alias("sec"), F.lit(1).alias("step")),
                    F.struct(F.col("_end").alias("sec"), F.lit(-1).alias("step")),
                )
            ).alias("_s"),
        )
        .groupBy(F.col("_s.sec").alias("sec"), "chunk", *entity)
        .agg(F.sum("_s.step").alias("step"))
    )
    in_order = Window.partitionBy("chunk", *entity).orderBy("sec")
    # Windows name the chunk first: sorts compare it as a number before any text.
    chunk_end = (F.col("chunk") + 1) * chunk_seconds - shift
    return (
        steps.withColumns(
            {
                "users": F.sum("step").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
                "len": F.coalesce(F.lead("sec").over(in_order), chunk_end) - F.col("sec"),
            }
        )
        .filter(F.col("len") > 0)
        .drop("step")
    )


def concurrency(
    sessions: DataFrame,
    entity: Sequence[str],
    client: Sequence[str],
    on: str,
    off: str,
    grain: Grain,
    name: str = "ccu",
) -> DataFrame:
    """avg, min and max number of users per (bucket, entity) that has any session."""
    if grain.seconds is None:
        raise ValueError("the bucket must have a constant length")
    # A chunk is an hour of the session zone: it holds whole shorter buckets and lies in one longer one.
    parts = segments(sessions, entity, client, on, off)
    if grain.seconds < HOUR_SECONDS:
        parts = _split(parts, grain.seconds).withColumn("bucket", F.timestamp_seconds(F.col("slot") * grain.seconds))
    else:
        parts = parts.withColumn("bucket", grain.bucket(F.timestamp_seconds("sec")))
    # With the chunk among the keys, the rows are already where the running sum put them.
    chunk = ["chunk"] if grain.seconds <= HOUR_SECONDS else []
    whole = F.unix_seconds(F.col("bucket") + grain.step) - F.unix_seconds("bucket")
    covered = F.sum("len")
    return (
        parts.groupBy(*entity, *chunk, "bucket")
        .agg(
            (F.sum(F.col("users") * F.col("len")).cast("double") / whole).alias(f"avg_{name}"),
            F.when(covered < whole, F.lit(0)).otherwise(F.min("users")).alias(f"min_{name}"),
            F.max("users").alias(f"max_{name}"),
        )
        .select(
            "bucket",
            *entity,
            f"avg_{name}",
            f"min_{name}",
            f"max_{name}",
        )
    )


def concurrency_vector(
    sessions: DataFrame, entity: Sequence[str], client: Sequence[str], on: str, off: str, name: str = "ccu"
) -> DataFrame:
    """Per (minute, entity) with any session: the 60 counts and their avg, min, max."""
    parts = _split(segments(sessions, entity, client, on, off), 60)
    offset = F.col("sec") - F.col("slot") * 60
    rows = parts.groupBy(*entity, "chunk", "slot").agg(
        F.sort_array(F.collect_list(F.struct(offset.alias("at"), "len", "users"))).alias("runs")
    )
    # A chunk's first segment may start late; later ones follow without a gap.
    lead_in = F.array_repeat(F.lit(0).cast("bigint"), F.col("runs")[0]["at"].cast("int"))
    filled = F.flatten(
        F.transform("runs", lambda r: F.array_repeat(r["users"], r["len"].cast("int")))
    )
    vector = F.concat(lead_in, filled)
    out = rows.withColumn("seconds", vector)
    whole = F.aggregate("seconds", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return out.select(
        F.timestamp_seconds(F.col("slot") * 60).alias("bucket"),
        *entity,
        F.col("seconds").cast("array<int>").alias("seconds"),
        (whole.cast("double") / 60).alias(f"avg_{name}"),
        F.array_min("seconds").alias(f"min_{name}"),
        F.array_max("seconds").alias(f"max_{name}"),
    ).filter(F.col(f"max_{name}") > 0)


def sessions_from_marks(
    marks: DataFrame,
    keys: Sequence[str],
    ts: str,
    order_by: Sequence[str],
    chunk: Column,
    is_on: Column,
    timeout: int,
    lookahead: int | None = None,
) -> DataFrame:
    """Sessions from single ON and OFF marks.

    ON then OFF is one session.  An ON that another ON or nothing follows lasts
    until then, at most ``timeout`` seconds.  An OFF that another OFF or nothing
    precedes began at most ``lookahead`` seconds earlier.
    """
    lookahead = timeout if lookahead is None else lookahead
    marked = marks.withColumn("_on", is_on)
    linked = both_neighbours(marked, keys, order_by, chunk, [ts, "_on"], "_after", "_before")
    now = F.col(ts)
    after, before = F.col("_after")[ts], F.col("_before")[ts]
    closes = F.coalesce(~F.col("_after._on"), F.lit(False))
    on_end = F.when(closes, after).otherwise(F.least(after, now + _seconds(timeout)))
    orphan = ~F.col("_on") & F.coalesce(~F.col("_before._on"), F.lit(True))
    off_start = F.greatest(before, now - _seconds(lookahead))
    return (
        linked.filter(F.col("_on") | orphan)
        .withColumns(
            {
                "on_at": F.when(F.col("_on"), now).otherwise(off_start),
                "off_at": F.when(F.col("_on"), on_end).otherwise(now),
            }
        )
        .drop("_on", "_after", "_before")
    )


def still_open(sessions: DataFrame, at: Column, off: str = "off_at") -> DataFrame:
    """Sessions that the window which ends at ``at`` hands on to the next one."""
    return sessions.filter(F.col(off) > at)


def clipped(sessions: DataFrame, begin: Column, end: Column, on: str = "on_at", off: str = "off_at") -> DataFrame:
    """The part of every session that lies in ``[begin, end)``."""
    inside = sessions.filter((F.col(off) > begin) & (F.col(on) < end))
    return inside.withColumns({on: F.greatest(F.col(on), begin), off: F.least(F.col(off), end)})


def _seconds(n: int) -> Column:
    return F.expr(f"interval {int(n)} seconds")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def _split(parts: DataFrame, size: int) -> DataFrame:
    """Cut segments at bucket borders; a segment touches few buckets of its chunk."""
    end = F.col("sec") + F.col("len")
    return (
        parts.withColumn("_end", end)
        .withColumn("slot", F.explode(F.sequence(_div(F.col("sec"), size), _div(F.col("_end") - 1, size))))
        .withColumn("sec", F.greatest(F.col("sec"), F.col("slot") * size))
        .withColumn("len", F.least(F.col("_end"), (F.col("slot") + 1) * size) - F.col("sec"))
        .drop("_end")
    )
