"""Watermarked statistics for metrics whose parts add up, and query progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed(
    rows: DataFrame, ts: str, delay: str, bucket: str, keys: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Aggregates per bucket; in append mode a bucket appears once it is ``delay`` old."""
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    grouped = timed.groupBy(F.window(ts, bucket).alias("_w"), *keys).agg(*measures)
    return grouped.select(F.col("_w.start").alias("bucket"), *[c for c in grouped.columns if c != "_w"])


def progress(query: StreamingQuery) -> list[dict[str, object]]:
    """Per micro-batch: number, input rows and time spent, as the query reports them."""
    out = []
    for p in query.recentProgress:
        out.append(
            {
                "batch": p["batchId"],
                "rows": p["numInputRows"],
                "millis": p.get("durationMs", {}).get("triggerExecution"),
                "watermark": p.get("eventTime", {}).get("watermark"),
            }
        )
    return out
