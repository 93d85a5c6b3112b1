"""Writes to partitioned tables, snapshot files and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, large partitions split at run time.

    ``rebalance`` lets adaptive execution cut a hot hour into several files and
    merge the small ones, where a plain repartition would give it to one task.
    """
    return df.hint("rebalance", *by) if by else df


def save(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("dt", "hh"),
    mode: str = "overwrite",
    fmt: str = "parquet",
    **options: str,
) -> None:
    """Write a table.  ``overwrite`` replaces only the partitions ``df`` has rows for."""
    writer = balanced(df, partition_by).write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def save_raw(df: DataFrame, path: str, source: str) -> None:
    """A batch job's rows into a raw table beside streamed ones; writing a source again replaces its hours."""
    save(df.withColumn("batch", F.lit(source)), path, ["dt", "hh", "batch"])


def save_snapshot(df: DataFrame, path: str) -> None:
    """A dimension or the dashboard as ``|``-separated text.

    The number of files is Spark's choice: a small table ends as one, and none is
    forced through a single task.
    """
    df.write.mode("overwrite").csv(path, sep="|")


def export_csv(df: DataFrame, path: str) -> None:
    """Backup of a table: per day and hour, with a header."""
    save(df, path, fmt="csv", sep="|", header="true")


def index_rows(df: DataFrame, id_columns: Sequence[str] = (), newest_by: str | None = None) -> DataFrame:
    """What a search index stores: no partition columns and, with ids, one row per id."""
    rows = df.drop("dt", "hh")
    if not id_columns:
        return rows
    if newest_by is not None:
        rest = [c for c in rows.columns if c not in id_columns]
        pick = F.max_by(F.struct(*rest), F.struct(newest_by, F.struct(*rest))).alias("_r")
        rows = rows.groupBy(*id_columns).agg(pick).select(*id_columns, "_r.*")
    return rows.withColumn("id", F.concat_ws("_", *id_columns))


def save_index(df: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Hand rows of :func:`index_rows` to a search connector the cluster provides."""
    extra = {"es.mapping.id": "id"} if "id" in df.columns and fmt.startswith("org.elasticsearch") else {}
    df.write.format(fmt).options(**extra, **options).mode("append").save()


def save_jdbc(df: DataFrame, options: dict[str, str], table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def merge_snapshot(old: DataFrame | None, new: DataFrame, id_columns: Sequence[str], stamp: str) -> DataFrame:
    """Upsert by id: the row with the newest stamp of each id stays."""
    both = new if old is None else old.unionByName(new)
    rest = [c for c in new.columns if c not in id_columns]
    pick = F.max_by(F.struct(*rest), F.struct(F.col(stamp), F.struct(*rest))).alias("_r")
    return both.groupBy(*id_columns).agg(pick).select(*id_columns, "_r.*").select(*new.columns)
