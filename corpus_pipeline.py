"""The corpus pipeline: documents in, packed training sequences out, in five stages.

Each stage reads what its predecessor kept, as Parquet in the shared scratch folder, and decides
by one operator: toxic documents go, repeated passages are cut out of texts, one document of
each group of near copies stays, documents with benchmark items go, the rest is packed.

The Python workers outlive the stages, and of what they keep for one stage the allocator gives less
than half back afterwards.  So each stage gets small batches here, and packing remembers fewer pieces
of text than it does by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.llm import decontaminate, line_chunks, ngram_join, packing, toxicity
from opslog.llm.common import saved
from opslog.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
BATCH_ROWS = 2500  # some 8 MB of text
REMEMBERED = 400_000  # pieces of text that the packing stage keeps in a worker


def small_batches(stage: Stage) -> Stage:
    """The stage with batches of ``BATCH_ROWS`` for its workers."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a toxicity score under the threshold; without labels of both kinds all rows stay."""
    model = toxicity.train(*toxicity.labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.without_toxic(docs, model)


@small_batches
def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; a document of which nothing is left goes."""
    cut = line_chunks.dedup_lines(docs)
    removed = F.col(cut.columns[-1])
    kept = cut.filter((removed == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        chars = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


@small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies; rows without an id stay."""
    groups = ngram_join.similar_documents(docs)
    copies = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


@small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_lines),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]
ORACLE_SQL = None  # none of the stages can be written in SQL; tests hold each against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
