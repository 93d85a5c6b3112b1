"""The queries of this subpackage over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.llm import (
    conversations,
    decontaminate,
    divergence,
    license_align,
    line_chunks,
    ngram_join,
    packing,
    pieces,
    search,
    secret_forest,
    tag_paths,
    toxicity,
    wavelet,
)
from opslog.llm.oracle import CONVERSATION_REPAIR, DIVERGENCE, NGRAM_JOIN
from opslog.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join", NGRAM_JOIN)
def op1(spark, sf_dir):
    return ngram_join.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_wavelet_matrix")
def op2(spark, sf_dir):
    manifest = wavelet.write_shards(table(spark, sf_dir, "documents"), wavelet.shard_folder(spark))
    return wavelet.read_shards(manifest)


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op3_line_chunk_dedup")
def op3(spark, sf_dir):
    kept = line_chunks.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines", "n_removed")


@query("op6_benchmark_decontamination")
def op6(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_toxicity")
def op9(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(*toxicity.labelled(documents, table(spark, sf_dir, "labels")))
    return toxicity.score(documents, model)


@query("op4_tag_path_ratios")
def op4(spark, sf_dir):
    return tag_paths.extract(table(spark, sf_dir, "pages"))


@query("op8_secret_forest")
def op8(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = secret_forest.fit(secret_forest.planted_findings(documents))
    found = secret_forest.candidates(documents, "source")
    return secret_forest.judge(found, model).select("doc_id", "word_no", "part", "value", "score", "predicted")


@query("op10_license_alignment")
def op10(spark, sf_dir):
    return license_align.licenses(table(spark, sf_dir, "documents"))


@query("op7_block_max_wand")
def op7(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    asked = documents.filter(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.search(documents, asked)


@query("op11_source_divergence", DIVERGENCE)
def op11(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op12_sentencepiece")
def op12(spark, sf_dir):
    ids = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    both = pieces.decode(ids.drop("text"))
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op13_conversation_repair", CONVERSATION_REPAIR)
def op13(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)
