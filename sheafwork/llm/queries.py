"""The operators of this subpackage as queries over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chunk_dedup,
    hard_negatives,
    kneser_ney,
    langid,
    lexical,
    mixing,
    ngram_join,
    quality,
    sharding,
    suffix_array,
    topk,
    url_filter,
)

RANKS = "byte_bpe_multi_50k.tiktoken"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, labels, sizes=quality.SIZES, threshold=None)


@query
def op2_norm_bucketed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.train(docs.filter(~fold))
    found = langid.identified(docs.select("doc_id", "text", fold.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encoded(table(spark, sf_dir, "documents"), ranks_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.repeated_spans(table(spark, sf_dir, "documents"))
    span = found.select("doc_id", F.explode("spans").alias("span"))
    start, end = F.col("span.start"), F.col("span.end")
    return span.select(
        "doc_id",
        start.alias("start_word"),
        end.alias("end_word"),
        (end - start).alias("n_words"),
        F.col("span.first_doc_id").alias("first_doc_id"),
    )


@query
def op7_content_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    span = found.select("doc_id", F.explode("spans").alias("span"))
    start, end = F.col("span.start"), F.col("span.end")
    return span.select(
        "doc_id",
        start.alias("start_byte"),
        end.alias("end_byte"),
        (end - start).alias("n_bytes"),
        F.col("span.first_doc_id").alias("first_doc_id"),
    )


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    planned = mixing.with_copies(docs)
    return planned.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


@query
def op9_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    model = kneser_ney.train(docs.filter(~fold))
    found = kneser_ney.scored(docs.withColumn("held_out", fold), model)
    rounded = {name: F.round(name, 6) for name in ("base_score", "score")}
    return found.withColumns(rounded).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", *rounded)


@query
def op11_term_pipeline_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filter.listed_by_words(pages)
    return url_filter.judged(pages, listed).select("page_id", "host", "path", "rule", "verdict", "listed")
