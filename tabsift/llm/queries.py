"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabsift.llm import (
    byte_bpe, centroids, fingerprints, licenses, mixing, near_vectors, packing, quality, repeats, set_join, spelling, token_counts, top_k,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_repeats(spark, sf):
    found = repeats.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_set_join(spark, sf):
    return set_join.jaccard_groups(table(spark, sf, "documents"))


@query
def op3_mix_sources(spark, sf):
    mixed = mixing.mix_sources(table(spark, sf, "documents"), whole_copies=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_top_k(spark, sf):
    return top_k.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op5_byte_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), decode=True)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_quality(spark, sf):
    return quality.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op7_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_packing(spark, sf):
    packed = packing.pack_tokens(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN)
    return packed.withColumn("ids_sha256", F.sha2("input_ids", 256)).drop("input_ids")


@query
def op9_near_vectors(spark, sf):
    return near_vectors.near_vectors(table(spark, sf, "embeddings"))


@query
def op10_licenses(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    line = lambda c: F.array_join(F.array_sort(c), " ")
    return found.select("doc_id", line("sentence_ids").alias("sentence_ids"), line("licenses").alias("licenses"))


@query
def op11_centroids(spark, sf):
    return centroids.cluster_vectors(table(spark, sf, "embeddings"))


@query
def op12_fingerprints(spark, sf):
    return fingerprints.fingerprint_documents(table(spark, sf, "documents"))


@query
def op13_spelling(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))
