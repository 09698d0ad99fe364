"""A corpus pipeline: whole documents in, token ids out, in stages that are written and read again.

Low quality goes, one document of each group of near copies stays, strings that repeat go, the sources are mixed to
their weights (documents may repeat then, each copy whole), and what is left becomes token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabsift.llm import byte_bpe, mixing, quality, repeats, set_join
from tabsift.llm.common import staged

KEY, REST = "document_row", "document_rest"


def _numbered(docs: DataFrame) -> DataFrame:
    """With a number for id and text: rows that share it are the same document."""
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(_numbered(docs), labels, keep=(KEY,))
    good = scored.where("predicted = 1").select(KEY).distinct()
    return _numbered(docs).join(good, KEY, "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar shingles the one of smallest id; equal rows count once."""
    numbered = _numbered(docs)
    groups = set_join.jaccard_groups(numbered, id_col=KEY)
    # The group's id is a row number; its document is the one of smallest doc_id (null last).
    rows = numbered.select(KEY, F.col("doc_id").isNull().alias("no_id"), "doc_id").join(groups.distinct(), KEY)
    first = rows.groupBy("component_id").agg(F.min(F.struct("no_id", "doc_id", KEY))[KEY].alias(KEY)).select(KEY)
    return numbered.join(first, KEY, "left_semi").dropDuplicates([KEY]).select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the strings of 200 bytes that occur more than once; cut characters go as well."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    packed = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in others)).alias(REST))
    left = repeats.remove_repeats(packed, keep=(REST,), whole_characters=True)
    changed = left.select("doc_id", F.col("kept").cast("string").alias("text"), f"{REST}.*").withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    numbered = _numbered(docs)
    mixed = mixing.mix_sources(numbered, keep=(KEY,), whole_copies=True).dropDuplicates([KEY])
    taken = mixing.repeat_documents(numbered, mixed, KEY)
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids and the hash of the text that they decode to."""
    encoded = byte_bpe.encode(
        docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), decode=True)
    return encoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", token_ids),
]
#: Learning and iterative stages have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{at}")
    return docs
