"""The corpus pipeline: filter, deduplicate and decontaminate documents, then tokenise them.

Every stage takes what the one before kept, as written Parquet, and all but the last return the
columns of ``documents``. The last returns a row per document that is left: doc_id, n_tokens,
ids (little-endian unsigned 32-bit integers), ids_sha256, decoded_sha256.

There is no oracle SQL: the toxicity model is trained, and SQL has no tokenizer. The tests hold
``run`` against a brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graustein.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from graustein.llm.base import stored, table

ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the model is trained on the labelled ones among ``docs``."""
    return toxicity.kept(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (similarity 0.8) the document with the smallest id stays."""
    return near_dedup.keep_one(docs, 80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, and digests of them and of what they decode to."""
    import public_tokenizers  # only this stage needs the vocabulary files
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
