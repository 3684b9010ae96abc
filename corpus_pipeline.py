"""The corpus pipeline: each stage takes (spark, docs, folder of the tables) and returns a DataFrame,
which is written as Parquet and read again as the next stage's `docs`.  All but the last return the columns of `documents`."""

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import decontamination, mixing, simhash, token_output, toxicity
from ebbtide.llm.common import known_to_workers, read_table, store

TOXIC = 0.5
REMEMBERED_WORDS, BLOCK_TOKENS, BATCH_BYTES = 100_000, 1 << 19, 1 << 19


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated probability of being toxic is below one half.  The score depends on the text alone."""
    return toxicity.below(docs, read_table(spark, sf_dir, "labels"), TOXIC)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within three bits, exact copies included."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated by epoch; the one on a source's cut ends there."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as Re-Pair blocks and read back: doc_id, start, n_tokens, ids_crc32 per document.  Workers that also
    serve the other stages hold smaller blocks and fewer words."""
    return token_output.write_and_read(docs, cached=REMEMBERED_WORDS, block_tokens=BLOCK_TOKENS, batch_bytes=BATCH_BYTES)


STAGES = [
    ("toxicity", reject_toxic),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

# The tokenizer, the trees and 64-bit hashes have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return docs
