"""From raw documents to token-id shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the shared folder and
hands the table read back to the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluicegate.llm import decontaminate, frames, mixing, quality, simhash
from sluicegate.llm.base import removed_at_exit, ship, stored
from sluicegate.registered.base import table
from sluicegate.session import scratch_dir


#: Bytes of a batch of rows that goes to Python: less than for an operator alone, as workers hold on to memory between stages.
BATCH_BYTES = 2 << 20


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant does not reject."""
    ship(spark, BATCH_BYTES)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of five-word shingles are linked."""
    ship(spark, BATCH_BYTES)
    return simhash.one_of_each(docs, words=5, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without leaked benchmark items."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit_copies(mixing.mix_sources(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the shards, read back from them."""
    ship(spark, BATCH_BYTES)
    folder = removed_at_exit(spark, scratch_dir(spark, "token-ids"))
    manifest = frames.write_token_ids(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), keep=False)
    return frames.scan_shards(manifest, frames.crc32).withColumnRenamed("value", "ids_crc32")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: Fingerprints, components and tokenizers have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), "pipeline-result")
