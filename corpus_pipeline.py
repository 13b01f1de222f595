"""A training-data pipeline: toxicity, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes what its predecessor kept and, but for the last, returns rows of documents with all
their columns. No stage moves a text more than twice: toxicity is one pass without a shuffle, the two
dedup stages join texts with the ids that stay, mixing places and then sorts them, packing places
them again, as the order of rows does not outlive reading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.llm import exact_dedup, mixing, packing, simhash, toxicity
from aerometer.llm.common import free_names, new_path, read, text_of
from aerometer.llm.queries import id_remainder, vocabulary


#: The mixing of stages 4 and 5; it follows from the rows alone, so both find the same slots.
MIXED = {"power": 0.5, "block": 1 << 16, "period": 1024}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled rows scores below one half.

    A null text is empty and stays, like any text that is not rejected; very long texts are scored whole;
    repeated rows and ties share one score; null ids stay; without labels of both classes nothing is
    rejected; an empty table gives none.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), id_remainder(5) == 0)
    (score,) = free_names(docs, "_score")
    return model.scored(docs, score, text_of()).where(F.col(score) < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays.

    A null text counts as empty; null ids lose to all others; of rows equal in id and text the smallest by
    its other columns stays; an empty table gives none.
    """
    return exact_dedup.keep_new(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup over 3-word shingles at 2 bits: of each component the smallest doc_id stays.

    Null and empty texts share fingerprint zero; null ids come last; of rows that share the smallest id the one
    whose text hash is smallest stays; texts of any length are read whole; an empty table gives none.
    """
    return simhash.keep_one(docs, shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves sources by the square root of their size.

    A null source is a source of its own; null and empty texts count one; a text longer than a block takes
    the slots it fills; repeated rows are all placed; an empty table gives none.
    """
    return mixing.in_order(docs, **MIXED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens, which follow the order of the mixed sources.

    A null text is empty and has its end token; long texts are cut, every token lies in one piece; repeated
    rows and null ids are packed each; an empty table gives none.
    """
    mixed = mixing.mix(docs, **MIXED)
    slot, place = mixed.columns[-2:]
    return packing.pack(mixed, vocabulary(), window=2048, order=(slot, place))


STAGES = [
    ("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources), ("packing", pack_sequences),
]
#: Tokenization, training and link following have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
