"""A corpus pipeline over ``documents``: five of the operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each stage's rows as Parquet to the shared folder and
reads them again as the next stage's input.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ordermart.llm import common, decontamination, near_dedup, packing, substring_dedup, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; it learns from the labelled rows of ``documents``."""
    grammar = toxicity.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return toxicity.remove_toxic(docs, grammar)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without passages that an earlier one holds; ``n_chars`` follows the text."""
    cut = substring_dedup.remove_repeats(docs)
    return cut.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place: the pipeline's result."""
    return packing.pack(packing.pieces_of(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: None of the stages can be expressed in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
