"""Bounded samples of labelled documents for the classifiers.

Only fitting uses a sample; scoring always covers every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, held_out: Column, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` documents that are labelled and not held out.

    The ids with the least hash are taken, so the choice neither depends on
    the order of rows nor on the cluster.  ``held_out`` is a condition on
    ``doc_id``.  An id with several labels has the largest.  The id list is
    broadcast: its size is bounded by ``rows``.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out)
             .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label")))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .select(F.coalesce("text", F.lit("")).alias("text"), "label"))


def partial_counts(df: DataFrame, fn, keys: str, sums: list[str]) -> DataFrame:
    """Group-by sums of the rows that ``fn(texts, rows)`` makes for each chunk of texts."""
    names = [k.split()[0] for k in keys.split(", ")]
    schema = ", ".join([keys, *[f"{s} long" for s in sums]])
    return (common.map_texts(df, "text", fn, schema, [c for c in df.columns if c != "text"])
            .groupBy(*names).agg(*[F.sum(s).alias(s) for s in sums]))
