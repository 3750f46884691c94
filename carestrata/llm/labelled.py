"""Bounded samples of labelled texts, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labels_of(labels: DataFrame, label_col: str, id_col: str, modulus: int, held_out: int) -> DataFrame:
    """(_id, _label), one row per id that may be learnt from.

    Ids in the held-out fold, null ids and null labels are left out; an id labelled
    twice has the larger label.
    """
    return (
        labels.where(id_remainder(id_col, modulus) != held_out)
        .where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    )


def seeded_first(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` ids, in an order that depends on the ids alone."""
    return ids.orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(most)


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of a bounded set of ids, with the columns of that set.

    ``chosen`` has at most as many rows as the sample's bound, so it is broadcast.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(chosen), "_id")
