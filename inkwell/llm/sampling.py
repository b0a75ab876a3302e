"""Labelled rows, whole or in bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids that are broadcast to pick out texts; more are joined by a shuffle.
BROADCAST = 500_000


def agreed(labels: DataFrame, name: str) -> DataFrame:
    """doc_id and label, one row for each document that is labelled one way only."""
    some = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).alias("label"))
    one = some.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high"))
    return one.where("label = high").select("doc_id", F.col("label").cast("int").alias("label"))


def rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is among ids, however many these are."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, "doc_id", "left_semi")


def labelled_ids(labels: DataFrame, name: str, value: int, bound: int, where: Column | None = None) -> np.ndarray:
    """Sorted doc_ids of at most bound documents whose label is value, those with the least hashed ids; the bound also bounds the driver's part.

    A document that is labelled both ways is in no sample.
    """
    one = agreed(labels if where is None else labels.where(where), name).where(F.col("label") == value)
    rows = one.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).toPandas()
    return np.sort(rows["doc_id"].to_numpy(dtype=np.int64))


def member(ids: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Which of ids are in the sorted sample."""
    if not len(sample):
        return np.zeros(len(ids), dtype=bool)
    at = np.minimum(np.searchsorted(sample, ids), len(sample) - 1)
    return sample[at] == ids


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n."""
    return F.crc32(column.cast("string").cast("binary")) % n


def in_fold(column: Column, folds: int, held_out: int) -> Column:
    """Whether an id is of the held-out fold; a null id isn't."""
    return F.coalesce(crc32_mod(column, folds) == held_out, F.lit(False))
