"""Vectors as whole numbers, equal ones taken together, for the exact searches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import stored

SCALE = 256
# Rows that a search structure is fitted on.
SAMPLE = 1024
EXACT = 1 << 53


def whole(vectors: DataFrame, id_col: str, vec_col: str, *others: Column) -> DataFrame:
    """``vec_id, vector``, ``others``, and ``k1, k2``, which stand for the vector: each component the floor
    of 256 times it. Rows without an id and those whose vector is null, empty or holds a null or
    non-finite component are left out."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"), *others
    )
    fit = "vec_id IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    numbers = F.transform("vector", lambda x: F.floor(x * SCALE).cast("bigint"))
    rows = rows.filter(fit).withColumn("vector", numbers)
    return rows.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(2), "vector")})


def classes(rows: DataFrame, most: int, asks: DataFrame, *by: str) -> DataFrame:
    """Rows with equal vectors (and ``by``) as one: ``k1, k2``, ``by``, ``vector, ids`` (the ``most`` smallest,
    which is all that a list of so many best can take from it) and ``asks``, whether it is among ``asks``.

    Spark drops the rows beyond ``most`` before the shuffle, so copies never meet in one task.
    """
    key = ["k1", "k2", *by]
    order = Window.partitionBy(*key).orderBy("vec_id")
    few = rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= most)
    made = few.groupBy(*key).agg(F.any_value("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = asks.select(*key).distinct().withColumn("asks", F.lit(True))
    return made.join(asked, key, "left").withColumn("asks", F.coalesce("asks", F.lit(False)))


def sample(rows: DataFrame, most: int = SAMPLE) -> dict[int, np.ndarray]:
    """At most ``most`` vectors, by the lowest hashes, apart by their length."""
    some = rows.orderBy("k1", "k2").limit(most).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in some:
        by_size.setdefault(len(row.vector), []).append(row.vector)
    return {size: np.array(many, dtype=np.int64) for size, many in by_size.items()}


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where no sum reaches 2**53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def runs(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[object, pa.RecordBatch]]:
    """Slices of sorted batches within which the column has one value."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_pylist()
        at = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[at]:
                yield values[at], batch.slice(at, i - at)
                at = i


def without_own(best: DataFrame, asks: DataFrame, top: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` from the ``top + 1`` best ``k1, k2, score, vec_id, same`` of each asked
    class: every asking row's own row goes from them, once."""
    one = asks.select("k1", "k2", F.col("vec_id").alias("query_id")).distinct()
    mine = one.join(best, ["k1", "k2"]).withColumn("_own", F.col("same") & (F.col("vec_id") == F.col("query_id")))
    by = Window.partitionBy("query_id", "k1", "k2")
    mine = mine.withColumn("_nth", F.row_number().over(by.orderBy(F.desc("_own"))))
    mine = mine.filter(~(F.col("_own") & (F.col("_nth") == 1)))
    order = by.orderBy(F.desc("score"), "vec_id")
    return mine.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


__all__ = ["classes", "matrix", "products", "runs", "sample", "stored", "whole", "without_own"]
