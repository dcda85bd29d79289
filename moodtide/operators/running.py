"""Running sums along an order, for groups of any size.

A plain ``sum().over(partitionBy(key).orderBy(offset))`` puts a whole key into one task. Here the
order column is cut into buckets of ``2**bucket_bits``; running sums are taken inside (key, bucket),
and each bucket adds what the key's earlier buckets sum to. No task holds more of a key than one
bucket of rows, or that key's bucket totals: with 2**20 per bucket, 2**40 offsets per key make at
most 2**20 rows on either level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 20


def bucket_of(order: Column, bucket_bits: int) -> Column:
    return F.shiftright(order.cast("bigint"), bucket_bits)


def with_running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    sums: dict[str, Column],
    bucket_col: str,
    spans: Column | None = None,
) -> DataFrame:
    """Add the running sum of each of ``sums`` over ``keys``, up to and including the row.

    ``order_col`` is unique within ``keys``; ``bucket_col`` is its ``bucket_of``; keys are not null.
    Rows already partitioned by the bucket and some of the keys are not shuffled again for this.

    ``spans`` is a condition that holds on every row whose group reaches beyond its bucket, and
    depends on group and bucket only. All other groups are finished inside their bucket: just
    the spanning ones pay for bucket totals and for the join that brings earlier totals in.
    """
    rows = df.withColumns({f"_in_{name}": value for name, value in sums.items()})
    group = [*keys, bucket_col]
    inside = Window.partitionBy(*group).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    out = [c for c in df.columns if c not in sums]

    def local(part: DataFrame) -> DataFrame:
        return part.withColumns({name: F.sum(f"_in_{name}").over(inside) for name in sums})

    def carried_in(part: DataFrame) -> DataFrame:
        totals = part.groupBy(*group).agg(*[F.sum(f"_in_{name}").alias(f"_total_{name}") for name in sums])
        earlier = totals.withColumn("_buckets_before", F.count("*").over(before)).withColumns(
            {f"_before_{name}": F.sum(f"_total_{name}").over(before) for name in sums}
        )
        earlier = earlier.filter("_buckets_before > 0").select(*group, *[f"_before_{name}" for name in sums])
        joined = local(part).join(earlier, group, "left")
        return joined.withColumns({name: F.coalesce(F.col(f"_before_{name}"), F.lit(0)) + F.col(name) for name in sums})

    if spans is None:
        return carried_in(rows).select(*out, *sums)
    marked = rows.withColumn("_spans", F.coalesce(spans, F.lit(False)))
    alone = local(marked.filter(~F.col("_spans"))).select(*out, *sums)
    return alone.unionByName(carried_in(marked.filter("_spans")).select(*out, *sums))
