"""Places and running sums over groups of any size, by range partitions of the whole sort key.

Rows are dealt by Spark's range partitioner, whose bounds it samples from the rows themselves, sorted inside each
partition and written once; so rows that share a first letter, a day or a group never share a task for that. A row's
number then tells its partition and its place there. Of each partition only counts or sums are added up, a row for each
group that it holds, and the carry of earlier partitions is joined back. Rows equal in the whole key stay in one
partition unless `order` ends with something that tells them apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.sources.scratch import written

#: monotonically_increasing_id: the partition is above these bits, the place in it below.
_BITS = 33


def ranged(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """`rows` written in the order of (group, order), with `_part`, their range partition, and `_at`, their place in it from 0."""
    by = [*(F.asc_nulls_first(c) for c in group), *order]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    # The partitions' bounds are sampled anew in each run of the plan: everything below must see one run.
    held = written(sorted_rows, "ranged")
    return held.select(*rows.columns, F.shiftright("_id", _BITS).cast("int").alias("_part"), F.col("_id").bitwiseAND((1 << _BITS) - 1).alias("_at"))


def _carried(parts: DataFrame, group: Sequence[str], value: Column) -> DataFrame:
    """`parts`, a row for each group and partition, with `carry`, the sum of `value` over the group's earlier partitions.

    A group has at most as many rows here as there are partitions.
    """
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumn("carry", F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def _joined(held: DataFrame, parts: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`held` with `columns` of `parts`; without a group that is a row a partition, which is broadcast."""
    right = parts.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], *columns)
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return held.join(right if group else F.broadcast(right), same)


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """`rows` numbered from 1 in each group, in column `name`."""
    held = ranged(rows, group, order)
    parts = held.groupBy(*group, "_part").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    offset = _carried(parts, group, F.col("n")).withColumn("offset", F.col("carry") - F.col("first"))
    return _joined(held, offset, group, ["offset"]).select(*rows.columns, (F.col("_at") + F.col("offset") + 1).cast("int").alias(name))


def running_before(rows: DataFrame, value: Column, group: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """`rows` with the sum of `value` over the rows before each one in its group, in column `name`."""
    held = ranged(rows.withColumn("_value", value), group, order)
    parts = held.groupBy(*group, "_part").agg(F.sum("_value").alias("n"))
    inside = F.sum("_value").over(W.partitionBy("_part", *group).orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    out = _joined(held.withColumn("_inside", F.coalesce(inside, F.lit(0))), _carried(parts, group, F.col("n")), group, ["carry"])
    return out.select(*rows.columns, (F.col("carry") + F.col("_inside")).alias(name))
