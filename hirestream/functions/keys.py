"""Grouping helpers that stay safe when one key holds most of the rows.

A window over a hot key puts the whole key into one task.  These helpers use
aggregates with map-side combine instead, and join back on the unique ``ord``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.session import stage


def computed(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    Filters on a plain derived column are pushed below it with the whole
    expression copied in, which repeats costly expressions and lets long chains of
    them grow without bound.  A generator of one row stops that.
    """
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*kept, F.inline(F.array(row)))


def first_by_key(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """The first row of every key group in ``order``; for narrow tables."""
    names = df.columns
    row = F.min_by(F.struct(*names), order).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]).agg(row).select("__row.*")


def last_by_key(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    row = F.max_by(F.struct(*df.columns), order).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]).agg(row).select("__row.*")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, counted: str | None = None) -> DataFrame:
    """Exact 1-based position of each row within its key group, without a task per key.

    Rows are range-partitioned by key and order, so a hot key spreads over many
    partitions.  A row's number is its position inside the partition plus the rows
    of the same key in earlier partitions.  The partition layout is staged: both
    halves of the sum must see the same one, also after an executor is lost.
    With ``counted``, a boolean column, only rows that have it add to the number.
    """
    laid = stage(df.repartitionByRange(*keys, *order).withColumn("__pid", F.spark_partition_id()), "numbered")
    from pyspark.sql import Window as W

    one = F.lit(1) if counted is None else F.when(F.col(counted), 1).otherwise(0)
    per = laid.groupBy(*keys, "__pid").agg(F.sum(one).alias("__n"))
    # at most one row per key and partition
    before = F.sum("__n").over(
        W.partitionBy(*keys).orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = per.select(*keys, "__pid", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = W.partitionBy(*keys, "__pid").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = laid.withColumn("__local", F.sum(one).over(inside))
    return (
        local.join(offsets, [*keys, "__pid"])
        .withColumn(out, F.col("__local") + F.col("__before"))
        .drop("__local", "__before", "__pid")
    )
