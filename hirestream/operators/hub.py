"""Queries of the listing pages over the published table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream import config as C


def hub_filter(
    items: DataFrame,
    state: str | None = None,
    role: str | None = None,
    level: str | None = None,
    remote_only: bool = False,
    text: str | None = None,
) -> DataFrame:
    """Equality filters plus a text search over title, company and location."""
    for column, value in (("job_state", state), ("role_category", role), ("experience_level", level)):
        if value:
            items = items.where(F.col(column) == value)
    if remote_only:
        items = items.where("is_remote")
    if text:
        fields = ("job_title", "company_name", "location")
        items = items.where(
            reduce(lambda a, b: a | b, [F.contains(F.lower(f), F.lit(text.lower())) for f in fields])
        )
    return items


def result_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("n"))


def category_page(items: DataFrame, column: str, value: str) -> DataFrame:
    """Items of a page fixed to one role, firm type or state."""
    if column not in ("role_category", "firm_type", "job_state"):
        raise ValueError(f"no pages by {column}")
    return items.where(F.col(column) == value)


def _order(by: str, tie: str) -> list[Column]:
    column = {"newest": "date_posted", "salary": "salary_max"}[by]
    return [F.desc_nulls_last(column), F.asc(tie)]


def hub_sort(items: DataFrame, by: str = "newest", tie: str = "ord") -> DataFrame:
    """Newest first, or highest salary first with missing salaries last."""
    return items.orderBy(*_order(by, tie))


def paged_list(items: DataFrame, offset: int, limit: int = 100, by: str = "newest", tie: str = "ord") -> DataFrame:
    return hub_sort(items, by, tie).offset(offset).limit(limit)


def related_listings(items: DataFrame, k: int = 4) -> DataFrame:
    """Up to ``k`` other items of the same role category per item, newest first.

    Every item of a category needs the same ``k + 1`` newest ones, minus itself.
    The rank limit is applied before the shuffle (window group limit), so only
    ``k + 1`` rows per category and input partition move.
    """
    newest = W.partitionBy("role_category").orderBy(F.desc_nulls_last("date_posted"), F.asc("ord"))
    best = (
        items.select("ord", "role_category", "date_posted")
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") <= k + 1)
        .select("role_category", F.col("ord").alias("related_ord"), F.col("rn").alias("rank"))
    )
    pairs = items.select("ord", "role_category").join(best, "role_category").where("ord <> related_ord")
    # an item among the newest skips itself, the others stop at k
    own = best.select(F.col("related_ord").alias("ord"), F.col("rank").alias("own_rank"))
    pairs = pairs.join(own, "ord", "left")
    position = F.col("rank") - F.when(F.col("own_rank") < F.col("rank"), 1).otherwise(0)
    return pairs.withColumn("position", position).where(F.col("position") <= k).select(
        "ord", "related_ord", "position"
    )


def facet_counts(items: DataFrame, columns: list[str], tools: str | None = "tools_mentioned") -> DataFrame:
    """Count per filter value in one scan; tools are split out of their list."""
    values = [F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns]
    facets = F.array(*values)
    if tools:
        names = F.filter(F.split(F.coalesce(tools, F.lit("")), ", "), lambda t: t != "")
        facets = F.concat(
            facets, F.transform(names, lambda t: F.struct(F.lit("tool").alias("facet"), t.alias("value")))
        )
    return (
        items.select(F.inline(facets))
        .where("value <> ''")
        .groupBy("facet", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def score_distribution(items: DataFrame, ceiling: int = C.TABLE_CEILING) -> DataFrame:
    """Items per ten score points, with the table size against its ceiling."""
    bands = items.groupBy((F.floor(F.col("quality_score") / 10) * 10).alias("score_band")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = items.agg(F.count(F.lit(1))).scalar()
    return bands.withColumn("total_items", total).withColumn(
        "ceiling_share", F.round(F.col("total_items") / ceiling, 4)
    )
