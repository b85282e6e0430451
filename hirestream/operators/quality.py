"""Feed quality: how complete the listings of a board are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.functions.text import blank, trim_ws


def board_quality(boards: DataFrame, listings: DataFrame, keys: list[str]) -> DataFrame:
    """Coverage per board and a verdict.

    ``boards`` has the keys and ``fetch_ok``; boards without listings are kept.
    Ratios are rounded to two digits before they are judged.
    """
    def coverage(column: str) -> Column:
        return F.round(F.avg(F.when(blank(F.col(column)), 0.0).otherwise(1.0)), 2).alias(f"{column}_coverage")

    text = trim_ws(F.coalesce("description", F.lit("")))
    stats = listings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("listing_count"),
        coverage("title"), coverage("source_url"), coverage("date_posted"), coverage("location"),
        coverage("description"),
        F.coalesce(F.round(F.avg(F.when(text != "", F.length(text))), 2), F.lit(0.0)).alias("avg_description_length"),
    )
    measures = [c for c in stats.columns if c not in keys]
    out = boards.join(stats, keys, "left")
    # a failed fetch has no listings to judge
    out = out.withColumns(
        {m: F.when(F.col("fetch_ok"), F.coalesce(m, F.lit(0))).otherwise(F.lit(0)) for m in measures}
    )
    # fixed values: what counts as good
    good = (
        (F.col("title_coverage") >= 1) & (F.col("source_url_coverage") >= 1)
        & (F.col("date_posted_coverage") >= 1) & (F.col("location_coverage") >= 0.8)
        & (F.col("description_coverage") >= 0.8)
    )
    return out.withColumn(
        "quality_flag",
        F.when(~F.col("fetch_ok"), "fetch-error")
        .when(F.col("listing_count") == 0, "no-openings-or-invalid")
        .when(good, "good")
        .otherwise("mixed"),
    )


def provider_quality_summary(report: DataFrame) -> DataFrame:
    """Per provider and in total (provider NULL): boards, fetched, with listings, mixed or worse."""
    def share(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    ok, filled = F.col("fetch_ok"), F.col("listing_count") > 0
    return report.rollup("provider").agg(
        F.count(F.lit(1)).alias("total"),
        share(ok).alias("ok"),
        share(filled).alias("with_listings"),
        share(ok & ~filled).alias("zero_listings"),
        share(~ok).alias("fetch_errors"),
        F.round(F.avg("listing_count"), 2).alias("avg_listings"),
        share(F.col("quality_flag") != "good").alias("mixed_or_worse"),
    )
