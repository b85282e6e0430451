"""Firm master data: build from a list, merge a list into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import first_by_key
from hirestream.functions.text import (
    firm_type,
    headquarters,
    norm_company,
    norm_firm,
    with_industry,
)
from hirestream.operators.lookups import company_rank


def firm_dedup(firm_csv: DataFrame, key: Column) -> DataFrame:
    """First list row per key; ``key`` is an expression on the list columns."""
    return first_by_key(firm_csv.withColumn("__key", key), ["__key"], "ord").drop("__key")


def build_firms(firm_csv: DataFrame, ranking: list[tuple[int, str]] = C.RANKING) -> DataFrame:
    """A firm table from a firm list: de-duplicated, with inferred type, rank and headquarters."""
    rows = firm_dedup(firm_csv, norm_company(F.col("name"), C.SUFFIXES_BUILD))
    rows = with_industry(rows, "industry", "__industry").withColumn("__n", F.lower("name"))
    ranks = company_rank(rows.select(F.col("name").alias("company")).distinct(), ranking, C.SUFFIXES_BUILD)
    rows = rows.join(ranks.withColumnRenamed("company", "name"), "name", "left")
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("ord").alias("firm_ord"),
        "name",
        none.alias("aliases"),
        firm_type("__n").alias("firm_type"),
        F.coalesce(F.nullif("__industry", F.lit("")), F.lit(C.DEFAULT_INDUSTRY)).alias("industry"),
        F.col("company_rank").alias("firm_rank"),
        none.alias("specializations"),
        headquarters(F.col("city"), F.col("state"), F.col("country")).alias("hq"),
        F.coalesce("state", F.lit("")).alias("hq_state"),
        F.coalesce("city", F.lit("")).alias("hq_city"),
        F.lit("").alias("size"),
        "website",
        "linkedin",
    )


# firm column <- list column
_FILLS = {
    "website": "website", "linkedin": "linkedin", "hq": "__hq", "hq_state": "state",
    "hq_city": "city", "industry": "industry",
}


def _list_groups(firm_csv: DataFrame) -> DataFrame:
    """Per firm key: row count, first row, and per field the first filled value and its row."""
    named = firm_csv.where("name <> ''").withColumn("key", norm_firm(F.col("name")))
    city, state = F.nullif("city", F.lit("")), F.nullif("state", F.lit(""))
    named = named.withColumn("__hq", F.concat_ws(", ", city, state))
    aggs = [F.count(F.lit(1)).alias("rows"), F.min("ord").alias("first_ord"),
            F.min_by("name", "ord").alias("first_name")]
    for field, col in _FILLS.items():
        filled = F.when(F.col(col) != "", F.col("ord"))
        aggs += [F.min_by(col, filled).alias(f"v_{field}"), F.min(filled).alias(f"o_{field}"),
                 F.min_by(F.coalesce(col, F.lit("")), "ord").alias(f"f_{field}")]
    return named.groupBy("key").agg(*aggs)


def _merge_rows(existing: DataFrame, firm_csv: DataFrame) -> DataFrame:
    """Existing firms and list groups side by side.

    Of existing firms with the same key only the last one receives values.
    """
    keyed = existing.withColumn("key", norm_firm(F.col("name")))
    target = keyed.groupBy("key").agg(F.max("firm_ord").alias("target_ord"))
    keyed = keyed.join(target, "key").withColumn(
        "join_key", F.when(F.col("firm_ord") == F.col("target_ord"), F.col("key"))
    ).drop("key", "target_ord")
    return keyed.join(_list_groups(firm_csv).withColumnRenamed("key", "list_key"),
                      F.col("join_key") == F.col("list_key"), "full")


def _is_new() -> Column:
    return F.col("firm_ord").isNull()


def _fill_ord(field: str) -> Column:
    """List row that fills ``field`` of an existing firm or, later on, of a new one."""
    base = F.when(_is_new(), F.col(f"f_{field}")).otherwise(F.coalesce(field, F.lit("")))
    if field == "industry":  # a new firm always starts with an industry
        base = F.when(_is_new(), F.lit("set")).otherwise(F.coalesce(field, F.lit("")))
    return F.when(base == "", F.col(f"o_{field}"))


def merge_firms(existing: DataFrame, firm_csv: DataFrame) -> DataFrame:
    """Existing firms with blanks filled from the list, then the list's new firms.

    Each field takes the first filled value in list order, for new firms too
    when the list repeats them.  ``is_new`` and ``merge_ord`` give the origin and
    the order: existing firms first, new ones by first appearance.
    """
    rows = _merge_rows(existing, firm_csv)
    filled = {
        f: F.when(F.coalesce(f, F.lit("")) == "", F.coalesce(f"v_{f}", F.coalesce(f, F.lit(""))))
        .otherwise(F.col(f))
        for f in _FILLS
    }
    # industry of the list is canonicalised when it is used
    rows = rows.withColumn("__raw", F.when(_is_new(), F.col("f_industry")).otherwise(F.col("v_industry")))
    rows = with_industry(rows, "__raw", "__canon")
    new_industry = F.coalesce(F.nullif("__canon", F.lit("")), F.lit(C.DEFAULT_INDUSTRY))
    filled["industry"] = (
        F.when(_is_new(), new_industry)
        .when(F.coalesce("industry", F.lit("")) == "", F.coalesce("__canon", F.lit("")))
        .otherwise(F.col("industry"))
    )
    none = F.array().cast("array<string>")
    return rows.select(
        _is_new().alias("is_new"),
        F.coalesce("firm_ord", "first_ord").alias("merge_ord"),
        F.coalesce("name", "first_name").alias("name"),
        F.coalesce("aliases", none).alias("aliases"),
        F.coalesce("firm_type", F.lit(C.FIRM_TYPE_DEFAULT)).alias("firm_type"),
        filled["industry"].alias("industry"),
        "firm_rank",
        F.coalesce("specializations", none).alias("specializations"),
        filled["hq"].alias("hq"),
        filled["hq_state"].alias("hq_state"),
        filled["hq_city"].alias("hq_city"),
        F.coalesce("size", F.lit("")).alias("size"),
        filled["website"].alias("website"),
        filled["linkedin"].alias("linkedin"),
    )


def merge_counters(existing: DataFrame, firm_csv: DataFrame) -> DataFrame:
    """How many list rows updated a firm, added one, or brought nothing new."""
    rows = _merge_rows(existing, firm_csv).where("list_key is not null")
    used = F.array_distinct(F.array_compact(F.array(*[_fill_ord(f) for f in _FILLS])))
    counted = rows.select(
        F.when(_is_new(), 1).otherwise(0).alias("added"),
        F.size(used).alias("updated"),
        (F.col("rows") - F.when(_is_new(), 1).otherwise(0) - F.size(used)).alias("skipped"),
    )
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns])
    return sums
