"""Derived listing columns: tools, level, location, headquarters, industry, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.location import with_location
from hirestream.functions.text import experience_level, tool_count, tools_array, truthy, with_industry
from hirestream.functions.urls import ensure_protocol
from hirestream.operators.lookups import missing_amount


def add_tools(df: DataFrame, tools: list[str] = C.TOOLS) -> DataFrame:
    """Add ``tools_mentioned``, comma-joined in list order."""
    lowered = df.withColumn("__d", F.lower(F.coalesce("description", F.lit(""))))
    found = F.array_join(tools_array("description", "__d", tools), ", ")
    return lowered.withColumn("tools_mentioned", found).drop("__d")


def add_experience_level(df: DataFrame) -> DataFrame:
    return df.withColumn("experience_level", experience_level(F.col("title")))


def add_structured_location(df: DataFrame) -> DataFrame:
    """Add ``job_city``, ``job_state`` and ``is_remote``."""
    return with_location(df, "location", "job_city", "job_state", "is_remote")


def add_industry(df: DataFrame, aliases: dict[str, list[str]] = C.INDUSTRY_ALIASES) -> DataFrame:
    """Add ``industry``: of the firm, else of the company cache, else the default."""
    raw = F.coalesce("firm_industry", "enr_industry", F.lit(C.DEFAULT_INDUSTRY))
    return with_industry(
        df.withColumn("__raw", raw), "__raw", "industry", aliases, matched="matched_industry"
    ).drop("__raw")


def hq_resolution(df: DataFrame) -> DataFrame:
    """Add headquarters city and state, parsed from free text only when no state is given."""
    text = F.when(
        F.coalesce("firm_hq_state", F.lit("")) == "", F.coalesce("firm_hq", "enr_hq", F.lit(""))
    )
    parsed = with_location(df.withColumn("__hq", text), "__hq", "__city", "__state", None)
    return parsed.withColumns(
        {
            "company_hq_city": F.coalesce(F.nullif("firm_hq_city", F.lit("")), "__city"),
            "company_hq_state": F.coalesce(F.nullif("firm_hq_state", F.lit("")), "__state"),
        }
    ).drop("__hq", "__city", "__state")


def company_links(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "company_website": ensure_protocol(F.col("firm_website")),
            "company_linkedin": ensure_protocol(F.col("firm_linkedin")),
        }
    )


# fixed values: points per piece of information
def pre_score_column() -> Column:
    def worth(cond: Column, points: int) -> Column:
        return F.when(cond, points).otherwise(0)

    paid = ~missing_amount(F.col("salary_min")) & ~missing_amount(F.col("salary_max"))
    length = F.length(F.coalesce("description", F.lit("")))
    tools = tool_count(F.col("tools_mentioned"))
    return F.least(
        worth(paid & ~F.col("salary_estimated"), 15)
        + worth(paid & F.col("salary_estimated"), 5)
        + worth(F.col("firm_ord").isNotNull(), 15)
        + worth(F.col("has_enrichment"), 10)
        + worth(~missing_amount(F.col("rank")), 10)
        + worth(length > 500, 10)
        + worth(length > 1500, 5)
        + worth(tools >= 1, 5)
        + worth(tools >= 3, 5)
        + worth(F.col("experience_level") != "", 5)
        + worth(F.col("location").contains(","), 5),
        F.lit(100),
    )


def pre_score(df: DataFrame) -> DataFrame:
    """Add ``pre_score``: completeness before any generated text."""
    return df.withColumn("pre_score", pre_score_column())


def quality_score(df: DataFrame) -> DataFrame:
    """Add ``quality_score``: ``pre_score`` plus points for the two texts."""
    texts = sum(
        F.when(truthy(F.col(c)), 5).otherwise(0) for c in ("role_summary", "company_description")
    )
    return df.withColumn("quality_score", F.least(F.col("pre_score") + texts, F.lit(100)))
