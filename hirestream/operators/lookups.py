"""Joins of listings with reference tables and caches.

Company attributes are looked up once per distinct company; caches are reduced
to one row per key first, so no join can multiply listings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirestream import config as C
from hirestream.functions.keys import computed, first_by_key, last_by_key
from hirestream.functions.text import (
    content_key,
    metro_area,
    norm_company,
    norm_key,
    occupation_code,
    truthy,
)
from hirestream.functions.urls import hostname, is_url
from hirestream.operators.filters import ttl_valid


# --- rank --------------------------------------------------------------------


def company_rank(
    companies: DataFrame,
    ranking: list[tuple[int, str]] = C.RANKING,
    suffixes: list[str] | None = None,
) -> DataFrame:
    """Add ``company_rank``: the first ranking entry equal to, inside or around the name.

    ``ranking`` is a short configuration list in order; it becomes a chain of
    literal comparisons evaluated on distinct companies; the entries are
    normalised by the same expression, which the optimiser folds.
    """
    norm, found = F.col("__norm"), F
    for rank, name in ranking:
        entry = norm_company(F.lit(name), suffixes)
        found = found.when(F.contains(norm, entry) | F.contains(entry, norm), rank)
    return (
        computed(companies, {"__norm": norm_company(F.col("company"), suffixes)})
        .withColumn("company_rank", found.cast("int") if ranking else F.lit(None).cast("int"))
        .drop("__norm")
    )


def rank_lookup(df: DataFrame, ranking: list[tuple[int, str]] = C.RANKING) -> DataFrame:
    """Add ``rank``: the matched firm's own rank, else the rank of the company name."""
    ranks = company_rank(df.select("company").distinct(), ranking)
    out = df.join(ranks, "company", "left")
    own = F.col("firm_rank") if "firm_rank" in df.columns else F.lit(None).cast("int")
    return out.withColumn("rank", F.coalesce(own, "company_rank")).drop("company_rank")


# --- salary ------------------------------------------------------------------


def wage_table(spark) -> DataFrame:
    """The default wages as rows; the national figure has an empty metro."""
    rows = [
        (soc, "" if metro == "National" else metro, float(lo), float(hi))
        for soc, (_, by_metro) in C.WAGES.items() for metro, (lo, hi) in by_metro.items()
    ]
    schema = T.StructType(
        [T.StructField("soc", T.StringType()), T.StructField("metro", T.StringType()),
         T.StructField("p25", T.DoubleType()), T.StructField("p75", T.DoubleType())]
    )
    return spark.createDataFrame(rows, schema)


def missing_amount(c: Column) -> Column:
    """NULL and zero both count as not given."""
    return F.coalesce(c, F.lit(0)) == 0


def salary_estimate(df: DataFrame, wages: DataFrame | None = None) -> DataFrame:
    """Fill in estimated salaries; needs ``role_category``.

    When either bound is missing both are replaced by the 25th and 75th
    percentile of the occupation, in the metro if it is known, else nationally.
    """
    wages = wage_table(df.sparkSession) if wages is None else wages
    need = missing_amount(F.col("salary_min")) | missing_amount(F.col("salary_max"))
    lowered = df.withColumns({"__t": F.lower("title"), "__l": F.lower(F.coalesce("location", F.lit("")))})
    coded = lowered.withColumns(
        {
            "soc": occupation_code("__t", "role_category"),
            "metro": metro_area("__l"),
            "__need": need,
        }
    )
    local = wages.where("metro <> ''").select(
        "soc", "metro", F.col("p25").alias("__lo"), F.col("p75").alias("__hi")
    )
    national = wages.where("metro = ''").select(
        "soc", F.col("p25").alias("__nlo"), F.col("p75").alias("__nhi")
    )
    out = coded.join(local, ["soc", "metro"], "left").join(national, "soc", "left")
    known = F.col("__nlo").isNotNull()
    lo, hi = F.coalesce("__lo", "__nlo"), F.coalesce("__hi", "__nhi")
    replace = F.col("__need") & known
    base = F.col("salary_is_predicted") if "salary_is_predicted" in df.columns else F.lit(False)
    return out.withColumns(
        {
            "salary_estimated": F.when(replace, True).otherwise(F.coalesce(base, F.lit(False))),
            "salary_min": F.when(replace, lo).otherwise(F.col("salary_min")),
            "salary_max": F.when(replace, hi).otherwise(F.col("salary_max")),
        }
    ).drop("__t", "__l", "__need", "__lo", "__hi", "__nlo", "__nhi")


# --- company attributes ------------------------------------------------------

ENRICHMENT_FIELDS = ["employee_count", "industry", "hq", "summary", "founded", "company_type"]


def enrichment_attributes(enrichment: DataFrame, run_ts: Column) -> DataFrame:
    """Valid cache entries, one per key, under the names used on listings."""
    valid = ttl_valid(
        last_by_key(enrichment, ["company_key"], "fetched_at"), "fetched_at", C.ENRICHMENT_TTL_DAYS, run_ts
    )
    return valid.select(
        "company_key",
        F.lit(True).alias("has_enrichment"),
        *[F.col(f).alias(f"enr_{f}") for f in ENRICHMENT_FIELDS],
    )


def company_enrich(df: DataFrame, enrichment: DataFrame, run_ts: Column) -> DataFrame:
    """Add cached company attributes (NULL when missing or out of date)."""
    companies = df.select("company").distinct().withColumn("company_key", norm_company(F.col("company")))
    attrs = companies.join(enrichment_attributes(enrichment, run_ts), "company_key", "left").drop("company_key")
    return df.join(attrs, "company", "left").withColumn(
        "has_enrichment", F.coalesce("has_enrichment", F.lit(False))
    )


def enrichment_worklist(df: DataFrame, enrichment: DataFrame, run_ts: Column) -> DataFrame:
    """Companies to look up: distinct keys without a valid entry, with their first name."""
    keyed = df.select("ord", "company").withColumn("company_key", norm_company(F.col("company")))
    firsts = first_by_key(keyed, ["company_key"], "ord")
    valid = enrichment_attributes(enrichment, run_ts).select("company_key")
    return firsts.join(valid, "company_key", "left_anti").select("company_key", "company")


# --- published table ---------------------------------------------------------


def mark_existing(df: DataFrame, published: DataFrame) -> DataFrame:
    """Add ``already_published``: the exact source URL is in the published table."""
    urls = (
        published.where("source_url <> ''")
        .select("source_url")
        .distinct()
        .withColumn("already_published", F.lit(True))
    )
    return df.join(urls, "source_url", "left").withColumn(
        "already_published", F.coalesce("already_published", F.lit(False))
    )


# --- generated text ----------------------------------------------------------


def cache_hit_split(
    df: DataFrame, role_cache: DataFrame, company_cache: DataFrame, run_ts: Column
) -> DataFrame:
    """Reusable text per row and how many texts would have to be generated.

    A row's texts are filled only when both are cached: without a text service
    nothing partial is published.
    """
    roles = last_by_key(
        role_cache.where("role_summary <> ''"), ["content_key"], "role_summary"
    ).select("content_key", F.col("role_summary").alias("__role"))
    companies = ttl_valid(
        last_by_key(company_cache, ["company_key"], "generated_at"),
        "generated_at", C.DESCRIPTION_TTL_DAYS, run_ts,
    ).select("company_key", F.col("description").alias("__company"))
    keyed = df.withColumns(
        {
            "content_key": content_key(F.col("company"), F.col("title"), F.col("description")),
            "company_key": norm_key(F.col("company")),
        }
    )
    out = keyed.join(roles, "content_key", "left").join(companies, "company_key", "left")
    role_hit, company_hit = F.col("__role").isNotNull(), F.col("__company").isNotNull()
    both = role_hit & company_hit
    hits = role_hit.cast("int") + company_hit.cast("int")
    return out.withColumns(
        {
            "role_hit": role_hit,
            "company_hit": company_hit,
            "calls_needed": 2 - hits,
            "calls_skipped": hits,
            "role_summary": F.when(both, F.col("__role")).otherwise(""),
            "company_description": F.when(both, F.col("__company")).otherwise(""),
        }
    ).drop("__role", "__company")


def _known(firm: str, cached: str) -> Column:
    return F.coalesce(firm, cached, F.lit(""))


def generation_worklist(df: DataFrame) -> DataFrame:
    """Texts to generate with their inputs: one task per role key and per company key.

    Needs the columns of ``text_gate`` and ``cache_hit_split`` plus firm and
    cached company attributes.
    """
    todo = df.where(F.col("text_gate") == "generate")
    common = {
        "firm_type_text": _known("firm_type", "enr_industry"),
        "specializations": F.coalesce(F.array_join("firm_specializations", ", "), F.lit("")),
        "size_text": _known("firm_size", "enr_employee_count"),
        "hq_text": _known("firm_hq", "enr_hq"),
        "founded": F.coalesce("enr_founded", F.lit("")),
        "summary": F.coalesce("enr_summary", F.lit("")),
    }
    columns = ["ord", "company", "rank", *common]
    base = todo.withColumns(common)
    none = F.lit(None).cast("string")
    roles = first_by_key(
        base.where(~F.col("role_hit")).select(
            F.lit("role").alias("task"), F.col("content_key").alias("task_key"), *columns,
            "title", "location", F.substring("description", 1, 2000).alias("description"),
        ),
        ["task_key"], "ord",
    )
    companies = first_by_key(
        base.where(~F.col("company_hit")).select(
            F.lit("company").alias("task"), F.col("company_key").alias("task_key"), *columns,
            none.alias("title"), none.alias("location"), none.alias("description"),
        ),
        ["task_key"], "ord",
    )
    return roles.unionByName(companies)


# --- boards ------------------------------------------------------------------


def board_seed_join(firm_csv: DataFrame, board_cache: DataFrame, run_ts: Column) -> DataFrame:
    """Seed boards: first list row per firm key with a valid cached board."""
    firms = first_by_key(
        firm_csv.where("name <> ''").select("ord", "name").withColumn("firm_key", norm_key(F.col("name"))),
        ["firm_key"], "ord",
    )
    boards = ttl_valid(
        board_cache.where(F.col("provider").isin("greenhouse", "lever")),
        "detected_at", C.BOARD_TTL_DAYS, run_ts,
    ).select("firm_key", "provider", "board_token")
    return firms.join(boards, "firm_key").select(
        "ord", F.col("name").alias("company_name"), "firm_key", "provider", "board_token"
    )


def slug_candidates(name: Column, website: Column) -> Column:
    """Up to three distinct board names to try: joined, hyphenated, web domain."""
    from hirestream.functions.text import _suffix_pattern

    bare = F.regexp_replace(F.lower(name), _suffix_pattern(C.SUFFIXES_FIRM), "")
    bare = F.regexp_replace(bare, "[^a-z0-9 ]", "")
    joined = F.replace(bare, F.lit(" "), F.lit(""))
    hyphen = F.regexp_replace(F.regexp_replace(bare, "[ -]+", "-"), r"^-|-\z", "")
    site = F.coalesce(website, F.lit(""))
    url = F.when(site.startswith("http"), site).otherwise(F.concat(F.lit("https://"), site))
    domain = F.regexp_replace(hostname(url), r"^www\.", "")
    # fixed values: endings of a web domain
    domain = F.regexp_replace(domain, r"\.(?:com|org|net|io|co|us|ca|uk).*\z", "")
    domain = F.regexp_replace(domain, "[^a-z0-9]", "")
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.nullif(joined, F.lit("")),
                F.nullif(hyphen, F.lit("")),
                F.when(truthy(site) & is_url(url) & (F.length(domain) > 2), domain),
            )
        )
    )


def probe_worklist(
    firm_csv: DataFrame,
    board_cache: DataFrame,
    run_ts: Column,
    limit: int | None = None,
    force: bool = False,
) -> DataFrame:
    """Board names to probe for firms without a valid cache entry, in list order.

    A repeated firm counts once: probing its first row makes the entry valid.
    """
    firms = firm_csv.where("name <> ''").withColumn("firm_key", norm_key(F.col("name")))
    todo = firms
    if not force:
        valid = ttl_valid(board_cache, "detected_at", C.BOARD_TTL_DAYS, run_ts).select("firm_key")
        todo = first_by_key(firms, ["firm_key"], "ord").join(valid, "firm_key", "left_anti")
    if limit:
        todo = todo.orderBy("ord").limit(limit)
    return todo.select(
        "ord", "name", "firm_key",
        F.posexplode(slug_candidates(F.col("name"), F.col("website"))).alias("slug_ord", "slug"),
    )


def resolve_boards(candidates: DataFrame, known_boards: DataFrame) -> DataFrame:
    """First candidate with a board, greenhouse before lever, else provider ``none``."""
    known = known_boards.where(F.col("provider").isin("greenhouse", "lever")).distinct()
    rank = F.when(F.col("provider") == "greenhouse", 0).otherwise(1)
    hit = candidates.join(known.withColumnRenamed("board_token", "slug"), "slug", "left")
    best = F.min(
        F.when(
            F.col("provider").isNotNull(),
            F.struct(rank.alias("r"), "slug_ord", "provider", "slug"),
        )
    )
    return (
        hit.groupBy("firm_key")
        .agg(best.alias("best"))
        .select(
            "firm_key",
            F.coalesce("best.provider", F.lit("none")).alias("provider"),
            F.coalesce("best.slug", F.lit("")).alias("board_token"),
        )
    )


