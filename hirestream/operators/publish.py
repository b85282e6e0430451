"""The published table: mapping, change detection, expiry, next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import numbered
from hirestream.functions.text import fingerprint, parse_date
from hirestream.functions.urls import ensure_protocol
from hirestream.operators.dedup import with_seq
from hirestream.session import stage


def set_expiration(posted: Column, run_ts: Column) -> Column:
    """A week from the run or sixty days from posting, whichever is first.

    NULL when the posting date cannot be read.
    """
    refresh = run_ts + F.expr(f"interval {C.REFRESH_DAYS} days")
    oldest = posted + F.expr(f"interval {C.MAX_AGE_DAYS} days")
    return F.when(posted.isNotNull(), F.least(refresh, oldest))


def map_published_item(df: DataFrame, run_ts: Column) -> DataFrame:
    """Enriched listings to the columns of the published table (plus ``ord`` and ``seq``)."""
    text = lambda c: F.coalesce(c, F.lit(""))
    return with_seq(df).select(
        "ord",
        "seq",
        F.concat("title", F.lit(" at "), "company").alias("name"),
        "slug",
        F.col("title").alias("job_title"),
        F.col("company").alias("company_name"),
        "location",
        "description",
        "source_url",
        "date_posted",
        "salary_min",
        "salary_max",
        "salary_estimated",
        text("contract_type").alias("contract_type"),
        text("firm_type").alias("firm_type"),
        F.col("rank").alias("firm_rank"),
        F.coalesce("firm_size", "enr_employee_count", F.lit("")).alias("company_size"),
        F.coalesce("firm_hq", "enr_hq", F.lit("")).alias("company_hq"),
        ensure_protocol(F.col("company_website")).alias("company_website"),
        ensure_protocol(F.col("company_linkedin")).alias("company_linkedin"),
        "company_hq_state",
        "industry",
        "job_city",
        "job_state",
        "is_remote",
        "role_summary",
        "company_description",
        "tools_mentioned",
        "quality_score",
        "experience_level",
        "role_category",
        (F.col("quality_score") >= C.FEATURED_SCORE).alias("is_featured"),
        set_expiration(parse_date(F.col("date_posted")), run_ts).alias("expiration_date"),
        F.lit(True).alias("pipeline_managed"),
    )


ITEM_COLUMNS = [
    "name", "slug", "job_title", "company_name", "location", "description", "source_url", "date_posted",
    "salary_min", "salary_max", "salary_estimated", "contract_type", "firm_type", "firm_rank",
    "company_size", "company_hq", "company_website", "company_linkedin", "company_hq_state", "industry",
    "job_city", "job_state", "is_remote", "role_summary", "company_description", "tools_mentioned",
    "quality_score", "experience_level", "role_category", "is_featured", "expiration_date",
    "pipeline_managed",
]


def match_published(batch: DataFrame, published: DataFrame, merge_in_batch: bool = True) -> DataFrame:
    """Decide create or update for every batch row: adds ``action`` and ``item_id``.

    ``batch`` has ``ord``, ``source_url``, ``company``, ``title``, ``location``;
    ``published`` has ``id``, ``item_ord`` and the same four columns.  A row
    updates the item with its exact URL, else the only item with its fingerprint.
    Rows whose fingerprint is new create an item once; with ``merge_in_batch``
    later rows of the same fingerprint update it.  Rows without URL also follow
    the first created item without URL.  Other URLs must be unique in the batch.

    Every step is an aggregate or an equi-join on a staged narrow table; the item of a created row is
    ``new:<ord>`` of its creator.
    """
    keyed = with_seq(batch).withColumn("fp", fingerprint(F.col("company"), F.col("title"), F.col("location")))
    by_url = (
        published.where("source_url <> ''")
        .groupBy("source_url")
        .agg(F.max_by("id", "item_ord").alias("url_id"))
    )
    by_fp = (
        published.where("company <> '' and title <> ''")
        .groupBy(fingerprint(F.col("company"), F.col("title"), F.col("location")).alias("fp"))
        .agg(F.count(F.lit(1)).alias("n0"), F.max_by("id", "item_ord").alias("fp_id"))
    )
    place = F.struct(F.col("seq.a").alias("a"), F.col("seq.b").alias("b"), "ord")
    thin = keyed.select(
        "ord", place.alias("place"), "fp", F.coalesce("source_url", F.lit("")).alias("source_url")
    )
    # rows without URL match none; they stay where they are instead of meeting in one task
    blank = thin.where("source_url = ''").withColumn("url_id", F.lit(None).cast(by_url.schema["url_id"].dataType))
    thin = thin.where("source_url <> ''").join(by_url, "source_url", "left").unionByName(blank).join(by_fp, "fp", "left")
    # a few narrow columns that every step below reads
    thin = stage(thin.withColumn("n0", F.coalesce("n0", F.lit(0))), "match")
    open_rows = thin.where("url_id is null")
    if merge_in_batch:
        starts = open_rows.where("n0 = 0").groupBy("fp").agg(F.min("place").alias("fp_first"))
        # a single value: the first row without URL that creates an item
        owner = (
            open_rows.where("source_url = ''")
            .join(starts, "fp", "left")
            .where((F.col("n0") >= 2) | (F.col("place") == F.col("fp_first")))
            .agg(F.min("place").alias("owner"))
        )
        open_rows = open_rows.withColumn("owner", owner.scalar()).withColumn(
            "follows_owner", F.coalesce((F.col("source_url") == "") & (F.col("place") > F.col("owner")), F.lit(False))
        )
        creators = (
            open_rows.where("n0 = 0 and not follows_owner")
            .groupBy("fp")
            .agg(F.min("place").alias("creator"))
        )
        open_rows = open_rows.join(creators, "fp", "left")
    else:
        open_rows = open_rows.withColumns(
            {"owner": F.col("place"), "follows_owner": F.lit(False), "creator": F.col("place")}
        )
    new_id = lambda c: F.concat(F.lit("new:"), F.col(f"{c}.ord"))
    decided = open_rows.select(
        "ord",
        F.when(F.col("follows_owner"), new_id("owner"))
        .when(F.col("n0") == 1, F.col("fp_id"))
        .when(F.col("n0") >= 2, new_id("place"))
        .otherwise(new_id("creator"))
        .alias("item_id"),
        F.when(
            ~F.col("follows_owner")
            & ((F.col("n0") >= 2) | ((F.col("n0") == 0) & (F.col("place") == F.col("creator")))),
            "create",
        )
        .otherwise("update")
        .alias("action"),
    ).unionByName(
        thin.where("url_id is not null").select("ord", F.col("url_id").alias("item_id"), F.lit("update").alias("action"))
    )
    return with_seq(batch).join(decided, "ord")


def expire_items(items: DataFrame, run_ts: Column) -> DataFrame:
    """Managed items past their expiration: unpublish actions."""
    return items.where(F.col("pipeline_managed") & (F.col("expiration_date") < run_ts)).select(
        F.col("id").alias("item_id"), F.lit("unpublish").alias("action")
    )


def delete_items(items: DataFrame, run_ts: Column) -> DataFrame:
    """Managed items expired for thirty days: delete actions."""
    cutoff = run_ts - F.expr(f"interval {C.DELETE_AFTER_DAYS} days")
    return items.where(F.col("pipeline_managed") & (F.col("expiration_date") < cutoff)).select(
        F.col("id").alias("item_id"), F.lit("delete").alias("action")
    )


def apply_upserts(items: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot after creates and updates; the last change of an item wins.

    ``changes`` has ``item_id``, ``seq`` and the item columns of ``items``.
    """
    cols = [c for c in items.columns if c != "id"]
    # narrow aggregate for the winner, wide rows joined back by their unique ord
    last = changes.groupBy("item_id").agg(F.max_by("ord", "seq").alias("ord"))
    winners = changes.join(last.select("ord"), "ord", "left_semi")
    fresh = winners.select(F.col("item_id").alias("id"), *[c for c in cols if c in changes.columns])
    kept = items.join(fresh.select("id"), "id", "left_anti")
    carried = [c for c in cols if c not in changes.columns]
    if carried:
        fresh = fresh.join(items.select("id", *carried), "id", "left")
    return kept.unionByName(fresh)


def apply_change_set(items: DataFrame, changes: DataFrame, run_ts: Column) -> DataFrame:
    """Next snapshot: upserts first, then expiry marks and deletions on the result."""
    after = apply_upserts(items, changes)
    managed = F.coalesce("pipeline_managed", F.lit(False))
    expired = F.coalesce(managed & (F.col("expiration_date") < run_ts), F.lit(False))
    cutoff = run_ts - F.expr(f"interval {C.DELETE_AFTER_DAYS} days")
    deleted = F.coalesce(managed & (F.col("expiration_date") < cutoff), F.lit(False))
    return after.withColumn("live", ~expired).where(~deleted)


def change_set(batch_actions: DataFrame, items_after: DataFrame, run_ts: Column) -> DataFrame:
    """All actions of a run as one table: creates and updates, unpublishes, deletes."""
    pushes = batch_actions.select("item_id", "action", "seq")
    none = F.lit(None).cast("struct<a:bigint,b:bigint>").alias("seq")
    return (
        pushes.unionByName(expire_items(items_after, run_ts).withColumn("seq", none))
        .unionByName(delete_items(items_after, run_ts).withColumn("seq", none))
    )


def publish_batches(actions: DataFrame, size: int = C.PUBLISH_BATCH) -> DataFrame:
    """Number the pushed items, in order, into publish calls of at most ``size`` ids."""
    pushes = actions.where(F.col("action").isin("create", "update")).select(
        "item_id", "action", F.col("seq.a").alias("__a"), F.col("seq.b").alias("__b")
    )
    n = numbered(pushes, [], ["__a", "__b"], "position")
    return n.withColumn("batch_no", F.floor((F.col("position") - 1) / size)).drop("__a", "__b")


def _amount(c: str) -> Column:
    return F.when(F.col(c).isNull(), "?").otherwise(F.format_number(c, 0))


def dry_run_preview(df: DataFrame) -> DataFrame:
    """What would be published, as readable text columns."""
    return df.select(
        "ord",
        "quality_score",
        F.concat(
            "title", F.lit(" at "), "company", F.lit(" — "), "location",
            F.when(F.col("quality_score") >= C.FEATURED_SCORE, " ★ FEATURED").otherwise(""),
        ).alias("headline"),
        "slug",
        F.coalesce(F.nullif("tools_mentioned", F.lit("")), F.lit("none")).alias("tools"),
        F.concat(
            F.lit("$"), _amount("salary_min"), F.lit("-$"), _amount("salary_max"),
            F.when(F.col("salary_estimated"), " (est)").otherwise(""),
        ).alias("salary"),
        F.when(
            (F.col("company_website") != "") | (F.col("company_linkedin") != ""),
            F.concat(
                F.lit("Web: "), F.coalesce(F.nullif("company_website", F.lit("")), F.lit("—")),
                F.lit(" | LinkedIn: "), F.coalesce(F.nullif("company_linkedin", F.lit("")), F.lit("—")),
            ),
        ).alias("links"),
    )


def export_job_posting_jsonld(items: DataFrame, base_url: str = "https://jobs.example.com/jobs") -> DataFrame:
    """Structured-data documents per item: a job posting and its breadcrumb trail."""
    kind = lambda name: F.lit(name).alias("@type")
    address = F.struct(
        kind("PostalAddress"),
        F.col("job_city").alias("addressLocality"),
        F.col("job_state").alias("addressRegion"),
    )
    pay = F.struct(
        kind("QuantitativeValue"),
        F.col("salary_min").alias("minValue"),
        F.col("salary_max").alias("maxValue"),
        F.lit("YEAR").alias("unitText"),
    )
    posting = F.struct(
        F.lit("https://schema.org/").alias("@context"),
        kind("JobPosting"),
        F.col("job_title").alias("title"),
        "description",
        F.col("date_posted").alias("datePosted"),
        F.date_format("expiration_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("validThrough"),
        F.lit("FULL_TIME").alias("employmentType"),
        F.struct(
            kind("Organization"), F.col("company_name").alias("name"), F.col("company_website").alias("sameAs")
        ).alias("hiringOrganization"),
        F.struct(kind("Place"), address.alias("address")).alias("jobLocation"),
        F.struct(kind("MonetaryAmount"), F.lit("USD").alias("currency"), pay.alias("value")).alias("baseSalary"),
    )

    def crumb(position: int, name: Column, url: Column) -> Column:
        return F.struct(
            kind("ListItem"), F.lit(position).alias("position"), name.alias("name"), url.alias("item")
        )

    base = F.lit(base_url)
    trail = F.struct(
        F.lit("https://schema.org").alias("@context"),
        kind("BreadcrumbList"),
        F.array(
            crumb(1, F.lit("Jobs"), base),
            crumb(2, F.col("role_category"), F.concat(base, F.lit("/"), "role_category")),
            crumb(3, F.col("job_title"), F.lit(None).cast("string")),
        ).alias("itemListElement"),
    )
    return items.select(
        "id", F.to_json(posting).alias("posting_json"), F.to_json(trail).alias("breadcrumb_json")
    )
