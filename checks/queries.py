"""One query per operator, over the given tables or tables derived from them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import RUN_TS, with_views
from hirestream import config as C
from hirestream.functions import text as X
from hirestream.functions.urls import canonical_seed_url, ensure_protocol
from hirestream.operators import caches, dedup, enrichment, filters, firm_match, firms, history, hub, lookups, publish
from hirestream.operators import quality as quality_ops
from hirestream.operators import slugs
from hirestream.plans import landed
from hirestream.plans import listings as plan
from hirestream.session import scratch_path, stage
from hirestream.sources import config_files, discovery, feeds_html, feeds_json, feeds_xml, pages as page_ops, search_boards, snapshot, tables

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
LANDED: dict[tuple[str, str], DataFrame] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RANKING = [(1, "Acme Design"), (2, "Blue Harbor"), (3, "The Studio 1 Company, Inc."), (4, "Foods"), *C.RANKING]


def run_ts() -> Column:
    return F.to_timestamp(F.lit(RUN_TS))


def query(fn: Callable[["Ctx"], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(Ctx(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


class Ctx:
    """The given tables and the job-shaped tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def view(self, name: str) -> DataFrame:
        if name == "listings":
            return self.landed_listings()
        sql = with_views([name], f"select * from {name}", "string", given=("listings",))
        if "from listings" in sql:
            self.landed_listings().createOrReplaceTempView("listings")
        return self._sql(sql)

    def _sql(self, sql: str) -> DataFrame:
        for t in TABLES:
            if re.search(rf"(?:from|join) {t}\b", sql):
                self.table(t).createOrReplaceTempView(t)
        return self.spark.sql(sql)

    def landed_listings(self) -> DataFrame:
        """The listings as a table: derived and written once per session and input folder."""
        key = (self.spark.sparkContext.applicationId, self.dir)
        if key not in LANDED:
            made = self._sql(with_views(["listings"], "select * from listings", "string"))
            n = self.spark.sparkContext.defaultParallelism
            LANDED[key] = stage(made.repartition(n, "ord"), "listings")  # landed in several files
        return LANDED[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def firms(self) -> DataFrame:
        none = F.array().cast("array<string>")
        return self.view("firm").select(
            "*",
            F.when(F.col("alias") != "", F.array("alias")).otherwise(none).alias("aliases"),
            none.alias("specializations"),
        ).drop("alias")

    def firms_old(self) -> DataFrame:
        none = F.array().cast("array<string>")
        return self.view("firm_old").select("*", none.alias("aliases"), none.alias("specializations"))

    def published(self) -> DataFrame:
        return self.view("published")

    def snapshot(self) -> DataFrame:
        """The published table with all its columns."""
        p = self.published()
        known = {
            "name": F.concat("title", F.lit(" at "), "company"), "job_title": F.col("title"),
            "company_name": F.col("company"), "description": F.lit("old text"), "date_posted": F.lit("2023-12-01"),
            "salary_estimated": F.lit(False), "is_remote": F.lit(False), "is_featured": F.lit(False),
            "quality_score": F.lit(50), "firm_rank": F.lit(None).cast("int"),
            "salary_min": F.lit(None).cast("double"), "salary_max": F.lit(None).cast("double"),
        }
        kept = [c for c in publish.ITEM_COLUMNS if c in p.columns]
        rest = [c for c in publish.ITEM_COLUMNS if c not in p.columns]
        return p.select("id", "item_ord", *kept, *[known.get(c, F.lit("")).alias(c) for c in rest])

    def gated(self) -> DataFrame:
        """De-duplicated listings that passed both filters, with company profile."""
        d = dedup.url_dedup(stage(dedup.fingerprint_dedup(self.view("listings")), "distinct"))
        return plan.filtered_listings(d, self.dims(), run_ts())

    def dims(self) -> plan.Dimensions:
        return plan.Dimensions(
            firms=self.firms(), enrichment=self.view("enrichment"), published=self.snapshot(),
            role_texts=self.view("role_texts"), company_texts=self.view("company_texts"), ranking=RANKING,
        )

    def enriched(self, *wanted: str) -> DataFrame:
        """The enriched listings, written out; only the ``wanted`` columns where some are named."""
        return stage(plan.enrich_listings(self.gated(), self.dims(), run_ts()).select(*wanted or "*"), "enriched")

    def site_firms(self) -> DataFrame:
        """Allow list: the companies of every ninth listing."""
        return (
            self.view("listings").where("ord % 9 = 0").select(X.norm_key(F.col("company")).alias("firm_key"))
        )

    def payload(self, source: str, items: DataFrame, item: Column, wrap: Callable[[Column], Column], url: str = "") -> DataFrame:
        """Feed pages of up to ten items each, one board per page."""
        body = wrap(F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))), lambda x: x["item"]))
        grouped = items.groupBy(F.floor(F.col("ord") / 10).alias("page")).agg(body.alias("body"))
        return grouped.select(
            F.lit(source).alias("source"),
            F.concat(F.lit("b"), "page").alias("board_token"),
            F.concat(F.lit("Board "), "page").alias("company"),
            F.lit(1).alias("page_no"), run_ts().alias("fetched_at"),
            F.format_string(url or "https://example.com/%d", "page").alias("url"),
            "body", F.col("page").alias("ord"),
        )

    def page(self, source: str, items: DataFrame, html: Column) -> DataFrame:
        """Detail pages, one per listing."""
        return items.select(
            F.lit(source).alias("source"), F.lit("b").alias("board_token"), "company", F.lit(1).alias("page_no"),
            run_ts().alias("fetched_at"), F.concat(F.lit("https://example.com/j/"), "ord").alias("url"),
            html.alias("body"), "ord",
        )


def flat(df: DataFrame) -> DataFrame:
    """``seq`` as two plain columns."""
    return df.withColumns({"seq_a": F.col("seq.a"), "seq_b": F.col("seq.b")}).drop("seq")


LISTING = ["ord", "title", "company", "location", "source_url", "source"]

# --- duplicates ---------------------------------------------------------------


@query
def fingerprint_dedup(c: Ctx) -> DataFrame:
    return flat(dedup.fingerprint_dedup(c.view("listings"))).select(*LISTING, "description", "seq_a", "seq_b")


@query
def url_dedup(c: Ctx) -> DataFrame:
    return flat(dedup.url_dedup(c.view("listings"))).select(*LISTING, "description", "seq_a", "seq_b")


@query
def url_dedup_pages(c: Ctx) -> DataFrame:
    p = c.table("pages").select(
        F.col("page_id").alias("ord"), F.col("html").alias("description"), F.lit("").alias("location"),
        F.col("url").alias("source_url"), F.lit(None).cast("double").alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"), F.lit("").alias("contract_type"), F.lit("").alias("contract_time"),
    )
    return flat(dedup.url_dedup(p)).select("ord", "source_url", "seq_a", "seq_b")


@query
def dedup_both(c: Ctx) -> DataFrame:
    return flat(dedup.url_dedup(dedup.fingerprint_dedup(c.view("listings")))).select("ord", "seq_a", "seq_b")


@query
def seed_dedup(c: Ctx) -> DataFrame:
    return discovery.seed_dedup(c.view("source_seed")).select("ord", "company_name", "provider", "token")


@query
def canonical_seed(c: Ctx) -> DataFrame:
    return c.view("source_seed").select("ord", canonical_seed_url(F.col("source_url")).alias("seed"))


@query
def firm_dedup(c: Ctx) -> DataFrame:
    return firms.firm_dedup(c.view("firm_csv"), X.norm_company(F.col("name"), C.SUFFIXES_BUILD)).select("ord", "name")


@query
def posting_dedup(c: Ctx) -> DataFrame:
    rows = c.view("listings")
    return dedup.posting_dedup(rows, "company", F.concat_ws("|", "title", "location")).select(*LISTING)


# --- filters ------------------------------------------------------------------


@query
def role_filter(c: Ctx) -> DataFrame:
    return filters.role_filter(c.view("listings")).select("ord", "title", "role_category")


@query
def industry_signal_filter(c: Ctx) -> DataFrame:
    return filters.industry_signal_filter(c.view("listings")).select("ord", "company")


@query
def firm_gate(c: Ctx) -> DataFrame:
    out = firm_match.firm_gate(c.view("listings"), c.firms(), c.site_firms())
    return out.select("ord", "company", "gate", "firm_ord", "firm_name", "firm_industry", "firm_rank")


@query
def provider_subset(c: Ctx) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(p) for p in [*C.PROVIDERS, "other"]]), (F.col("ord") % 16 + 1).cast("int"))
    rows = c.view("listings").withColumn("source", names)
    return filters.provider_subset(rows, " Lever, icims ,nosuch,").select("ord", "source")


@query
def ttl_valid(c: Ctx) -> DataFrame:
    return filters.ttl_valid(c.view("board_cache"), "detected_at", C.BOARD_TTL_DAYS, run_ts())


@query
def drop_incomplete(c: Ctx) -> DataFrame:
    rows = c.view("listings").select(
        F.when(F.col("ord") % 7 != 0, F.col("ord")).alias("job_id"),
        F.when(F.col("ord") % 5 == 0, F.lit(" \t\n ")).otherwise(F.col("title")).alias("title"), "ord",
    )
    return filters.drop_incomplete(rows, "job_id").select("ord", "title")


@query
def log_filter_errors(c: Ctx) -> DataFrame:
    return filters.log_filter(c.view("log_lines"), "error")


@query
def log_filter_all(c: Ctx) -> DataFrame:
    return filters.log_filter(c.view("log_lines")).groupBy("line_class").agg(F.count(F.lit(1)).alias("n"))


@query
def row_error_isolation(c: Ctx) -> DataFrame:
    rows = c.view("listings").select("ord", "title", F.when(F.col("ord") % 6 == 0, "not a date").otherwise(F.col("date_posted")).alias("date_posted"))
    good, bad = filters.split_row_errors(
        rows,
        {"bad_date": X.parse_date(F.col("date_posted")).isNull(), "title": F.col("title").startswith("Data")},
    )
    marked = good.withColumn("row_error", F.lit("none")).unionByName(bad)
    return marked.groupBy("row_error").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


# --- firms and companies --------------------------------------------------------


@query
def firm_match_exact(c: Ctx) -> DataFrame:
    return firm_match.firm_match_exact(c.view("listings").select("company").distinct(), c.firms())


@query
def firm_match_fuzzy(c: Ctx) -> DataFrame:
    return firm_match.firm_match_fuzzy(c.view("listings").select("company").distinct(), c.firms())


@query
def firm_match_fuzzy_suppliers(c: Ctx) -> DataFrame:
    """Customer names against supplier names: long, alike and nowhere equal."""
    sup = c.table("supplier").select(
        F.col("s_suppkey").alias("firm_ord"), F.concat(F.lit("Merchant "), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit(" Trading Ltd")).alias("name"),
        F.array().cast("array<string>").alias("aliases"),
    )
    cust = c.table("customer").select(
        F.concat(F.lit("Mercant "), F.lpad((F.col("c_custkey") * 7).cast("string"), 9, "0"), F.lit(" Trading")).alias("company")
    )
    return firm_match.firm_match_fuzzy(cust, sup)


@query
def allow_list_semi(c: Ctx) -> DataFrame:
    return firm_match.allow_list_semi(c.view("listings"), c.site_firms()).select("ord", "company")


@query
def rank_lookup(c: Ctx) -> DataFrame:
    return lookups.rank_lookup(c.view("listings"), RANKING).select("ord", "company", "rank")


@query
def salary_estimate(c: Ctx) -> DataFrame:
    rows = filters.role_filter(c.view("listings"))
    return lookups.salary_estimate(rows).select("ord", "soc", "metro", "salary_min", "salary_max", "salary_estimated")


@query
def company_enrich(c: Ctx) -> DataFrame:
    out = lookups.company_enrich(c.view("listings"), c.view("enrichment"), run_ts())
    return out.select("ord", "company", "has_enrichment", "enr_employee_count", "enr_industry", "enr_hq")


@query
def enrichment_worklist(c: Ctx) -> DataFrame:
    return lookups.enrichment_worklist(c.view("listings"), c.view("enrichment"), run_ts())


@query
def mark_existing(c: Ctx) -> DataFrame:
    return lookups.mark_existing(c.view("listings"), c.published()).select("ord", "already_published")


@query
def cache_hit_split(c: Ctx) -> DataFrame:
    out = lookups.cache_hit_split(c.view("listings"), c.view("role_texts"), c.view("company_texts"), run_ts())
    return out.select("ord", "role_hit", "company_hit", "calls_needed", "calls_skipped", "role_summary", "company_description")


@query
def generation_worklist(c: Ctx) -> DataFrame:
    rows = lookups.cache_hit_split(c.view("listings"), c.view("role_texts"), c.view("company_texts"), run_ts())
    rows = lookups.company_enrich(rows, c.view("enrichment"), run_ts())
    rows = rows.withColumns(
        {
            "text_gate": F.when(F.col("ord") % 4 == 0, "low_quality").otherwise("generate"),
            "firm_type": F.lit(None).cast("string"), "firm_size": F.lit(None).cast("string"),
            "firm_hq": F.lit(None).cast("string"), "firm_specializations": F.lit(None).cast("array<string>"),
            "rank": F.lit(None).cast("int"),
        }
    )
    return lookups.generation_worklist(rows).select(
        "task", "task_key", "ord", "company", "title", "description", "firm_type_text", "size_text", "hq_text", "founded", "summary"
    )


@query
def board_seed_join(c: Ctx) -> DataFrame:
    return lookups.board_seed_join(c.view("firm_csv"), c.view("board_cache"), run_ts())


@query
def probe_worklist(c: Ctx) -> DataFrame:
    return lookups.probe_worklist(c.view("firm_csv"), c.view("board_cache"), run_ts()).select("ord", "firm_key", "slug_ord", "slug")


@query
def resolve_boards(c: Ctx) -> DataFrame:
    candidates = lookups.probe_worklist(c.view("firm_csv"), c.view("board_cache"), run_ts(), force=True)
    known = c.table("supplier").select(
        F.when(F.col("s_suppkey") % 2 == 0, "greenhouse").otherwise("lever").alias("provider"),
        F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("supplier"), "s_suppkey"))
        .when(F.col("s_suppkey") % 3 == 0, F.lower(F.replace("s_name", F.lit("#"), F.lit(""))))
        .otherwise("nosuch").alias("board_token"),
    )
    return lookups.resolve_boards(candidates, known)


# --- enrichment and scores --------------------------------------------------------


@query
def structured_location(c: Ctx) -> DataFrame:
    return enrichment.add_structured_location(c.view("listings")).select("ord", "location", "job_city", "job_state", "is_remote")


@query
def add_industry(c: Ctx) -> DataFrame:
    rows = c.firms().select("firm_ord", F.col("industry").alias("firm_industry")).withColumn("enr_industry", F.lit(None).cast("string"))
    rows = rows.withColumn("firm_industry", F.when(F.col("firm_ord") % 7 == 0, None).otherwise(F.col("firm_industry")))
    return enrichment.add_industry(rows).select("firm_ord", "industry", "matched_industry")


@query
def normalize_industry(c: Ctx) -> DataFrame:
    rows = c.view("firm_csv").select("ord", "industry").unionByName(
        c.view("enrichment").select(F.length("company_key").cast("bigint").alias("ord"), "industry")
    )
    return X.with_industry(rows, "industry", "canonical")


@query
def unmatched_industries(c: Ctx) -> DataFrame:
    rows = X.with_industry(c.view("enrichment"), "industry", "industry", matched="matched_industry")
    return history.unmatched_industries(rows)


@query
def experience_level(c: Ctx) -> DataFrame:
    titles = c.view("listings").select("ord", F.concat("title", F.when(F.col("ord") % 3 == 0, " / Sr. Associate, entry-level").otherwise("")).alias("title"))
    return enrichment.add_experience_level(titles)


@query
def extract_tools(c: Ctx) -> DataFrame:
    return enrichment.add_tools(c.view("listings")).select("ord", "tools_mentioned")


@query
def employee_band(c: Ctx) -> DataFrame:
    return c.table("part").select("p_partkey", X.employee_band((F.col("p_partkey") * 4).cast("int")).alias("band"))


@query
def slug_base(c: Ctx) -> DataFrame:
    return slugs.with_slug_base(c.view("listings")).select("ord", "slug_base")


@query
def html_text_variants(c: Ctx) -> DataFrame:
    p = c.table("pages")
    return p.select("page_id", *[X.html_text(F.col("html"), v).alias(f"text_{v.lower()}") for v in "ABCD"])


@query
def ensure_protocol_urls(c: Ctx) -> DataFrame:
    return c.view("firm_csv").select("ord", ensure_protocol(F.col("website")).alias("website"), ensure_protocol(F.col("linkedin")).alias("linkedin"))


SCORED = ["ord", "company", "role_category", "gate", "firm_ord", "rank", "salary_min", "salary_max", "salary_estimated",
          "tools_mentioned", "experience_level", "pre_score", "text_gate", "quality_score"]


@query
def enrich_listings(c: Ctx) -> DataFrame:
    return c.enriched(
        *SCORED, "job_city", "job_state", "is_remote", "company_hq_city", "company_hq_state", "industry",
        "company_website", "role_summary", "company_description",
    )


@query
def pre_score(c: Ctx) -> DataFrame:
    return c.enriched("ord", "pre_score")


@query
def quality_score(c: Ctx) -> DataFrame:
    return c.enriched("ord", "quality_score")


@query
def text_gate(c: Ctx) -> DataFrame:
    return c.enriched("text_gate").groupBy("text_gate").agg(F.count(F.lit(1)).alias("n"))


@query
def publish_filter(c: Ctx) -> DataFrame:
    return filters.publish_filter(c.enriched("ord", "quality_score")).select("ord", "is_featured", "publish_status")


@query
def hq_resolution(c: Ctx) -> DataFrame:
    rows = firm_match.firm_attributes(c.firms()).withColumn("enr_hq", F.lit(None).cast("string"))
    return enrichment.hq_resolution(rows).select("firm_ord", "company_hq_city", "company_hq_state")


# --- slugs, publishing -----------------------------------------------------------


@query
def slug_uniquify(c: Ctx) -> DataFrame:
    rows = slugs.with_slug_base(dedup.with_seq(c.view("listings")))
    return slugs.slug_uniquify(rows, slugs.taken_slugs(c.published())).select("ord", "slug_base", "slug")


@query
def slug_uniquify_contested(c: Ctx) -> DataFrame:
    """Slugs that themselves end in numbers other slugs run into."""
    n = F.when(F.col("ord") % 5 == 0, "2").when(F.col("ord") % 5 == 1, "3").otherwise("")
    rows = slugs.with_slug_base(dedup.with_seq(c.view("listings")).withColumn("location", n))
    return slugs.slug_uniquify(rows, slugs.taken_slugs(c.published())).select("ord", "slug_base", "slug")


@query
def match_published(c: Ctx) -> DataFrame:
    batch = stage(dedup.url_dedup(dedup.fingerprint_dedup(c.view("listings"))), "batch")
    return publish.match_published(batch, c.published()).select("ord", "action", "item_id")


@query
def match_published_no_merge(c: Ctx) -> DataFrame:
    batch = stage(dedup.url_dedup(dedup.fingerprint_dedup(c.view("listings"))), "batch")
    return publish.match_published(batch, c.published(), merge_in_batch=False).select("ord", "action", "item_id")


@query
def set_expiration(c: Ctx) -> DataFrame:
    posted = X.parse_date(F.col("date_posted")) - F.make_dt_interval(days=(F.col("ord") % 90).cast("int"))
    return c.view("listings").select("ord", publish.set_expiration(posted, run_ts()).alias("expiration_date"))


@query
def expire_items(c: Ctx) -> DataFrame:
    return publish.expire_items(c.published(), run_ts())


@query
def delete_items(c: Ctx) -> DataFrame:
    return publish.delete_items(c.published(), run_ts())


def _upserts(c: Ctx) -> DataFrame:
    """All listings as changes of the published items."""
    batch = dedup.with_seq(c.view("listings"))
    batch = batch.withColumns(
        {"slug": F.concat(F.lit("s"), "ord"), "pipeline_managed": F.lit(True),
         "expiration_date": publish.set_expiration(X.parse_date(F.col("date_posted")), run_ts())}
    )
    acts = publish.match_published(
        batch.withColumn("source_url", F.concat("source_url", F.lit("x"))), c.published()
    ).select("ord", "item_id")
    return batch.join(acts, "ord")


@query
def apply_change_set(c: Ctx) -> DataFrame:
    out = publish.apply_change_set(c.published().drop("item_ord"), _upserts(c), run_ts())
    return out.select("id", "source_url", "slug", "expiration_date", "live")


@query
def update_snapshot(c: Ctx) -> DataFrame:
    """The same change set on a snapshot in buckets, then a day later one without changes, for expiry alone."""
    root = scratch_path(c.spark, "buckets")
    snapshot.create_snapshot(c.published().drop("item_ord"), root)
    changes = stage(_upserts(c), "upserts")
    snapshot.update_snapshot(c.spark, root, changes, run_ts())
    snapshot.update_snapshot(c.spark, root, changes.limit(0), run_ts() + F.expr("interval 8 days"))
    return snapshot.read_snapshot(c.spark, root).select("id", "source_url", "slug", "expiration_date", "live")


@query
def publish_batches(c: Ctx) -> DataFrame:
    batch = dedup.with_seq(c.view("listings")).select(
        F.concat(F.lit("it"), "ord").alias("item_id"), F.when(F.col("ord") % 3 == 0, "create").otherwise("update").alias("action"), "seq"
    )
    return publish.publish_batches(batch)


@query
def dry_run_preview(c: Ctx) -> DataFrame:
    rows = c.view("listings").withColumns(
        {
            "quality_score": (F.col("ord") % 100).cast("int"), "slug": F.concat(F.lit("s-"), "ord"),
            "tools_mentioned": F.when(F.col("ord") % 2 == 0, "Revit").otherwise(""),
            "salary_estimated": F.col("ord") % 3 == 0,
            "company_website": F.when(F.col("ord") % 4 == 0, "https://w").otherwise(""),
            "company_linkedin": F.when(F.col("ord") % 6 == 0, "https://l").otherwise(""),
        }
    )
    return publish.dry_run_preview(rows)


@query
def map_published_item(c: Ctx) -> DataFrame:
    rows = c.enriched().withColumn("slug", F.concat(F.lit("s-"), "ord"))
    return publish.map_published_item(rows, run_ts()).drop("seq", "description")


@query
def job_posting_jsonld(c: Ctx) -> DataFrame:
    rows = c.view("listings").select(
        F.concat(F.lit("it"), "ord").alias("id"), F.col("title").alias("job_title"), F.col("company").alias("company_name"),
        "description", "date_posted", F.lit("Austin").alias("job_city"), F.lit("Texas").alias("job_state"),
        "salary_min", "salary_max", run_ts().alias("expiration_date"), F.lit("https://w").alias("company_website"),
        F.lit("operations").alias("role_category"), F.lit("s").alias("slug"),
    )
    docs = publish.export_job_posting_jsonld(rows)
    g = lambda p: F.get_json_object("posting_json", p)
    return docs.select(
        "id", g("$.title").alias("title"), g("$.description").alias("description"),
        g("$.hiringOrganization.name").alias("org"), g("$.jobLocation.address.addressRegion").alias("region"),
        g("$.baseSalary.value.minValue").try_cast("double").alias("pay_min"), g("$.validThrough").alias("valid_through"),
        F.get_json_object("breadcrumb_json", "$.itemListElement[1].name").alias("crumb"),
    )


# --- firm master data --------------------------------------------------------------


@query
def build_firms(c: Ctx) -> DataFrame:
    kinds = F.array(*[F.lit(x) for x in (" Architects", " Civil Engineering", " Foods", "")])
    rows = c.view("firm_csv").withColumn("name", F.concat("name", F.get(kinds, F.col("ord") % 4)))
    return firms.build_firms(rows, RANKING).drop("aliases", "specializations")


@query
def merge_firms(c: Ctx) -> DataFrame:
    return firms.merge_firms(c.firms_old(), c.view("firm_csv")).drop("aliases", "specializations")


@query
def merge_counters(c: Ctx) -> DataFrame:
    return firms.merge_counters(c.firms_old(), c.view("firm_csv"))


@query
def cache_upsert(c: Ctx) -> DataFrame:
    cache = c.view("board_cache")
    fresh = c.table("customer").select(
        F.concat(F.lit("supplier"), F.lpad((F.col("c_custkey") % 150).cast("string"), 9, "0")).alias("firm_key"),
        F.lit("lever").alias("provider"), F.concat(F.lit("new"), "c_custkey").alias("board_token"),
        (run_ts() + F.make_dt_interval(mins=F.col("c_custkey").cast("int"))).alias("detected_at"),
    )
    return caches.cache_upsert(cache, fresh, "firm_key", "detected_at")


@query
def cache_add_missing(c: Ctx) -> DataFrame:
    cache = c.view("role_texts")
    legacy = c.view("listings").select(
        F.md5(F.concat_ws("|", "company", "title", F.substring("description", 1, 500))).alias("content_key"),
        F.when(F.col("ord") % 4 == 0, "").otherwise("legacy").alias("role_summary"),
    ).distinct()
    return caches.cache_add_missing(cache, legacy, "content_key", "role_summary")


@query
def discover_sources(c: Ctx) -> DataFrame:
    return discovery.discover_sources(c.view("site_detection")).select("firm_ord", "firm_key", "company_name", "provider", "token", "source_url")


@query
def detection_dedup_prune(c: Ctx) -> DataFrame:
    """Seeds per firm and provider after duplicates and single postings are gone."""
    found = discovery.discover_sources(c.view("site_detection"))
    return found.groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


@query
def paylocity_board_prune(c: Ctx) -> DataFrame:
    k = F.col("c_custkey")
    seeds = c.table("customer").select(
        k.alias("ord"), (k % 200).cast("string").alias("firm_key"), F.when(k % 7 == 0, "zoho").otherwise("paylocity").alias("provider"),
        F.when(k % 11 == 0, F.concat(F.lit("board:all:"), k)).otherwise(F.concat(F.lit("detail:"), k)).alias("token"),
    )
    return discovery.paylocity_board_prune(seeds)


@query
def allowed_firm_keys(c: Ctx) -> DataFrame:
    return discovery.allowed_firm_keys(c.view("site_detection"))


@query
def alias_folding(c: Ctx) -> DataFrame:
    return discovery.alias_folding(c.view("source_seed").where("provider = 'icims'"))


# --- statistics -----------------------------------------------------------------------


@query
def funnel_counts(c: Ctx) -> DataFrame:
    raw = c.view("listings")
    fp = dedup.fingerprint_dedup(raw)
    both = dedup.url_dedup(fp)
    return history.funnel_counts({"total_ingested": raw, "after_dedup": both, "after_filter": filters.role_filter(both)})


@query
def run_facts(c: Ctx) -> DataFrame:
    return history.run_facts(c.enriched(), run_ts())


@query
def run_summary(c: Ctx) -> DataFrame:
    e = c.enriched("company", "job_state", "text_gate", "calls_needed", "calls_skipped")
    f = history.funnel_counts({"total_ingested": c.view("listings"), "after_filter": e})
    return history.run_summary(f, e, run_ts(), F.lit(5000).cast("bigint"))


@query
def match_counters(c: Ctx) -> DataFrame:
    return history.match_counters(c.enriched("text_gate", "calls_needed", "calls_skipped"))


@query
def top_companies(c: Ctx) -> DataFrame:
    return history.top_companies(c.view("listings")).select("company", "n")


@query
def rolling_created(c: Ctx) -> DataFrame:
    return history.rolling_created(c.view("history"), F.to_timestamp(F.lit("2024-02-10")))


@query
def weekly_created(c: Ctx) -> DataFrame:
    return history.weekly_created(c.view("history"))


@query
def weekly_created_recent(c: Ctx) -> DataFrame:
    return history.weekly_created(c.view("history"), F.to_timestamp(F.lit("2024-04-05")), 90)


@query
def states_covered(c: Ctx) -> DataFrame:
    return history.states_covered(c.view("history_facts"))


@query
def top_companies_over_runs(c: Ctx) -> DataFrame:
    return history.top_companies_over_runs(c.view("history_facts"))


@query
def latest_runs(c: Ctx) -> DataFrame:
    return history.latest_runs(c.view("history"), 10).select("run_ts", "created", "errors")


@query
def dashboard_kpis(c: Ctx) -> DataFrame:
    return history.dashboard_kpis(c.view("history"), c.view("run_log"), F.to_timestamp(F.lit("2024-02-10")))


@query
def issues_report(c: Ctx) -> DataFrame:
    return history.issues_report(c.view("history"), c.view("history_facts"))


@query
def history_table(c: Ctx) -> DataFrame:
    return history.history_table(c.view("history"))


@query
def append_history(c: Ctx) -> DataFrame:
    h = c.view("history")
    old = h.withColumn("run_ts", F.col("run_ts") - F.make_interval(months=F.lit(18)))
    return history.append_history(old, h, F.to_timestamp(F.lit("2024-01-15"))).select("run_ts", "created")


def _boards(c: Ctx) -> DataFrame:
    return c.view("listings").select("company").distinct().select(
        "company", F.when(F.length("company") % 2 == 0, "ashby").otherwise("zoho").alias("provider"),
        (~F.col("company").endswith("8")).alias("fetch_ok"),
    ).unionByName(
        c.table("nation").select(F.col("n_name").alias("company"), F.lit("lever").alias("provider"), F.lit(True).alias("fetch_ok"))
    )


def _quality(c: Ctx) -> DataFrame:
    rows = c.view("listings").withColumn("description", F.when(F.col("ord") % 9 == 0, " \n").otherwise(F.col("description")))
    return quality_ops.board_quality(_boards(c), rows, ["company"])


@query
def board_quality(c: Ctx) -> DataFrame:
    return _quality(c)


@query
def provider_quality_summary(c: Ctx) -> DataFrame:
    return quality_ops.provider_quality_summary(_quality(c))


# --- listing pages ---------------------------------------------------------------------


def _items(c: Ctx) -> DataFrame:
    rows = enrichment.add_structured_location(enrichment.add_experience_level(filters.role_filter(c.view("listings"))))
    return rows.select(
        "ord", F.col("title").alias("job_title"), F.col("company").alias("company_name"), "location", "job_state", "is_remote",
        "role_category", "experience_level", "date_posted", "salary_max",
        F.when(F.col("ord") % 3 == 0, "Revit, Power BI").when(F.col("ord") % 3 == 1, "Revit").otherwise("").alias("tools_mentioned"),
        (F.col("ord") % 101).cast("int").alias("quality_score"), F.concat(F.lit("Type "), F.col("ord") % 3).alias("firm_type"),
    )


@query
def hub_filter(c: Ctx) -> DataFrame:
    return hub.hub_filter(_items(c), role="project-management", text="manager", remote_only=True).select("ord", "job_title", "company_name")


@query
def hub_filter_count(c: Ctx) -> DataFrame:
    return hub.result_count(hub.hub_filter(_items(c), state="Texas", level="Senior"))


@query
def category_page(c: Ctx) -> DataFrame:
    return hub.category_page(_items(c), "role_category", "operations").select("ord", "job_title")


@query
def hub_sort_page(c: Ctx) -> DataFrame:
    return hub.paged_list(_items(c), 10, 400, by="salary").select("ord", "salary_max")


@query
def paged_newest(c: Ctx) -> DataFrame:
    return hub.paged_list(_items(c), 0, 100).select("ord", "date_posted")


@query
def related_listings(c: Ctx) -> DataFrame:
    return hub.related_listings(_items(c))


@query
def facet_counts(c: Ctx) -> DataFrame:
    return hub.facet_counts(_items(c), ["job_state", "role_category", "experience_level", "is_remote"])


@query
def score_distribution(c: Ctx) -> DataFrame:
    return hub.score_distribution(_items(c))


# --- sources and sinks -------------------------------------------------------------------


@query
def scan_firm_csv(c: Ctx) -> DataFrame:
    """The firm list written as CSV, with line breaks and quotes in names, and read back."""
    path = scratch_path(c.spark, "firm-csv")
    names = ["name", "industry", "website", "linkedin", "country", "state", "city"]
    rows = c.view("firm_csv").withColumn("name", F.concat(F.lit('The "Best",\n'), "name"))
    header = ["Account Name", "Industry", "Website", "LinkedIn", "Country", "State", "City"]
    ordered = rows.repartitionByRange(3, "ord").sortWithinPartitions("ord")
    ordered.select(*[F.col(n).alias(h) for n, h in zip(names, header)]).write.csv(path, header=True, quote='"', escape='"')
    return tables.scan_firm_csv(c.spark, path)


@query
def scan_board_cache(c: Ctx) -> DataFrame:
    """One JSON object per file, keyed by firm, written and read back."""
    path = scratch_path(c.spark, "board-cache")
    entry = F.to_json(F.struct("provider", F.col("board_token").alias("boardToken"), X.iso(F.col("detected_at")).alias("detectedAt")))
    # one file per written row
    rows = c.view("board_cache").withColumn("part", F.substring("firm_key", -1, 1))
    doc = F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "firm_key", F.lit('": '), entry)), ",\n"), F.lit("}"))
    rows.groupBy("part").agg(doc.alias("value")).select("value", "part").write.partitionBy("part").text(path)
    return tables.scan_board_cache(c.spark, path)


@query
def scan_raw_payloads(c: Ctx) -> DataFrame:
    """Landed pages partitioned by feed; only the wanted feeds are read."""
    path = scratch_path(c.spark, "payloads")
    src = F.element_at(F.array(*[F.lit(p) for p in C.PROVIDERS]), (F.col("page_id") % 15 + 1).cast("int"))
    rows = c.table("pages").select(
        src.alias("source"), F.lit("b").alias("board_token"), F.lit("Co").alias("company"), F.lit(1).alias("page_no"),
        run_ts().alias("fetched_at"), "url", F.col("html").alias("body"), F.col("page_id").alias("ord"),
    )
    tables.sink_table(rows, path, ["source"])
    return tables.scan_raw_payloads(c.spark, path, "lever,zoho").select("source", "ord", "url", F.length("body").alias("n"))


@query
def snapshot_round_trip(c: Ctx) -> DataFrame:
    path = scratch_path(c.spark, "snapshot")
    tables.sink_table(c.published(), path)
    return tables.scan_published_snapshot(c.spark, path)


@query
def config_lists(c: Ctx) -> DataFrame:
    """How many listings carry each title keyword of a configuration file."""
    path = scratch_path(c.spark, "keywords")
    lists = {config_files.TITLE_LISTS[k]: ws for k, ws in C.ROLE_TITLE_KEYWORDS.items()}
    made = F.lit(json.dumps({"titleKeywords": lists, "descriptionKeywords": C.ROLE_DESCRIPTION_KEYWORDS}))
    c.spark.range(1).coalesce(1).select(made.alias("value")).write.text(path)
    titles, _ = config_files.role_keywords(c.spark, path)
    keywords = [F.struct(F.lit(k).alias("category"), F.lit(w).alias("keyword")) for k, ws in titles.items() for w in ws]
    found = F.filter(F.array(*keywords), lambda k: F.contains(F.lower("title"), k["keyword"]))
    return c.view("listings").select(F.inline(found)).groupBy("category", "keyword").agg(F.count(F.lit(1)).alias("n"))


# --- feeds -------------------------------------------------------------------------------


def _html(col: str = "description") -> Column:
    return F.concat(F.lit("<p>"), col, F.lit("</p><ul><li>A &amp;amp; B</li><LI>C<br />D</LI></ul>"))


def _jobs(field: str) -> Callable[[Column], Column]:
    return lambda items: F.to_json(F.struct(items.alias(field)))


def _null_if(cond: str, value: Column) -> Column:
    return F.when(~F.expr(cond), value)


@query
def feed_greenhouse(c: Ctx) -> DataFrame:
    return feeds_json.greenhouse(_greenhouse_pages(c))


@query
def ingest_available(c: Ctx) -> DataFrame:
    """The same pages landed in two parts and ingested after each."""
    from hirestream.streaming.incremental import ingest_available as ingest

    landing, listings, state = (scratch_path(c.spark, x) for x in ("landing", "ingested", "ingest-state"))
    pages = _greenhouse_pages(c)
    for part in (0, 1):
        pages.where(F.col("ord") % 2 == part).write.mode("append").partitionBy("source").parquet(landing)
        ingest(c.spark, landing, listings, state, {"greenhouse": feeds_json.greenhouse, "lever": lambda p: feeds_json.lever(p, run_ts())})
    return c.spark.read.parquet(listings).select(*feeds_json.greenhouse(pages).columns)


def _greenhouse_pages(c: Ctx) -> DataFrame:
    named = lambda v: F.struct(v.alias("name"))
    item = F.struct(
        "title", _html().alias("content"), F.col("date_posted").alias("updated_at"),
        F.when(F.col("ord") % 4 != 0, named(F.col("location"))).alias("location"),
        F.array(named(F.lit("Dept")), named(F.col("source"))).alias("departments"),
        F.array(named(F.lit("HQ")), named(F.col("location"))).alias("offices"),
        F.col("source_url").alias("absolute_url"),
    )
    return c.payload("greenhouse", c.view("listings"), item, _jobs("jobs"))


@query
def feed_lever(c: Ctx) -> DataFrame:
    m = lambda n, k, v: F.when(F.col("ord") % n == k, v)
    item = F.struct(
        F.col("title").alias("text"),
        _html().alias("description"), m(2, 0, F.col("description")).alias("descriptionPlain"),
        m(3, 0, F.lit("<b>More</b>")).alias("additional"), m(6, 0, F.lit("Plain more")).alias("additionalPlain"),
        F.struct(
            m(5, 0, F.lit("Team")).alias("team"), F.lit("Dept").alias("department"), "location",
            m(4, 1, F.lit("Full-time")).alias("commitment"),
        ).alias("categories"),
        F.array(F.struct(F.lit("Needs").alias("text"), F.lit("<li>x</li><li>y</li>").alias("content"))).alias("lists"),
        F.col("source_url").alias("hostedUrl"),
        m(7, 0, F.lit(1704067200000) + F.col("ord") * 1000).alias("createdAt"),
        F.struct(
            F.col("salary_min").alias("min"), F.col("salary_max").alias("max"),
            F.when(F.col("ord") % 10 == 0, "per-year-salary").otherwise("per-hour-wage").alias("interval"),
        ).alias("salaryRange"),
    )
    return feeds_json.lever(c.payload("lever", c.view("listings"), item, F.to_json), run_ts())


@query
def feed_ashby(c: Ctx) -> DataFrame:
    m = lambda n, k, v: F.when(F.col("ord") % n == k, v)
    comp = lambda kind, interval, lo, hi: F.struct(
        F.lit(kind).alias("compensationType"), F.lit(interval).alias("interval"),
        lo.cast("double").alias("minValue"), hi.cast("double").alias("maxValue"),
    )
    item = F.struct(
        F.col("ord").cast("string").alias("id"), "title", m(3, 0, F.lit("Dept")).alias("department"), F.lit("Team").alias("team"),
        F.when(F.col("ord") % 3 == 0, "PartTime").when(F.col("ord") % 3 == 1, "Contract").alias("employmentType"),
        "location", m(2, 0, F.col("date_posted")).alias("publishedAt"),
        m(4, 0, F.col("source_url")).alias("jobUrl"), m(4, 1, F.lit("https://apply")).alias("applyUrl"),
        _html().alias("descriptionHtml"), m(2, 1, F.col("description")).alias("descriptionPlain"),
        F.struct(
            F.array(
                comp("Equity", "1 YEAR", F.lit(1), F.lit(2)), comp("Salary", "1 HOUR", F.lit(3), F.lit(4)),
                comp("Salary", "1 YEAR", F.lit(0), F.lit(None)), comp("Base Salary", "1 YEAR", F.col("salary_min"), F.col("salary_max")),
            ).alias("summaryComponents")
        ).alias("compensation"),
    )
    return feeds_json.ashby(c.payload("ashby", c.view("listings"), item, _jobs("jobs")), run_ts())


@query
def feed_workable(c: Ctx) -> DataFrame:
    m = lambda n, k, v: F.when(F.col("ord") % n == k, v)
    item = F.struct(
        "title", F.concat(F.lit("SC"), "ord").alias("shortcode"), F.lit("Full-time").alias("employment_type"),
        m(3, 0, F.lit("")).alias("department"), m(3, 0, F.col("source_url")).alias("url"), m(3, 1, F.lit("https://short")).alias("shortlink"),
        m(4, 0, F.lit("2024-01-05")).alias("published_on"),
        F.when(F.col("ord") % 4 == 1, "2024-01-06T01:02:03Z").when(F.col("ord") % 4 == 2, "bad").alias("created_at"),
        F.lit("France").alias("country"), m(5, 0, F.lit("Paris")).alias("city"), m(2, 0, F.lit("IDF")).alias("state"),
        _html().alias("description"),
    )
    return feeds_json.workable(c.payload("workable", c.view("listings"), item, _jobs("jobs")), run_ts())


@query
def feed_smartrecruiters(c: Ctx) -> DataFrame:
    rows = c.view("listings")
    lists = c.payload("smartrecruiters", rows, F.struct(F.col("ord").cast("string").alias("id")), _jobs("content"))
    section = lambda t, x: F.struct(t.alias("title"), x.alias("text"))
    detail = F.to_json(
        F.struct(
            F.col("ord").cast("string").alias("id"), F.col("title").alias("name"),
            F.when(F.col("ord") % 2 == 0, F.col("date_posted")).alias("releasedDate"),
            F.struct(
                F.when(F.col("ord") % 3 == 0, F.col("location")).alias("fullLocation"), F.lit("Lyon").alias("city"),
                F.lit("").alias("region"), F.lit("fr").alias("country"),
            ).alias("location"),
            F.struct(F.lit("Permanent").alias("label")).alias("typeOfEmployment"),
            F.struct(F.lit("Dept").alias("label")).alias("department"),
            F.when(F.col("ord") % 4 == 0, F.col("source_url")).alias("applyUrl"),
            F.when(F.col("ord") % 4 == 1, F.concat(F.lit("/x/"), "ord")).alias("canonicalPath"),
            F.struct(
                F.create_map(
                    F.lit("a"), section(F.lit("About"), _html()), F.lit("b"), section(F.lit("Empty"), F.lit("<p></p>")),
                    F.lit("c"), section(F.lit(""), F.lit("<p>Plain</p>")),
                ).alias("sections")
            ).alias("jobAd"),
        )
    )
    details = rows.where("ord % 6 <> 5").select(
        F.lit("smartrecruiters").alias("source"), F.concat(F.lit("b"), F.floor(F.col("ord") / 10)).alias("board_token"),
        detail.alias("body"), "ord",
    )
    return feeds_json.smartrecruiters(lists, details, run_ts())


@query
def feed_breezy(c: Ctx) -> DataFrame:
    m = lambda n, k, v: F.when(F.col("ord") % n == k, v)
    loc = lambda name, primary: F.struct(name.alias("name"), primary.alias("primary"))
    item = F.struct(
        F.col("ord").cast("string").alias("id"), m(2, 0, F.concat(F.lit("f"), "ord")).alias("friendly_id"),
        F.col("title").alias("name"), m(3, 0, F.col("source_url")).alias("url"), m(2, 0, F.col("date_posted")).alias("published_date"),
        F.lit("Dept").alias("department"), F.struct(F.lit("Part-Time").alias("name")).alias("type"),
        F.struct(
            m(4, 0, F.col("location")).alias("name"), F.lit("Oslo").alias("city"), F.struct(F.lit("NO").alias("name")).alias("state")
        ).alias("location"),
        F.when(F.col("ord") % 4 == 1, F.array(loc(F.lit("First"), F.lit(False)), loc(F.lit("Main"), F.lit(True))))
        .when(F.col("ord") % 4 == 2, F.array(loc(F.lit(""), F.lit(True)), loc(F.lit("Second"), F.lit(False)))).alias("locations"),
    )
    return feeds_json.breezy(c.payload("breezy", c.view("listings"), item, F.to_json), run_ts())


@query
def feed_workday(c: Ctx) -> DataFrame:
    item = F.struct(
        F.when(F.col("ord") % 10 == 7, " ").otherwise(F.concat(F.lit(" "), "title", F.lit("\n"))).alias("title"),
        F.when(F.col("ord") % 10 < 4, F.concat(F.lit("/job/"), F.floor(F.col("ord") % 10 / 2))).alias("externalPath"),
        F.col("location").alias("locationsText"),
        F.concat(F.lit("Posted "), F.element_at(F.array(F.lit("Today"), F.lit("Yesterday"), F.lit("3 Days Ago"), F.lit("2 Weeks Ago"), F.lit("5 hours ago"), F.lit("long ago")), (F.col("ord") % 6 + 1).cast("int"))).alias("postedOn"),
    )
    pages = c.payload("workday", c.view("listings"), item, _jobs("jobPostings"), "https://t%d.wd5.MyWorkdayJobs.com/en-US/Careers/")
    return feeds_json.workday(pages, run_ts())


@query
def feed_zoho(c: Ctx) -> DataFrame:
    item = F.concat(
        F.lit("<item><title><![CDATA["), "title", F.lit(" &amp; more]]></title><link>"), "source_url",
        F.lit("</link><description><![CDATA[Location: "), F.coalesce(F.nullif("location", F.lit("")), F.lit("Earth")),
        F.lit("<br>Category: Ops &amp; PM<br><span>"), F.col("title"), F.lit(" &lt;b&gt;text&lt;/b&gt; "), F.col("description"),
        F.lit("</span>]]></description><pubDate>"),
        F.when(F.col("ord") % 5 == 0, "").when(F.col("ord") % 5 == 1, "soon")
        .otherwise(F.concat(F.lit("Tue, 0"), F.col("ord") % 9 + 1, F.lit(" Jan 2024 10:00:00 +0000"))),
        F.lit("</pubDate></item>"),
    )
    return feeds_xml.zoho(c.payload("zoho", c.view("listings"), item, lambda a: F.concat(F.lit("<rss>"), F.array_join(a, "\n"), F.lit("</rss>"))), run_ts())


@query
def feed_jobscore(c: Ctx) -> DataFrame:
    item = F.concat(
        F.lit("<entry><title>"), "title", F.lit("</title><updated>"), F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("date_posted")),
        F.lit("</updated><link rel='"), F.when(F.col("ord") % 2 == 0, "alternate").otherwise("tag:jobscore.com/apply_url"),
        F.lit("' href='"), F.replace("source_url", F.lit("#apply"), F.lit("?a=1")), F.lit("'/>"),
        F.lit("<category scheme=\"http://x/#location\" term=\""), F.lit("Rome &amp; Co"), F.lit("\"/><category scheme=\"http://x/#department\" term=\"D\"/>"),
        F.lit("<category scheme=\"http://x/#job_type\" term=\""), F.when(F.col("ord") % 2 == 0, "Internship").otherwise("Full Time"), F.lit("\"/>"),
        F.lit("<content type=\"html\"><![CDATA[<ul><li>"), "title", F.lit("</li></ul><span>s</span>"), F.col("description"), F.lit("]]></content></entry>"),
    )
    return feeds_xml.jobscore(c.payload("jobscore", c.view("listings"), item, lambda a: F.concat(F.lit("<feed>"), F.array_join(a, "\n"), F.lit("</feed>"))), run_ts())


@query
def feed_paylocity(c: Ctx) -> DataFrame:
    item = F.struct(
        F.when(F.col("ord") % 9 != 0, F.col("ord")).alias("JobId"), F.concat(F.lit(" "), "title").alias("JobTitle"),
        F.when(F.col("ord") % 2 == 0, F.col("location")).alias("LocationName"), F.col("date_posted").alias("PublishedDate"),
        F.lit("Dept } { \" x").alias("HiringDepartment"),
        F.struct(F.lit("Site").alias("Name"), F.when(F.col("ord") % 3 == 0, "Rome").alias("City"), F.lit("").alias("State")).alias("JobLocation"),
    )
    wrap = lambda a: F.concat(
        F.lit("<html><script>var a = {}; window.pageData = "), F.to_json(F.struct(a.alias("Jobs"), F.lit(7).alias("ModuleId"))), F.lit("; f({});</script></html>")
    )
    return feeds_html.paylocity(c.payload("paylocity", c.view("listings"), item, wrap), run_ts())


@query
def feed_ultipro(c: Ctx) -> DataFrame:
    opp = F.struct(
        F.col("ord").cast("string").alias("Id"), F.concat("title", F.lit(" ")).alias("Title"), F.col("date_posted").alias("PostedDate"),
        F.lit("<p>Brief</p>").alias("BriefDescription"),
        F.when(F.col("ord") % 3 == 0, True).when(F.col("ord") % 3 == 1, False).alias("FullTime"), F.lit("Cat").alias("JobCategoryName"),
        F.array(
            F.struct(
                F.when(F.col("ord") % 2 == 0, F.col("location")).alias("LocalizedDescription"), F.lit(None).cast("string").alias("LocalizedName"),
                F.struct(F.lit("Bern").alias("City"), F.struct(F.lit("BE").alias("Name")).alias("State"), F.struct(F.lit("CH").alias("Name")).alias("Country")).alias("Address"),
            )
        ).alias("Locations"),
    )
    wrap = lambda a: F.concat(
        F.lit('<script>opportunityLinkUrl: "/B/OpportunityDetail?opportunityId=00000000-0000-0000-0000-000000000000", featuredOpportunities: [], initialFeaturedOpportunities : '),
        F.to_json(a), F.lit("</script>"),
    )
    boards = c.payload("ultipro", c.view("listings"), opp, wrap, "https://recruiting.ultipro.com/C%d/")
    results = c.payload("ultipro", c.view("listings").where("ord % 20 < 10 and ord % 10 < 3"), opp, _jobs("opportunities"))
    return feeds_html.ultipro(boards, results, run_ts())


def _posting_html(case: int) -> Column:
    """Detail pages: plain, listed and nested postings, meta tags only, and nothing."""
    posting = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"), F.concat(F.lit(" "), "title").alias("title"), _html().alias("description"),
            F.when(F.col("ord") % 5 == 0, "").otherwise(F.col("date_posted")).alias("datePosted"),
            F.when(F.col("ord") % 3 == 0, F.col("source_url")).alias("url"), F.lit("FULL_TIME").alias("employmentType"),
            F.struct(F.struct(F.lit("Gent").alias("addressLocality"), F.when(F.col("ord") % 2 == 0, "OVL").alias("addressRegion"), F.lit("BE").alias("addressCountry")).alias("address")).alias("jobLocation"),
        )
    )
    script = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    meta = F.concat(
        F.lit('<meta property="og:title" content="'), F.when(F.col("ord") % 10 == 3, "").otherwise(F.col("title")), F.lit('">'),
        F.lit('<meta property="og:description" content="Some &lt;b&gt;text&lt;/b&gt;">'),
    )
    kind = F.col("ord") % 5
    return F.concat(
        F.lit("<html><head>"),
        F.when(kind == 0, script(posting))
        .when(kind == 1, F.concat(script(F.lit("{broken")), script(F.concat(F.lit('[{"@type":"Thing"},'), posting, F.lit("]")))))
        .when(kind == 2, script(F.concat(F.lit('{"@graph":[{"@type":"WebPage","x":{"y":1}},'), posting, F.lit("]}"))))
        .when(kind == 3, meta)
        .otherwise(""),
        F.lit("</head></html>"),
    )


@query
def feed_icims(c: Ctx) -> DataFrame:
    rows = c.view("listings")
    return feeds_html.icims(c.page("icims", rows, _posting_html(0)), run_ts())


@query
def feed_freshteam(c: Ctx) -> DataFrame:
    rows = c.view("listings")
    return feeds_html.freshteam(c.page("freshteam", rows, _posting_html(0)), run_ts())


@query
def feed_jobvite(c: Ctx) -> DataFrame:
    rows = c.view("listings")
    return feeds_html.jobvite(c.page("jobvite", rows, _posting_html(0)), run_ts())


@query
def feed_trinethire(c: Ctx) -> DataFrame:
    html = F.concat(
        F.lit("<h1 class='big job-name'>"), F.when(F.col("ord") % 4 != 0, F.col("title")).otherwise(""), F.lit("</h1>"),
        F.lit("<meta property='og:title' content='Meta title'><ul class=\"job-meta\"><li><strong>Type:</strong> Full-time</li><li> "), "location", F.lit(" </li></ul>"),
        F.lit("<li><strong>Type:</strong> Part-time contract</li><div class=\"job-descr\"><p>"), F.col("title"), F.lit("</p><p>b &amp; c</p></div>"),
    )
    return feeds_html.trinethire(c.page("trinethire", c.view("listings"), html), run_ts())


@query
def union_feeds(c: Ctx) -> DataFrame:
    def rows(source: str, k: int) -> DataFrame:
        r = c.view("listings").where(f"ord % 3 = {k}")
        return feeds_json.listing(source, r, **{x: F.col(x) for x in feeds_json.LISTING_COLUMNS if x not in ("ord", "source")}, ord=feeds_json.item_ord(source, F.col("ord"), F.lit(1)))

    both = feeds_json.union_feeds([rows("lever", 0), rows("greenhouse", 1), rows("jobvite", 2)])
    return feeds_json.usable(both).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


# --- pages -------------------------------------------------------------------------------


@query
def jsonld_postings(c: Ctx) -> DataFrame:
    pages = c.view("listings").select(F.col("ord").alias("page_id"), _posting_html(0).alias("html"))
    found = page_ops.extract_jsonld_postings(pages)
    return found.select("page_id", F.trim(F.get_json_object("posting", "$.title")).alias("title"), F.get_json_object("posting", "$.jobLocation.address.addressCountry").alias("country"))


@query
def extract_meta(c: Ctx) -> DataFrame:
    pages = c.table("pages").withColumn("html", F.concat(F.lit("<meta name='keywords' content=' a &amp; b '><META data-x='1' PROPERTY=\"og:title\" content=\"Page &#39;"), "page_id", F.lit("&#39;\">"), "html"))
    return page_ops.extract_meta(page_ops.extract_meta(pages, "og:title", "og"), "keywords", "keywords").select("page_id", "og", "keywords")


@query
def extract_text_by_class(c: Ctx) -> DataFrame:
    return page_ops.extract_text_by_class(c.table("pages"), "ad").select("page_id", "text")


@query
def extract_links(c: Ctx) -> DataFrame:
    return page_ops.extract_links(c.table("pages"), r"""(?i)href=["'](/[^"']+)["']""")


_BOARD_PAGES = 50


def _board_links(c: Ctx) -> DataFrame:
    """``(board, n, to)``: the pages as boards of fifty, linked as binary trees by number, with links back."""
    p = c.table("pages").select(F.floor(F.col("page_id") / _BOARD_PAGES).alias("board"), (F.col("page_id") % _BOARD_PAGES).alias("n"))
    to = F.explode_outer(F.filter(F.array(F.col("n") * 2, F.col("n") * 2 + 1, F.floor(F.col("n") / 3)), lambda x: (x > 0) & (x < _BOARD_PAGES)))
    return p.select("board", "n", to.alias("to"))


def _board_page(n: Column) -> Column:
    return F.concat(F.lit("https://b"), "board", F.lit(".icims.com/jobs/search?pr="), n, F.lit("&in_iframe=1"))


@query
def search_page_frontier(c: Ctx) -> DataFrame:
    """Search pages of one host, linked over the whole table as a binary tree by number, with links back; a seed a board."""
    p = c.table("pages")
    last = p.agg(F.max("page_id")).scalar()
    page = lambda n: F.concat(F.lit("https://b.icims.com/jobs/search?pr="), n)
    edges = p.select("page_id", F.explode(F.array(F.col("page_id") * 2, F.col("page_id") * 2 + 1, F.floor(F.col("page_id") / 3))).alias("to"))
    edges = edges.withColumn("last", last).where("to <= last and to > 0")
    links = edges.select(page(F.col("page_id")).alias("page"), page(F.col("to")).alias("link"))
    seeds = p.where("page_id between 1 and 9 or page_id % 100 = 7").select(F.col("page_id").alias("board"), page(F.col("page_id")).alias("page"))
    return page_ops.search_page_frontier(seeds, links).groupBy("board").agg(F.count(F.lit(1)).alias("pages"), F.max("level").alias("depth"))


@query
def crawl_search_boards(c: Ctx) -> DataFrame:
    """Landed search pages with links of both kinds; every tenth board is known by a detail page only."""
    links = _board_links(c).withColumn("lost", F.col("board") % 10 == 3)
    other = lambda n: F.concat(F.lit("/jobs/search?pr="), n, F.lit("&amp;x=1"))
    there = lambda n: F.concat(F.lit("https://B"), "board", F.lit(".icims.com/jobs/search?pr="), n, F.lit("&amp;in_iframe=1"))
    link = F.when(F.col("to") % 2 == 0, F.concat(F.lit("<a href='"), other(F.col("to")), F.lit("'>"))).otherwise(
        F.concat(F.lit('<a href="'), there(F.col("to")), F.lit('">')))
    job = F.concat(F.lit('<a href="/jobs/'), "n", F.lit('/some-title/job?from=list"> <a href="https://elsewhere.example.com/jobs/search?ss=1">'))
    pages = links.where("not lost").groupBy("board", "n").agg(F.array_join(F.collect_list(link), " ").alias("links"))
    pages = pages.select(_board_page(F.col("n")).alias("url"), F.concat("links", job).alias("html"))
    seed = F.when(F.col("lost"), F.concat(F.lit("https://b"), "board", F.lit(".icims.com/jobs/5/lead/job?x=1"))).otherwise(
        F.concat(F.lit("https://b"), "board", F.lit(".icims.com/jobs/search?pr=1&utm=2")))
    crawl = search_boards.crawl_search_boards(links.select("board", seed.alias("seed_url")).distinct(), pages)
    details = crawl.details.groupBy("board").agg(F.count(F.lit(1)).alias("details"), F.min("link").alias("first_detail"))
    return crawl.visited.groupBy("board").agg(F.count(F.lit(1)).alias("pages"), F.max("level").alias("depth")).join(details, "board", "left")


@query
def normalize_search_url(c: Ctx) -> DataFrame:
    from hirestream.functions.urls import with_search_url

    seeds = c.view("source_seed").where("provider = 'icims'").withColumn(
        "u", F.concat("source_url", F.when(F.col("ord") % 3 == 0, "&x=1&hashed=9").when(F.col("ord") % 3 == 1, "&in_iframe=2#f").otherwise(""))
    )
    return with_search_url(seeds, "u", "search", F.lit("c8.icims.com")).select("ord", "search")


@query
def feed_path(c: Ctx) -> DataFrame:
    pages = c.table("pages").withColumn(
        "html",
        F.concat("html", F.when(F.col("page_id") % 3 == 0, "<a href='/recruit/downloadrssfeed?digest=a&amp;b=1'>").when(F.col("page_id") % 3 == 1, "<a href='downloadrssfeed?x'>").otherwise("")),
    )
    return feeds_xml.feed_path(pages).select("page_id", "feed_path")


# --- whole runs ----------------------------------------------------------------------------


@query
def role_counts(c: Ctx) -> DataFrame:
    """Duplicates out, role and signal filter, tools; listings per role."""
    rows = dedup.url_dedup(dedup.fingerprint_dedup(c.view("listings")))
    rows = enrichment.add_tools(filters.industry_signal_filter(filters.role_filter(rows)))
    return rows.groupBy("role_category").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("company").alias("companies"),
        F.count(F.when(F.col("tools_mentioned") != "", 1)).alias("with_tools"),
    )


@query
def daily_run_funnel(c: Ctx) -> DataFrame:
    return plan.daily_run(c.view("listings"), c.dims(), run_ts()).funnel


@query
def daily_run_changes(c: Ctx) -> DataFrame:
    return plan.daily_run(c.view("listings"), c.dims(), run_ts()).changes.select("item_id", "action")


@query
def daily_run_items(c: Ctx) -> DataFrame:
    return plan.daily_run(c.view("listings"), c.dims(), run_ts()).items.select("ord", "slug", "quality_score", "is_featured", "expiration_date")


def _landed_pages(c: Ctx) -> DataFrame:
    """The listings as pages of three feeds, one company and up to a hundred items a page; some dates can't be read."""
    rows = c.view("listings")
    html = F.concat(F.lit("<p>"), "description", F.lit("</p>"))
    items = {
        "greenhouse": (rows.where("ord % 3 = 0"), _jobs("jobs"), F.struct(
            "title", html.alias("content"), F.col("date_posted").alias("updated_at"), F.struct(F.col("location").alias("name")).alias("location"),
            F.col("source_url").alias("absolute_url"))),
        "workable": (rows.where("ord % 3 = 1"), _jobs("jobs"), F.struct(
            "title", html.alias("description"), F.col("location").alias("city"), F.lit("France").alias("country"), F.col("source_url").alias("url"),
            F.when(F.col("ord") % 12 == 1, "soon").otherwise("2024-01-05").alias("published_on"))),
        "lever": (rows.where("ord % 3 = 2"), F.to_json, F.struct(
            F.col("title").alias("text"), F.col("description").alias("descriptionPlain"), F.struct("location").alias("categories"),
            F.col("source_url").alias("hostedUrl"), (F.lit(1704067200000) + F.col("ord") * 1000).alias("createdAt"),
            F.struct(F.col("salary_min").alias("min"), F.col("salary_max").alias("max"), F.lit("per-year").alias("interval")).alias("salaryRange"))),
    }
    found = []
    for source, (part, wrap, item) in items.items():
        body = wrap(F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))), lambda x: x["item"]))
        page = part.groupBy("company", F.floor(F.col("ord") / 100).alias("h")).agg(body.alias("body"), F.min("ord").alias("ord"))
        found.append(page.select(
            F.lit(source).alias("source"), F.concat(F.lit("b"), "h").alias("board_token"), "company", F.lit(1).alias("page_no"),
            run_ts().alias("fetched_at"), F.concat(F.lit("https://example.com/"), "h").alias("url"), "body", "ord"))
    path = scratch_path(c.spark, "landed-pages")
    tables.sink_table(found[0].unionByName(found[1]).unionByName(found[2]), path, ["source"])
    return tables.scan_raw_payloads(c.spark, path)


def _page_run(c: Ctx) -> landed.PageRun:
    return landed.daily_run_from_pages(_landed_pages(c), c.dims(), run_ts(), ["greenhouse", "lever", "workable"])


@query
def daily_run_from_pages(c: Ctx) -> DataFrame:
    """Landed pages to the funnel of the run, with errors."""
    return _page_run(c).run.funnel


@query
def daily_run_page_changes(c: Ctx) -> DataFrame:
    return _page_run(c).run.changes.select("item_id", "action")


@query
def daily_run_failed_rows(c: Ctx) -> DataFrame:
    return landed.failed_rows(landed.listings_from_pages(_landed_pages(c), run_ts(), ["greenhouse", "lever", "workable"]))


@query
def ingest_distinct(c: Ctx) -> DataFrame:
    """Pages landed in two parts, of which the second has those of the first again: a posting comes out once."""
    from hirestream.streaming.incremental import ingest_distinct as ingest

    landing, listings, keys, state = (scratch_path(c.spark, x) for x in ("landing", "distinct", "posting-keys", "ingest-state"))
    pages = _landed_pages(c)
    feeds = {"greenhouse": feeds_json.greenhouse, "workable": lambda p: feeds_json.workable(p, run_ts()), "lever": lambda p: feeds_json.lever(p, run_ts())}
    for part in (pages.where("ord % 2 = 0"), pages):
        part.write.mode("append").partitionBy("source").parquet(landing)
        ingest(c.spark, landing, listings, keys, state, feeds)
    return c.spark.read.parquet(listings).select("ord", "source", "source_url", "row_error", "batch_id")
