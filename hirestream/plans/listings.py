"""Compositions: raw listings to enriched listings to the next published table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import computed
from hirestream.functions.text import blank, norm_company
from hirestream.operators import enrichment as E
from hirestream.operators import history as H
from hirestream.operators import publish as P
from hirestream.operators.dedup import fingerprint_dedup, url_dedup
from hirestream.operators.filters import has_signals, publish_filter, role_filter, role_of, text_gate
from hirestream.operators.firm_match import apply_gate, company_firms, gate_of
from hirestream.operators.lookups import (
    cache_hit_split,
    company_rank,
    enrichment_attributes,
    mark_existing,
    salary_estimate,
)
from hirestream.operators.slugs import slug_uniquify, taken_slugs, with_slug_base
from hirestream.session import stage


@dataclass
class Dimensions:
    """Reference tables of a run.  ``ranking`` is a short list, the rest are tables."""

    firms: DataFrame
    enrichment: DataFrame
    published: DataFrame
    role_texts: DataFrame
    company_texts: DataFrame
    site_firms: DataFrame | None = None
    wages: DataFrame | None = None
    ranking: list[tuple[int, str]] = field(default_factory=lambda: C.RANKING)


def company_profile(companies: DataFrame, dims: Dimensions, run_ts: Column) -> DataFrame:
    """Everything known about a company, one row per distinct name.

    Firm match, allow list, rank and cached attributes are all functions of the
    name, so they are looked up here and reach the listings in a single join.
    """
    firms = company_firms(companies, dims.firms, dims.site_firms)
    ranked = company_rank(firms, dims.ranking).withColumn("company_key_long", norm_company(F.col("company")))
    attrs = enrichment_attributes(dims.enrichment, run_ts).withColumnRenamed("company_key", "company_key_long")
    return (
        ranked.join(attrs, "company_key_long", "left")
        .withColumns(
            {
                "has_enrichment": F.coalesce("has_enrichment", F.lit(False)),
                "rank": F.coalesce("firm_rank", "company_rank"),
            }
        )
        .drop("company_key_long", "company_rank")
    )


def enrich_listings(gated: DataFrame, dims: Dimensions, run_ts: Column) -> DataFrame:
    """Listings with role and company profile to fully enriched and scored listings."""
    out = salary_estimate(gated, dims.wages)
    out = E.pre_score(E.add_experience_level(E.add_tools(out)))
    out = text_gate(mark_existing(out, dims.published))
    out = cache_hit_split(out, dims.role_texts, dims.company_texts, run_ts)
    generate = F.col("text_gate") == "generate"
    out = out.withColumns(
        {c: F.when(generate, F.col(c)).otherwise("") for c in ("role_summary", "company_description")}
    )
    out = E.quality_score(out)
    out = E.hq_resolution(E.add_structured_location(out))
    return E.company_links(E.add_industry(out))


def filtered_listings(deduped: DataFrame, dims: Dimensions, run_ts: Column) -> DataFrame:
    """Role filter, then the firm gate; rows carry their company profile.

    The listings with a role are staged: the profile and the gate both read them.
    """
    roles = stage(role_filter(deduped), "roles")
    profile = company_profile(roles.select("company").distinct(), dims, run_ts)
    return apply_gate(roles.join(profile, "company", "left"))


def decision_columns(raw: DataFrame) -> DataFrame:
    """What duplicates, filters and slugs are decided on: one pass over the texts, none of them kept."""
    lowered = raw.withColumns({"__t": F.lower("title"), "__d": F.lower(F.coalesce("description", F.lit("")))})
    text = F.coalesce("description", F.lit(""))
    marked = computed(lowered, {"role_category": role_of("__t", "__d"), "text_length": F.length(text), "text_blank": blank(text)})
    marked = marked.withColumn("signals", F.when(F.col("role_category").isNotNull(), has_signals("__d")))
    return marked.select(
        "ord", "source", "company", "title", "location", "source_url", "salary_min", "salary_max", "contract_type",
        "contract_time", "text_length", "text_blank", "role_category", "signals",
    )


@dataclass
class RunResult:
    """Outputs of a run, all lazy; ``deduped`` has the narrow rows."""

    deduped: DataFrame
    enriched: DataFrame
    items: DataFrame
    actions: DataFrame
    next_snapshot: DataFrame
    changes: DataFrame
    funnel: DataFrame
    summary: DataFrame
    facts: DataFrame


def daily_run(
    raw: DataFrame, dims: Dimensions, run_ts: Column, duration_ms: Column | None = None
) -> RunResult:
    """A whole run: duplicates out, filter, enrich, slugs, publish decisions, statistics.

    ``dims.published`` is the full snapshot (``publish.ITEM_COLUMNS`` plus ``id``
    and ``item_ord``).  ``raw`` may carry ``row_error``: such rows are counted as
    errors and go no further.  Duplicates, filters and slugs are decided on narrow
    rows; the full rows are read again only to be enriched, those that are left.
    ``session.remove_stages`` deletes what a run has staged.
    """
    failed = raw.where("row_error is not null") if "row_error" in raw.columns else raw.where(F.lit(False))
    raw = raw.where("row_error is null").drop("row_error") if "row_error" in raw.columns else raw
    narrow = stage(decision_columns(raw), "decision-input")
    deduped = stage(url_dedup(stage(fingerprint_dedup(narrow), "distinct")), "deduped")
    roles = deduped.where("role_category is not null")
    profile = stage(company_profile(roles.select("company").distinct(), dims, run_ts), "profiles")
    known = profile.select("company", "firm_ord", "allow_listed")
    gated = roles.join(known, "company", "left").withColumn("gate", gate_of(F.col("signals"))).where("gate is not null")
    gated = stage(with_slug_base(gated).select("ord", "seq", "role_category", "gate", "slug_base"), "gated")
    slugged = slug_uniquify(gated, taken_slugs(dims.published))
    # the only pass over the full rows after the first one
    filtered = raw.join(slugged, "ord").join(profile.drop("allow_listed"), "company", "left")
    enriched = stage(enrich_listings(filtered, dims, run_ts), "enriched")
    publishable = publish_filter(enriched)
    items = P.map_published_item(publishable, run_ts)
    snapshot = dims.published.select(
        "id", "item_ord", "source_url", F.col("company_name").alias("company"), F.col("job_title").alias("title"),
        "location",
    )
    decided = P.match_published(
        items.select(
            "ord", "seq", "source_url", F.col("company_name").alias("company"),
            F.col("job_title").alias("title"), "location",
        ),
        snapshot,
    ).select("ord", "seq", "item_id", "action")
    decided = stage(decided, "decided")
    changes = items.join(decided.select("ord", "item_id"), "ord")
    before = dims.published.select("id", *P.ITEM_COLUMNS)
    after = P.apply_upserts(before, changes)
    actions = P.change_set(decided, after, run_ts)
    counts = actions.groupBy().agg(
        *[
            F.count(F.when(F.col("action") == a, 1)).alias(n)
            for a, n in (("create", "created"), ("update", "updated"), ("unpublish", "expired"), ("delete", "deleted"))
        ]
    )
    steps = H.funnel_counts(
        {
            "total_ingested": raw,
            "after_dedup": deduped,
            "after_filter": enriched,
            "after_quality_filter": publishable,
            "errors": failed,
        }
    ).drop("created", "updated", "expired", "deleted", "skipped")
    counts = counts.select(F.struct(*counts.columns)).scalar()
    funnel = steps.withColumn("counts", counts).select(
        "*", "counts.*", (F.col("after_filter") - F.col("after_quality_filter")).alias("skipped")
    )
    ms = F.lit(0).cast("bigint") if duration_ms is None else duration_ms
    return RunResult(
        deduped=deduped,
        enriched=enriched,
        items=items,
        actions=decided,
        next_snapshot=P.apply_change_set(before, changes, run_ts),
        changes=actions,
        funnel=funnel.select(*H.FUNNEL),
        summary=H.run_summary(funnel.select(*H.FUNNEL), enriched, run_ts, ms),
        facts=H.run_facts(enriched, run_ts),
    )
