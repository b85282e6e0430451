"""RSS and Atom feed pages to listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.functions.text import (
    ENTITIES_FEED,
    ENTITIES_PAGE,
    BLOCKS_FEED,
    BLOCKS_LISTS,
    _tidy,
    decode_entities,
    employment_type,
    first_truthy,
    iso,
    parse_date,
    strip_cdata,
    strip_tags,
    trim_ws,
    truthy,
)
from hirestream.functions.urls import drop_query
from hirestream.sources.feeds_json import item_ord, listing


def _entries(pages: DataFrame, tag: str) -> DataFrame:
    blocks = F.regexp_extract_all("body", F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return pages.select(
        "company", "board_token", F.col("ord").alias("page_ord"), F.posexplode(blocks).alias("pos", "x")
    )


def _tag(block: Column, tag: str) -> Column:
    return trim_ws(F.regexp_extract(block, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))


def _labelled(html: Column, label: str) -> Column:
    """Text after a label up to the next tag; NULL when the label is missing."""
    found = F.regexp_extract(html, rf"(?i){label}:\s*([^<]+)", 1)  # empty only where there is no match
    return F.when(found != "", trim_ws(decode_entities(found, ENTITIES_FEED)))


def zoho(pages: DataFrame, run_ts: Column) -> DataFrame:
    """RSS items; location and category are labelled lines of the description."""
    rows = _entries(pages, "item")
    x = F.col("x")
    rows = rows.withColumns(
        {
            "title": decode_entities(strip_cdata(_tag(x, "title")), ENTITIES_FEED),
            "link": decode_entities(_tag(x, "link"), ENTITIES_FEED),
            "html": decode_entities(strip_cdata(_tag(x, "description")), ENTITIES_FEED),
            "stamp": decode_entities(_tag(x, "pubDate"), ENTITIES_FEED),
        }
    )
    html, stamp = F.col("html"), F.col("stamp")
    posted = parse_date(stamp)
    return listing(
        "zoho", rows,
        ord=item_ord("zoho", F.col("page_ord"), F.col("pos")),
        title=F.col("title"),
        company=F.col("company"),
        location=F.coalesce(_labelled(html, "Location"), F.lit("")),
        description=_tidy(strip_tags(html, BLOCKS_FEED)),
        source_url=F.col("link"),
        date_posted=iso(F.coalesce(posted, F.when(stamp == "", run_ts))),
        category=_labelled(html, "Category"),
        row_error=F.when((stamp != "") & posted.isNull(), "bad_date"),
    )


def _link(block: Column, rel: str) -> Column:
    pattern = rf"""(?i)<link[^>]*rel=["']{rel}["'][^>]*href=["']([^"']+)["']"""
    return decode_entities(F.regexp_extract(block, pattern, 1), ENTITIES_PAGE)


def _term(block: Column, kind: str) -> Column:
    pattern = rf"""(?i)<category[^>]*scheme=["'][^"']*#{kind}["'][^>]*term=["']([^"']+)["']"""
    return decode_entities(F.regexp_extract(block, pattern, 1), ENTITIES_PAGE)


def jobscore(pages: DataFrame, run_ts: Column) -> DataFrame:
    """Atom entries; location, department and job type are category terms."""
    rows = _entries(pages, "entry")
    x = F.col("x")
    rows = rows.withColumns(
        {
            "html": decode_entities(strip_cdata(_tag(x, "content")), ENTITIES_PAGE),
            "link": first_truthy(_link(x, "alternate"), _link(x, "tag:jobscore.com/apply_url")),
            "updated": _tag(x, "updated"),
        }
    )
    job = employment_type(_term(x, "job_type"), internships=True)
    return listing(
        "jobscore", rows,
        ord=item_ord("jobscore", F.col("page_ord"), F.col("pos")),
        title=decode_entities(strip_cdata(_tag(x, "title")), ENTITIES_PAGE),
        company=F.col("company"),
        location=_term(x, "location"),
        description=_tidy(strip_tags(F.col("html"), BLOCKS_LISTS)),
        source_url=F.when(truthy(F.col("link")), drop_query(F.col("link"))).otherwise(""),
        date_posted=F.coalesce(F.nullif("updated", F.lit("")), iso(run_ts)),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=F.nullif(_term(x, "department"), F.lit("")),
    )


def feed_path(pages: DataFrame) -> DataFrame:
    """Add ``feed_path``: the RSS link of a careers page under its fixed prefix, or ``""``."""
    raw = decode_entities(
        F.regexp_extract("html", r"""(?i)(?:/recruit/)?downloadrssfeed\?[^"'\s<]+""", 0), ENTITIES_FEED
    )
    return pages.withColumn("__raw", raw).withColumn(
        "feed_path",
        F.when(F.col("__raw") == "", "")
        .when(F.col("__raw").startswith("/"), F.col("__raw"))
        .otherwise(F.concat(F.lit("/recruit/"), "__raw")),
    ).drop("__raw")
