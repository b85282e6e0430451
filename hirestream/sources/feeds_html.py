"""Feed pages with HTML bodies to listings.

Board pages (paylocity, ultipro) embed a JSON value; detail pages (icims,
freshteam, jobvite) carry a JSON-LD posting or, failing that, meta tags.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.functions.text import (
    blank,
    decode_entities,
    employment_type,
    first_truthy,
    iso,
    page_text,
    parse_date,
    trim_ws,
    truthy,
)
from hirestream.functions.urls import origin, resolve
from hirestream.operators.dedup import keep_first
from hirestream.sources.feeds_json import _text, item_ord, join_truthy, listing
from hirestream.sources.pages import (
    embedded_json,
    meta_content,
    text_by_class,
    with_posting,
)


def _field(name: str) -> Column:
    return F.get_json_object("posting", f"$.{name}")


def address_text(place: str = "jobLocation") -> Column:
    """City and region, else country, of the first address."""
    def part(name: str) -> Column:
        single = F.get_json_object("posting", f"$.{place}.address.{name}")
        first = F.get_json_object("posting", f"$.{place}[0].address.{name}")
        return trim_ws(F.coalesce(first, single, F.lit("")))

    joined = join_truthy(part("addressLocality"), part("addressRegion"))
    return F.coalesce(F.nullif(joined, F.lit("")), part("addressCountry"))


def _detail_pages(
    source: str, pages: DataFrame, run_ts: Column, *, default_title: str | None, lenient_date: bool, blank_url: bool
) -> DataFrame:
    """Listings from detail pages.

    ``default_title`` stands in for a missing meta title if there is a meta
    description; ``lenient_date`` takes the run time for an unreadable date;
    ``blank_url`` also replaces an empty posting URL, not only a missing one.
    """
    pages = pages.withColumn("html", F.col("body"))
    rows = with_posting(pages)
    has = F.col("posting").isNotNull()
    rows = rows.withColumns(
        {
            "p_title": trim_ws(F.coalesce(_field("title"), F.lit(""))),
            "m_title": F.when(~has, meta_content(F.col("html"), "og:title")),
            "m_text": F.when(~has, meta_content(F.col("html"), "og:description")),
            "stamp": trim_ws(F.coalesce(_field("datePosted"), F.lit(""))),
        }
    )
    meta_title = F.nullif("m_title", F.lit(""))
    if default_title:
        meta_title = F.coalesce(meta_title, F.when(truthy(F.col("m_text")), default_title))
    rows = rows.withColumn("title", F.when(has, F.nullif("p_title", F.lit(""))).otherwise(meta_title))
    rows = rows.where("title is not null")
    posted = parse_date(F.col("stamp"))
    given_url = _field("url")
    if blank_url:
        given_url = F.nullif(trim_ws(given_url), F.lit(""))
    job = employment_type(_field("employmentType"))
    missing = F.lit(True) if lenient_date else F.col("stamp") == ""
    return listing(
        source, rows,
        ord=item_ord(source, F.col("ord"), F.lit(0)),
        title=F.col("title"),
        company=F.col("company"),
        location=F.when(has, address_text()).otherwise(""),
        description=F.when(has, page_text(decode_entities(F.coalesce(_field("description"), F.lit("")))))
        .otherwise(page_text(_text("m_text"))),
        source_url=F.when(has, F.coalesce(given_url, "url")).otherwise(F.col("url")),
        date_posted=F.when(has, iso(F.coalesce(posted, F.when(missing, run_ts)))).otherwise(iso(run_ts)),
        contract_type=F.when(has, job["contract_type"]),
        contract_time=F.when(has, job["contract_time"]),
        row_error=F.when(has & posted.isNull() & ~missing, "bad_date"),
    )


def icims(pages: DataFrame, run_ts: Column) -> DataFrame:
    return _detail_pages("icims", pages, run_ts, default_title="Job Opening", lenient_date=False, blank_url=True)


def freshteam(pages: DataFrame, run_ts: Column) -> DataFrame:
    return _detail_pages("freshteam", pages, run_ts, default_title=None, lenient_date=False, blank_url=False)


def jobvite(pages: DataFrame, run_ts: Column) -> DataFrame:
    return _detail_pages("jobvite", pages, run_ts, default_title=None, lenient_date=False, blank_url=False)


def paylocity(pages: DataFrame, run_ts: Column) -> DataFrame:
    """Jobs of the embedded page data; pages without jobs are read as detail pages."""
    schema = (
        "Jobs array<struct<JobId:bigint, JobTitle:string, LocationName:string, PublishedDate:string, "
        "HiringDepartment:string, JobLocation:struct<Name:string, City:string, State:string>>>, ModuleId string"
    )
    cut = embedded_json(pages.withColumn("html", F.col("body")), r"window\.pageData", "{", "block")
    cut = cut.withColumn("data", F.from_json("block", schema))
    jobs = cut.where(F.size(F.coalesce("data.Jobs", F.array().cast(cut.select("data.Jobs").schema[0].dataType))) > 0)
    rows = jobs.select(
        "company", "url", F.col("ord").alias("page_ord"), F.col("data.ModuleId").alias("module"),
        F.posexplode("data.Jobs").alias("pos", "j"),
    ).where(F.coalesce("j.JobId", F.lit(0)) != 0).where(~blank(F.col("j.JobTitle")))
    detail = F.concat(origin(F.col("url")), F.lit("/Recruiting/Jobs/Details/"), F.col("j.JobId").cast("string"))
    module = F.when(
        truthy(F.col("module")) & (F.col("module") != "0"), F.concat(F.lit("?moduleId="), F.url_encode("module"))
    )
    place = join_truthy(F.col("j.JobLocation.City"), F.col("j.JobLocation.State"))
    board = listing(
        "paylocity", rows,
        ord=item_ord("paylocity", F.col("page_ord"), F.col("pos")),
        title=trim_ws(F.col("j.JobTitle")),
        company=F.col("company"),
        location=F.coalesce(
            F.nullif(trim_ws(_text("j.LocationName")), F.lit("")), F.nullif(place, F.lit("")),
            "j.JobLocation.Name", F.lit(""),
        ),
        description=F.lit(""),
        source_url=F.concat(detail, F.coalesce(module, F.lit(""))),
        date_posted=iso(F.coalesce(parse_date(_text("j.PublishedDate")), run_ts)),
        category=F.col("j.HiringDepartment"),
    )
    others = cut.where(
        F.size(F.coalesce("data.Jobs", F.array().cast(cut.select("data.Jobs").schema[0].dataType))) == 0
    ).select(*pages.columns)
    return board.unionByName(
        _detail_pages("paylocity", others, run_ts, default_title=None, lenient_date=True, blank_url=True)
    )


_PLACE = (
    "struct<LocalizedDescription:string, LocalizedName:string, Address:struct<City:string, "
    "State:struct<Name:string>, Country:struct<Name:string>>>"
)
_OPPORTUNITY = (
    "struct<Id:string, Title:string, PostedDate:string, BriefDescription:string, FullTime:boolean, "
    f"JobCategoryName:string, Locations:array<{_PLACE}>>"
)
# fixed value: the id a link template carries in place of the opportunity id
ULTIPRO_EMPTY_ID = "00000000-0000-0000-0000-000000000000"


def ultipro(boards: DataFrame, results: DataFrame | None, run_ts: Column) -> DataFrame:
    """Opportunities of a board: its search results if there are any, else those in the page.

    ``boards`` are board pages, ``results`` the pages of their search endpoint,
    related by ``board_token``.
    """
    pages = boards.withColumn("html", F.col("body"))
    keep = ["board_token", "company", "url", "template", "page_ord"]
    base = pages.withColumns(
        {
            "template": F.regexp_extract("html", r'(?i)opportunityLinkUrl:\s*"([^"]+)"', 1),
            "page_ord": F.col("ord"),
        }
    )
    exploded = []
    if results is not None:
        parsed = results.select(
            "board_token", F.col("ord").alias("result_ord"),
            F.posexplode(F.from_json("body", f"opportunities array<{_OPPORTUNITY}>")["opportunities"]).alias("pos", "j"),
        )
        parsed = parsed.withColumn("item", item_ord("ultipro", F.col("result_ord"), F.col("pos")))
        key = F.coalesce("j.Id", F.concat_ws("|", _text("j.Title"), _text("j.PostedDate")))
        parsed = keep_first(parsed, [F.col("board_token"), key], "item")
        exploded.append(base.select(*keep).join(parsed.select("board_token", "item", "j"), "board_token"))
        base = base.join(parsed.select("board_token").distinct(), "board_token", "left_anti")
    for name in ("featuredOpportunities", "initialFeaturedOpportunities"):
        base = embedded_json(base, rf"(?i){name}\s*:", "[", f"in_{name}").withColumn(
            f"in_{name}", F.from_json(f"in_{name}", f"array<{_OPPORTUNITY}>")
        )
    filled = [F.when(F.size(f"in_{n}") > 0, F.col(f"in_{n}")) for n in ("featuredOpportunities", "initialFeaturedOpportunities")]
    inside = base.select(*keep, F.posexplode(F.coalesce(*filled)).alias("pos", "j"))
    exploded.append(inside.select(*keep, item_ord("ultipro", F.col("page_ord"), F.col("pos")).alias("item"), "j"))
    rows = reduce(lambda a, b: a.unionByName(b), exploded)
    rows = rows.where(truthy(F.col("j.Id")) & ~blank(F.col("j.Title")))
    first = F.get("j.Locations", F.lit(0))
    place = join_truthy(first["Address"]["City"], first["Address"]["State"]["Name"])
    link = F.when(
        truthy(F.col("template")),
        resolve(F.replace(F.col("template"), F.lit(ULTIPRO_EMPTY_ID), F.col("j.Id")), F.col("url")),
    )
    plain = F.concat(origin(F.col("url")), F.lit("/OpportunityDetail?opportunityId="), F.url_encode("j.Id"))
    stamp = F.nullif("j.PostedDate", F.lit(""))
    posted = parse_date(stamp)
    full = F.col("j.FullTime")
    return listing(
        "ultipro", rows,
        ord=F.col("item"),
        title=trim_ws(F.col("j.Title")),
        company=F.col("company"),
        location=F.coalesce(
            first_truthy(first["LocalizedDescription"], first["LocalizedName"], place),
            first["Address"]["Country"]["Name"], F.lit(""),
        ),
        description=page_text(_text("j.BriefDescription")),
        source_url=F.coalesce(link, plain),
        date_posted=iso(F.coalesce(posted, F.when(stamp.isNull(), run_ts))),
        contract_type=F.when(~F.coalesce(full == F.lit(False), F.lit(False)), "permanent"),
        contract_time=F.when(full, "full_time"),
        category=F.col("j.JobCategoryName"),
        row_error=F.when(stamp.isNotNull() & posted.isNull(), "bad_date"),
    )


def trinethire(pages: DataFrame, run_ts: Column) -> DataFrame:
    """Detail pages read by CSS class, with meta tags as fallback."""
    html = F.col("body")
    items = F.transform(
        F.regexp_extract_all(
            F.regexp_extract(html, r"""(?is)<ul[^>]*class=["'][^"']*job-meta[^"']*["'][^>]*>(.*?)</ul>""", 1),
            F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1),
        ),
        page_text,
    )
    # fixed values: list items that are not the location
    other = lambda t: F.lower(t).startswith("type:") | F.lower(t).startswith("min. experience:")
    place = F.get(F.filter(items, lambda t: (t != "") & ~other(t)), F.lit(0))
    kind = F.regexp_extract(html, r"(?i)<li>\s*<strong>\s*Type:\s*</strong>\s*([^<]+)</li>", 1)
    job = employment_type(trim_ws(decode_entities(kind)))
    rows = pages.withColumn("title", first_truthy(text_by_class(html, "job-name"), meta_content(html, "og:title")))
    rows = rows.where("title is not null")
    text = first_truthy(text_by_class(html, "job-descr"), page_text(meta_content(html, "og:description")))
    return listing(
        "trinethire", rows,
        ord=item_ord("trinethire", F.col("ord"), F.lit(0)),
        title=F.col("title"),
        company=F.col("company"),
        location=F.coalesce(place, F.lit("")),
        description=F.coalesce(text, F.lit("")),
        source_url=F.col("url"),
        date_posted=iso(run_ts),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
    )
