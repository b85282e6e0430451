"""Feed pages with JSON bodies to listings.

Every function takes the landed pages of one feed (``schemas.RAW_PAYLOAD``) and
returns rows of ``schemas.RAW_LISTING`` plus ``row_error``: NULL, or why the row
cannot be used.  Pages that are not JSON give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.text import (
    employment_type,
    first_truthy,
    html_text,
    iso,
    parse_date,
    relative_date,
    trim_ws,
    truthy,
)
from hirestream.functions.urls import host, hostname, path_parts
from hirestream.operators.dedup import keep_first
from hirestream.schemas import LISTING_COLUMNS

_ITEM_BITS, _RANK_SHIFT = 20, 58


def item_ord(source: str, payload_ord: Column, position: Column) -> Column:
    """Unique position: feed, page, item; up to 2**20 items per page and 2**38 pages.

    A position beyond that ends the job, as it would be taken for one of another
    page or feed.
    """
    rank = C.PROVIDERS.index(source)
    place = F.lit(rank << _RANK_SHIFT) + F.shiftleft(payload_ord, _ITEM_BITS) + position.cast("bigint")
    inside = position.between(0, (1 << _ITEM_BITS) - 1) & payload_ord.between(0, (1 << (_RANK_SHIFT - _ITEM_BITS)) - 1)
    return F.when(inside | position.isNull() | payload_ord.isNull(), place).otherwise(
        F.raise_error(F.concat(F.lit("no place for item "), position, F.lit(" of page "), payload_ord)).cast("bigint"))


def listing(source: str, rows: DataFrame, **cols: Column) -> DataFrame:
    """Complete listing rows; columns not given are NULL (no salary, not predicted)."""
    null = F.lit(None)
    defaults = {
        "salary_min": null, "salary_max": null, "salary_is_predicted": F.lit(False), "contract_type": null,
        "contract_time": null, "category": null, "source": F.lit(source),
    }
    types = {"ord": "bigint", "salary_min": "double", "salary_max": "double", "salary_is_predicted": "boolean"}
    cols = {**defaults, **cols}
    error = cols.pop("row_error", null)
    return rows.select(
        *[cols[c].cast(types.get(c, "string")).alias(c) for c in LISTING_COLUMNS],
        error.cast("string").alias("row_error"),
    )


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def join_truthy(*cols: Column) -> Column:
    """Non-empty values joined with a comma."""
    return F.concat_ws(", ", *[F.nullif(c, F.lit("")) for c in cols])


def _items(pages: DataFrame, schema: str, field: str | None = None) -> DataFrame:
    body = F.from_json("body", schema)
    items = body[field] if field else body
    return pages.select("company", "board_token", "url", F.col("ord").alias("page_ord"), F.posexplode(items).alias("pos", "j"))


def _bad_date(text: Column, ts: Column) -> Column:
    return F.when(truthy(text) & ts.isNull(), "bad_date")


def greenhouse(pages: DataFrame) -> DataFrame:
    schema = (
        "jobs array<struct<title:string, content:string, updated_at:string, location:struct<name:string>, "
        "departments:array<struct<name:string>>, offices:array<struct<name:string>>, absolute_url:string>>"
    )
    rows = _items(pages, schema, "jobs")
    names = lambda a: F.array_join(F.transform(a, lambda x: F.coalesce(x["name"], F.lit(""))), ", ")
    return listing(
        "greenhouse", rows,
        ord=item_ord("greenhouse", F.col("page_ord"), F.col("pos")),
        title=F.col("j.title"),
        company=F.col("company"),
        location=F.coalesce("j.location.name", names(F.col("j.offices")), F.lit("")),
        description=html_text(_text("j.content"), "A"),
        source_url=F.col("j.absolute_url"),
        date_posted=F.col("j.updated_at"),
        category=names(F.col("j.departments")),
    )


def lever(pages: DataFrame, run_ts: Column) -> DataFrame:
    schema = (
        "array<struct<text:string, description:string, descriptionPlain:string, additional:string, "
        "additionalPlain:string, categories:struct<team:string, department:string, location:string, "
        "commitment:string>, lists:array<struct<text:string, content:string>>, hostedUrl:string, "
        "createdAt:bigint, salaryRange:struct<min:double, max:double, interval:string>>>"
    )
    rows = _items(pages, schema)
    intro = first_truthy(F.col("j.descriptionPlain"), html_text(_text("j.description"), "A"))
    sections = F.transform(
        F.coalesce("j.lists", F.array().cast("array<struct<text:string,content:string>>")),
        lambda s: F.concat(F.coalesce(s["text"], F.lit("")), F.lit(":\n"), html_text(F.coalesce(s["content"], F.lit("")), "A")),
    )
    more = first_truthy(F.col("j.additionalPlain"), html_text(_text("j.additional"), "A"))
    parts = F.concat(F.array(intro), sections, F.array(more))
    job = employment_type(F.col("j.categories.commitment"), lever=True)
    yearly = F.coalesce(F.col("j.salaryRange.interval").contains("year"), F.lit(False))
    created = F.when(F.coalesce("j.createdAt", F.lit(0)) != 0, F.timestamp_millis("j.createdAt"))
    return listing(
        "lever", rows,
        ord=item_ord("lever", F.col("page_ord"), F.col("pos")),
        title=F.col("j.text"),
        company=F.col("company"),
        location=_text("j.categories.location"),
        description=F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), "\n\n"),
        source_url=F.col("j.hostedUrl"),
        date_posted=iso(F.coalesce(created, run_ts)),
        salary_min=F.when(yearly, F.col("j.salaryRange.min")),
        salary_max=F.when(yearly, F.col("j.salaryRange.max")),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=F.coalesce("j.categories.team", "j.categories.department"),
    )


def ashby(pages: DataFrame, run_ts: Column) -> DataFrame:
    schema = (
        "jobs array<struct<id:string, title:string, department:string, team:string, employmentType:string, "
        "location:string, publishedAt:string, jobUrl:string, applyUrl:string, descriptionHtml:string, "
        "descriptionPlain:string, compensation:struct<summaryComponents:array<struct<compensationType:string, "
        "interval:string, minValue:double, maxValue:double>>>>>"
    )
    rows = _items(pages, schema, "jobs")
    has = lambda c, word: F.lower(F.coalesce(c, F.lit(""))).contains(word)
    given = lambda c: F.coalesce(c, F.lit(0.0)) != 0
    pay = F.get(
        F.filter(
            "j.compensation.summaryComponents",
            lambda c: has(c["compensationType"], "salary") & has(c["interval"], "year")
            & (given(c["minValue"]) | given(c["maxValue"])),
        ),
        F.lit(0),
    )
    job = employment_type(F.col("j.employmentType"))
    return listing(
        "ashby", rows,
        ord=item_ord("ashby", F.col("page_ord"), F.col("pos")),
        title=F.col("j.title"),
        company=F.col("company"),
        location=_text("j.location"),
        description=F.coalesce(
            F.nullif("j.descriptionPlain", F.lit("")), html_text(_text("j.descriptionHtml"), "A")
        ),
        source_url=F.coalesce(
            F.nullif("j.jobUrl", F.lit("")), F.nullif("j.applyUrl", F.lit("")),
            F.concat_ws("/", F.lit("https://jobs.ashbyhq.com"), "board_token", "j.id"),
        ),
        date_posted=F.coalesce(F.nullif("j.publishedAt", F.lit("")), iso(run_ts)),
        salary_min=pay["minValue"],
        salary_max=pay["maxValue"],
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=first_truthy(F.col("j.department"), F.col("j.team")),
    )


def workable(pages: DataFrame, run_ts: Column) -> DataFrame:
    schema = (
        "jobs array<struct<title:string, shortcode:string, employment_type:string, department:string, url:string, "
        "shortlink:string, published_on:string, created_at:string, country:string, city:string, state:string, "
        "description:string>>"
    )
    rows = _items(pages, schema, "jobs")
    job = employment_type(F.col("j.employment_type"))
    stamp = first_truthy(F.col("j.published_on"), F.col("j.created_at"))
    posted = parse_date(stamp)
    return listing(
        "workable", rows,
        ord=item_ord("workable", F.col("page_ord"), F.col("pos")),
        title=F.col("j.title"),
        company=F.col("company"),
        location=F.coalesce(
            F.nullif(join_truthy(F.col("j.city"), F.col("j.state")), F.lit("")), "j.country", F.lit("")
        ),
        description=html_text(_text("j.description"), "A"),
        source_url=F.coalesce(
            F.nullif("j.url", F.lit("")), F.nullif("j.shortlink", F.lit("")),
            F.concat(F.lit("https://apply.workable.com/"), "board_token", F.lit("/j/"), _text("j.shortcode")),
        ),
        date_posted=iso(F.coalesce(posted, F.when(stamp.isNull(), run_ts))),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=F.nullif("j.department", F.lit("")),
        row_error=_bad_date(stamp, posted),
    )


def smartrecruiters(lists: DataFrame, details: DataFrame, run_ts: Column) -> DataFrame:
    """List pages joined with detail pages on board and posting id; ids without detail drop out."""
    ids = _items(lists, "content array<struct<id:string>>", "content").where(truthy(F.col("j.id")))
    schema = (
        "id string, name string, releasedDate string, location struct<fullLocation:string, city:string, "
        "region:string, country:string>, typeOfEmployment struct<label:string>, department struct<label:string>, "
        "applyUrl string, canonicalPath string, jobAd struct<sections:map<string, struct<title:string, text:string>>>"
    )
    bodies = details.select("board_token", F.from_json("body", schema).alias("d"), F.col("ord").alias("detail_ord"))
    bodies = bodies.where("d.id is not null")
    first = bodies.groupBy("board_token", F.col("d.id").alias("id")).agg(F.min("detail_ord").alias("detail_ord"))
    bodies = bodies.join(first.select("detail_ord"), "detail_ord", "left_semi").select(
        "board_token", F.col("d.id").alias("id"), "d"
    )
    rows = ids.withColumn("id", F.col("j.id")).join(bodies, ["board_token", "id"])
    sections = F.transform(
        F.map_values(F.coalesce("d.jobAd.sections", F.create_map().cast("map<string,struct<title:string,text:string>>"))),
        lambda s: F.struct(s["title"].alias("title"), html_text(F.coalesce(s["text"], F.lit("")), "A").alias("text")),
    )
    blocks = F.transform(
        F.filter(sections, lambda s: s["text"] != ""),
        lambda s: trim_ws(F.concat(F.when(truthy(s["title"]), F.concat(s["title"], F.lit(":\n"))).otherwise(""), s["text"])),
    )
    place = join_truthy(F.col("d.location.city"), F.col("d.location.region"), F.col("d.location.country"))
    job = employment_type(F.col("d.typeOfEmployment.label"))
    return listing(
        "smartrecruiters", rows,
        ord=item_ord("smartrecruiters", F.col("page_ord"), F.col("pos")),
        title=F.col("d.name"),
        company=F.col("company"),
        location=F.coalesce(F.nullif("d.location.fullLocation", F.lit("")), place),
        description=trim_ws(F.array_join(blocks, "\n\n")),
        source_url=F.coalesce(
            F.nullif("d.applyUrl", F.lit("")),
            F.when(truthy(F.col("d.canonicalPath")), F.concat(F.lit("https://careers.smartrecruiters.com"), "d.canonicalPath")),
            F.concat(F.lit("https://api.smartrecruiters.com/v1/companies/"), "board_token", F.lit("/postings/"), "id"),
        ),
        date_posted=F.coalesce(F.nullif("d.releasedDate", F.lit("")), iso(run_ts)),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=F.nullif("d.department.label", F.lit("")),
    )


def breezy(pages: DataFrame, run_ts: Column) -> DataFrame:
    place = "name:string, city:string, state:struct<name:string>"
    schema = (
        "array<struct<id:string, friendly_id:string, name:string, url:string, published_date:string, "
        f"department:string, type:struct<name:string>, location:struct<{place}>, "
        f"locations:array<struct<{place}, primary:boolean>>>>"
    )
    rows = _items(pages, schema)
    named = F.filter("j.locations", lambda x: truthy(x["name"]))
    primary = F.filter(named, lambda x: F.coalesce(x["primary"], F.lit(False)))
    where = F.coalesce(
        F.nullif("j.location.name", F.lit("")),
        F.get(primary, F.lit(0))["name"],
        F.get(named, F.lit(0))["name"],
        join_truthy(F.col("j.location.city"), F.col("j.location.state.name")),
    )
    job = employment_type(F.col("j.type.name"))
    return listing(
        "breezy", rows,
        ord=item_ord("breezy", F.col("page_ord"), F.col("pos")),
        title=F.col("j.name"),
        company=F.col("company"),
        location=where,
        description=F.lit(""),
        source_url=F.coalesce(
            F.nullif("j.url", F.lit("")),
            F.concat(F.lit("https://"), "board_token", F.lit(".breezy.hr/p/"),
                     F.coalesce(F.nullif("j.friendly_id", F.lit("")), "j.id")),
        ),
        date_posted=F.coalesce(F.nullif("j.published_date", F.lit("")), iso(run_ts)),
        contract_type=job["contract_type"],
        contract_time=job["contract_time"],
        category=F.nullif("j.department", F.lit("")),
    )


def workday_site(url: Column) -> Column:
    """Site name in a board URL; a leading language code is skipped."""
    parts = path_parts(url)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.when(first.rlike(r"^[a-z]{2}-[A-Z]{2}\z") & second.isNotNull(), second).otherwise(first)


def workday(pages: DataFrame, run_ts: Column) -> DataFrame:
    """Paged search results; the first posting per path (or title, location, date) of a board stays."""
    schema = "jobPostings array<struct<title:string, externalPath:string, locationsText:string, postedOn:string>>"
    rows = _items(pages, schema, "jobPostings").where(hostname(F.col("url")).contains("myworkdayjobs.com"))
    rows = rows.withColumns(
        {
            "ord": item_ord("workday", F.col("page_ord"), F.col("pos")),
            "title": trim_ws(_text("j.title")),
            "base": F.concat(F.lit("https://"), host(F.col("url")), F.lit("/"), workday_site(F.col("url"))),
        }
    ).where("title <> '' and base is not null")
    key = F.coalesce(
        F.nullif("j.externalPath", F.lit("")),
        F.concat_ws("|", F.col("title"), _text("j.locationsText"), _text("j.postedOn")),
    )
    rows = keep_first(rows, [F.col("base"), F.col("company"), key])
    return listing(
        "workday", rows,
        ord=F.col("ord"),
        title=F.col("title"),
        company=F.col("company"),
        location=_text("j.locationsText"),
        description=F.lit(""),
        source_url=F.concat("base", _text("j.externalPath")),
        date_posted=iso(relative_date(F.col("j.postedOn"), run_ts)),
    )


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """All feeds as one table; ``ord`` already follows the fixed feed order."""
    out = feeds[0].select(*LISTING_COLUMNS, "row_error")
    for f in feeds[1:]:
        out = out.unionByName(f.select(*LISTING_COLUMNS, "row_error"))
    return out


def usable(listings: DataFrame) -> DataFrame:
    """Rows without error, as plain listings."""
    return listings.where("row_error is null").select(*LISTING_COLUMNS)


