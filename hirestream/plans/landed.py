"""A run from landed feed pages: every feed is parsed, rows that fail are put aside, the rest goes through the run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.plans.listings import Dimensions, RunResult, daily_run
from hirestream.session import stage
from hirestream.sources import feeds_html, feeds_json, feeds_xml

#: Pages of a source -> listings.  Two feeds have a second kind of page, landed as a source of its own.
Pages = Callable[[str], DataFrame]
FEEDS: dict[str, Callable[[Pages, Column], DataFrame]] = {
    "greenhouse": lambda pages, ts: feeds_json.greenhouse(pages("greenhouse")),
    "lever": lambda pages, ts: feeds_json.lever(pages("lever"), ts),
    "ashby": lambda pages, ts: feeds_json.ashby(pages("ashby"), ts),
    "workable": lambda pages, ts: feeds_json.workable(pages("workable"), ts),
    "smartrecruiters": lambda pages, ts: feeds_json.smartrecruiters(pages("smartrecruiters"), pages("smartrecruiters-detail"), ts),
    "breezy": lambda pages, ts: feeds_json.breezy(pages("breezy"), ts),
    "zoho": lambda pages, ts: feeds_xml.zoho(pages("zoho"), ts),
    "jobscore": lambda pages, ts: feeds_xml.jobscore(pages("jobscore"), ts),
    "workday": lambda pages, ts: feeds_json.workday(pages("workday"), ts),
    "paylocity": lambda pages, ts: feeds_html.paylocity(pages("paylocity"), ts),
    "ultipro": lambda pages, ts: feeds_html.ultipro(pages("ultipro"), pages("ultipro-results"), ts),
    "icims": lambda pages, ts: feeds_html.icims(pages("icims"), ts),
    "freshteam": lambda pages, ts: feeds_html.freshteam(pages("freshteam"), ts),
    "jobvite": lambda pages, ts: feeds_html.jobvite(pages("jobvite"), ts),
    "trinethire": lambda pages, ts: feeds_html.trinethire(pages("trinethire"), ts),
}


def listings_from_pages(pages: DataFrame, run_ts: Column, providers: Sequence[str] = C.PROVIDERS) -> DataFrame:
    """The listings of all feeds in feed order, with ``row_error``.

    ``pages`` has the columns of ``schemas.RAW_PAYLOAD``; each feed reads its own
    source only, so a table partitioned by ``source`` is read once altogether.
    """
    feeds = [FEEDS[p](lambda source: pages.where(F.col("source") == source), run_ts) for p in C.PROVIDERS if p in set(providers)]
    return feeds_json.union_feeds(feeds)


def failed_rows(rows: DataFrame) -> DataFrame:
    """Where the rows with ``row_error`` stand, and why they failed."""
    return rows.where("row_error is not null").select("ord", "source", "company", "title", "source_url", "row_error")


class PageRun(NamedTuple):
    """A run and the rows that it put aside: where they stand, and why."""

    run: RunResult
    failed: DataFrame


def daily_run_from_pages(
    pages: DataFrame, dims: Dimensions, run_ts: Column, providers: Sequence[str] = C.PROVIDERS, duration_ms: Column | None = None
) -> PageRun:
    """Landed pages to the change set: parse, put failed rows aside, then everything ``daily_run`` does.

    A failed row costs neither its board nor the run; it is counted as an error of
    the run.  Pages are parsed once: the rows are staged, as the run reads them
    again for the texts of the listings that are left.
    """
    rows = stage(listings_from_pages(pages, run_ts, providers), "landed-listings")
    return PageRun(daily_run(rows, dims, run_ts, duration_ms), failed_rows(rows))
