"""Crawl of search boards over landed pages: seed candidates, search pages, detail links.

Fetching is not part of it: what was landed is what can be followed.  A page that
was not landed is visited, but leads nowhere.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirestream.functions.text import decode_entities, trim_ws
from hirestream.functions.urls import host, is_url, origin, param, path, resolve, with_search_url
from hirestream.sources.pages import detail_links, search_page_frontier

_SEARCH = "/jobs/search"
_ABSOLUTE_SEARCH = r"""(?i)(https?://[^"'\s<]+/jobs/search\?[^"'\s<]+)"""
_RELATIVE_SEARCH = r"""(?i)href=["'](/jobs/search\?[^"']+)["']"""
_ABSOLUTE_JOB = r"""(?i)(https?://[^"'\s]+/jobs/\d+/[^"'\s<]+)"""
_RELATIVE_JOB = r"""(?i)href=["'](/jobs/\d+/[^"']+)["']"""


def seed_candidates(seeds: DataFrame) -> DataFrame:
    """``(board, page)``: the pages a crawl of ``seeds (board, seed_url)`` starts from.

    The seed in canonical form if it is a search page, the plain search of its
    host, with and without frame, keeping a ``hashed`` parameter, and the seed
    itself if it is no search page.  A seed that is no URL has none.
    """
    u = F.col("seed")
    is_search = path(u).contains(_SEARCH)
    hashed = F.nullif(param(u, "hashed"), F.lit(""))
    plain = F.concat(origin(u), F.lit(f"{_SEARCH}?ss=1"), F.coalesce(F.concat(F.lit("&hashed="), F.url_encode(hashed)), F.lit("")))
    given = seeds.select("board", trim_ws(F.col("seed_url")).alias("seed")).where(is_url(u))
    raw = given.select("board", "seed", F.explode(F.array_compact(F.array(
        F.when(is_search, u), plain, F.concat(plain, F.lit("&in_iframe=1"))))).alias("raw"))
    search = with_search_url(raw, "raw", "page", host(u)).where("page is not null").select("board", "page")
    return search.unionByName(given.where(~is_search).select("board", F.col("seed").alias("page"))).distinct()


def _found(pages: DataFrame, absolute: str, relative: str) -> DataFrame:
    """``(page, link)`` of absolute links, in which ``&amp;`` is decoded, and root-relative ones."""
    whole = F.transform(F.regexp_extract_all("html", F.lit(absolute), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))
    rooted = F.transform(F.regexp_extract_all("html", F.lit(relative), F.lit(1)), lambda x: resolve(decode_entities(x), F.col("url")))
    links = pages.select(F.col("url").alias("page"), F.explode(F.array_distinct(F.concat(whole, rooted))).alias("link"))
    return links.where("link is not null")


def search_links(pages: DataFrame) -> DataFrame:
    """``(page, link)``: canonical search pages of the same host that ``pages (url, html)`` link to."""
    raw = _found(pages, _ABSOLUTE_SEARCH, _RELATIVE_SEARCH)
    canonical = with_search_url(raw.withColumnRenamed("link", "raw"), "raw", "link", host(F.col("page")))
    return canonical.where("link is not null").select("page", "link").distinct()


def job_links(pages: DataFrame) -> DataFrame:
    """``(page, link)``: detail pages that ``pages (url, html)`` link to, on any host."""
    return _found(pages, _ABSOLUTE_JOB, _RELATIVE_JOB).distinct()


class Crawl(NamedTuple):
    """``visited (board, page, level)`` and ``details (board, link)``."""

    visited: DataFrame
    details: DataFrame


def crawl_search_boards(seeds: DataFrame, pages: DataFrame) -> Crawl:
    """Everything that can be reached from ``seeds (board, seed_url)`` over landed ``pages (url, html)``.

    ``url`` is the canonical address under which a page was fetched.  Detail links
    lose query and fragment; a board without any keeps its seed if that is a
    detail page itself.
    """
    visited = search_page_frontier(seed_candidates(seeds), search_links(pages))
    direct = seeds.select("board", trim_ws(F.col("seed_url")).alias("page"))
    return Crawl(visited, detail_links(visited, job_links(pages), direct))
