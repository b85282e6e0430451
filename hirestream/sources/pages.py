"""Jobs over tables of HTML pages ``(page_id, url, html)``."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.functions.keys import computed
from hirestream.functions.text import decode_entities, html_text, page_text, strip_cdata, trim_ws
from hirestream.functions.urls import drop_query, hostname, resolve
from hirestream.session import STAGED, scratch_path, stage


def _reject(token: str):
    raise ValueError(token)


_DECODER = json.JSONDecoder(parse_constant=_reject)


def _find_posting(node):
    """Depth-first search for a job posting: lists in order, self, ``@graph``, other children."""
    stack = [node]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack.extend(reversed(node))
        elif isinstance(node, dict):
            kind = node.get("@type")
            kinds = kind if isinstance(kind, list) else [kind]
            if any(isinstance(k, str) and k.lower() == "jobposting" for k in kinds):
                return node
            graph = [node["@graph"]] if node.get("@graph") else []
            stack.extend(reversed(graph + list(node.values())))
    return None


def _first_posting(scripts: pd.Series) -> pd.Series:
    def one(texts):
        for text in () if texts is None else texts:
            try:
                found = _find_posting(json.loads(text, parse_constant=_reject))
            except (ValueError, RecursionError):  # not JSON, or nested too deeply
                continue
            if found is not None:
                return json.dumps(found, ensure_ascii=False)
        return None

    return scripts.map(one, na_action=None).astype(object)


def with_posting(pages: DataFrame) -> DataFrame:
    """Add ``posting``: the first job posting in the JSON-LD scripts of each page, as JSON text, or NULL.

    A script whose root is the posting is picked in the JVM; only documents before
    it go through an Arrow batch that walks the tree.  Malformed scripts are
    skipped.  Each page is read once and never shuffled.
    """
    scripts = F.regexp_extract_all(
        "html",
        F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""),
        F.lit(1),
    )
    marked = F.contains(F.lower("html"), F.lit("application/ld+json"))
    docs = F.filter(F.transform(scripts, lambda raw: decode_entities(strip_cdata(trim_ws(raw)))), lambda d: d != "")
    found = computed(pages, {"__docs": F.when(marked, docs)})
    kind = lambda d: F.lower(F.try_variant_get(F.try_parse_json(d), '$["@type"]', "string"))
    rooted = F.array_position(F.transform("__docs", lambda d: F.coalesce(kind(d) == "jobposting", F.lit(False))), True)
    found = computed(found, {"__at": F.coalesce(rooted, F.lit(0)).cast("int")})
    before = F.when(F.col("__at") > 0, F.slice("__docs", 1, F.col("__at") - 1)).otherwise(F.col("__docs"))
    walk = F.pandas_udf(_first_posting, "string")
    walked = found.withColumn("__nested", walk(F.when(F.size(before) > 0, before)))
    root = F.when(F.col("__at") > 0, F.get("__docs", F.col("__at") - 1))
    # computed, so that a filter on the posting does not walk the trees a second time
    return computed(walked, {"posting": F.coalesce("__nested", root)}).drop("__docs", "__at", "__nested")


def extract_jsonld_postings(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``(key, posting)`` of the pages with a posting."""
    return with_posting(pages.select(key, "html")).select(key, "posting").where("posting is not null")


def meta_content(html: Column, name: str) -> Column:
    """Content of a ``<meta property|name=... content=...>`` tag, or ``""``."""
    pattern = (
        rf"""(?is)<meta[^>]*(?:property|name)=["']{re.escape(name)}["'][^>]*content=["'](.*?)["'][^>]*>"""
    )
    return decode_entities(trim_ws(F.regexp_extract(html, pattern, 1)))


def extract_meta(pages: DataFrame, name: str, out: str = "meta") -> DataFrame:
    return pages.withColumn(out, meta_content(F.col("html"), name))


def text_by_class(html: Column, cls: str) -> Column:
    """Text of the first element whose class contains ``cls``, up to its closing tag."""
    pattern = rf"""(?is)<([a-z0-9]+)[^>]*class=["'][^"']*{re.escape(cls)}[^"']*["'][^>]*>(.*?)</\1>"""
    return page_text(decode_entities(F.regexp_extract(html, pattern, 2)))


def extract_text_by_class(pages: DataFrame, cls: str, out: str = "text") -> DataFrame:
    return pages.withColumn(out, text_by_class(F.col("html"), cls))


def pages_to_text(pages: DataFrame, variant: str = "B", out: str = "text") -> DataFrame:
    return pages.withColumn(out, html_text(F.col("html"), variant))


# fixed values: link patterns per feed; {slug} is the board name
LINK_PATTERNS = {
    "icims_detail": r"""(?i)href=["'](/jobs/[0-9]+/[^"']+)["']""",
    "icims_detail_absolute": r"""(?i)(https?://[^"'\s]+/jobs/[0-9]+/[^"'\s<]+)""",
    "icims_search": r"""(?i)href=["'](/jobs/search\?[^"']+)["']""",
    "icims_search_absolute": r"""(?i)(https?://[^"'\s<]+/jobs/search\?[^"'\s<]+)""",
    "freshteam": r"""(?i)href=["'](/jobs/[A-Za-z0-9_-]+/[^"']+)["']""",
    "jobvite": r"""(?i)href=["'](/{slug}/job/[^"']+)["']""",
    "trinethire": r"""(?i)href=["'](/companies/{slug}/jobs/[0-9]+-[^"']+)["']""",
}


def link_pattern(feed: str, slug: str = "") -> str:
    """The link pattern of a feed, with the board name filled in where it has one."""
    return LINK_PATTERNS[feed].replace("{slug}", re.escape(slug))


def extract_links(pages: DataFrame, pattern: str, key: str = "page_id") -> DataFrame:
    """``(key, link)``: distinct absolute links matching ``pattern`` (one capture group).

    Root-relative links are resolved against the page URL; entities are decoded.
    """
    found = F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))
    links = pages.select(key, "url", F.explode(found).alias("raw"))
    link = resolve(decode_entities(F.col("raw")), F.col("url"))
    return links.select(key, link.alias("link")).where("link is not null").distinct()


#: Levels of a crawl after which its visited pages are merged.
MERGED_LEVELS = 4
#: Boards that are listed together for the pages of a block, about.
BOARDS_A_ROW = 1024


def search_page_frontier(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """All search pages reachable from the seeds of each board: ``(board, page, level)``.

    ``seeds`` is ``(board, page)``, ``links`` is ``(page, link)``; links to another
    host are not followed.  Boards with the same seeds are one crawl, handed to its
    boards at the end.  Breadth first and semi-naive: a round follows the links of
    the last level only, and writes its level into one growing table, which is the
    visited set; plans don't grow, and there are as many rounds as levels.  A row is
    a page (by number) and the crawls of a block of 64 that reach it, as bits, so crawls over the
    same pages go together (multi-source breadth-first search, PVLDB 2014).  A page
    can be reached in many levels by crawls of its block; every few levels the visited
    set is merged to one row a page and block.
    """
    spark = seeds.sparkSession
    edges = links.where(hostname(F.col("page")) == hostname(F.col("link"))).select("page", "link").distinct()
    edges = stage(edges, "page-links")
    start = seeds.groupBy("board").agg(F.array_sort(F.collect_set("page")).alias("pages"))
    boards = stage(start.withColumn("key", F.md5(F.to_json("pages").cast("binary"))), "boards")
    crawls = boards.groupBy("key").agg(F.first("pages").alias("pages")).repartitionByRange(F.get("pages", F.lit(0)))
    crawls = stage(crawls.withColumn("crawl", F.monotonically_increasing_id()), "crawls")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("crawl").bitwiseAND(F.lit(63)).cast("int"))
    reached = crawls.select(F.shiftright("crawl", 6).alias("block"), F.explode("pages").alias("page"), bit.alias("bits"))
    names = reached.select("page").unionByName(edges.select("page")).unionByName(edges.select(F.col("link").alias("page"))).distinct()
    names = stage(names.withColumn("id", F.monotonically_increasing_id()), "page-ids")
    reached = reached.join(names, "page").groupBy("block", "id").agg(F.bit_or("bits").alias("bits"))
    to = names.select(F.col("page").alias("link"), F.col("id").alias("to"))
    edges = stage(edges.join(names, "page").join(to, "link").select("id", "to"), "page-id-links")
    table = scratch_path(spark, "visited-pages")
    STAGED.append(table)
    schema, level = "block bigint, id bigint, bits bigint", 0
    none = F.lit(0).cast("bigint")
    merged, single = [], []
    while True:
        reached.select("block", "id", "bits").write.parquet(f"{table}/level={level}")
        last = spark.read.schema(schema).parquet(f"{table}/level={level}")
        if last.isEmpty():
            break
        single.append(f"{table}/level={level}")
        level += 1
        visited = spark.read.schema(schema).parquet(*merged, *single)
        if len(single) == MERGED_LEVELS:
            visited = stage(visited.groupBy("block", "id").agg(F.bit_or("bits").alias("bits")), "merged-pages")
            merged, single = [STAGED[-1]], []
        found = last.join(edges, "id").select("block", F.col("to").alias("id"), F.col("bits").alias("new"), none.alias("seen"))
        both = found.unionByName(visited.select("block", "id", none.alias("new"), F.col("bits").alias("seen")))
        both = both.groupBy("block", "id").agg(F.bit_or("new").alias("new"), F.bit_or("seen").alias("seen"))
        reached = both.select("block", "id", F.col("new").bitwiseAND(F.bitwise_not("seen")).alias("bits")).where("bits <> 0")
    visited = spark.read.schema(f"{schema}, level int").parquet(table).join(names, "id")
    # the boards of a block go to its pages before these are taken apart: only rows of bits are shuffled
    of = boards.join(crawls.select("key", "crawl"), "key").select(
        F.shiftright("crawl", 6).alias("block"), F.struct(F.col("crawl").bitwiseAND(F.lit(63)).cast("int").alias("i"), "board").alias("b"))
    lists = F.ceil(F.col("n") / BOARDS_A_ROW)
    of = of.join(of.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "block").groupBy(
        "block", F.pmod(F.xxhash64("b"), lists).alias("list")).agg(F.collect_list("b").alias("of"))
    held = F.filter("of", lambda b: F.call_function("shiftrightunsigned", F.col("bits"), b["i"]).bitwiseAND(F.lit(1)) == 1)
    each = visited.join(of.select("block", "of"), "block").select(F.explode(held["board"]).alias("board"), "page", "level")
    return each.select("board", "page", "level")


def detail_links(frontier: DataFrame, details: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(board, link)``: distinct detail pages found on visited search pages.

    ``details`` is ``(page, link)``.  Query and fragment are dropped.  A board
    without any found link falls back to a seed that is itself a detail page.
    """
    found = frontier.join(details, "page").select("board", drop_query(F.col("link")).alias("link")).distinct()
    direct = (
        seeds.where(F.col("page").rlike(r"(?i)/jobs/\d+/.+/job"))
        .join(found.select("board").distinct(), "board", "left_anti")
        .select("board", drop_query(F.col("page")).alias("link"))
        .distinct()
    )
    return found.unionByName(direct)


def _json_at(html: pd.Series, start: pd.Series) -> pd.Series:
    def one(text: str, at: int):
        try:
            return text[at : _DECODER.raw_decode(text, at)[1]]
        except (ValueError, RecursionError):
            return None

    return pd.Series([None if h is None else one(h, int(s)) for h, s in zip(html, start)], dtype=object)


def embedded_json(pages: DataFrame, marker: str, opening: str, out: str) -> DataFrame:
    """Add the JSON value that starts at the first ``opening`` bracket after ``marker``.

    ``marker`` is a case-sensitive or ``(?i)`` pattern.  Regular expressions
    cannot balance brackets, so the value is cut out by a JSON decoder in an Arrow
    batch, which gets only pages that have the marker.
    """
    before = F.regexp_extract("html", rf"(?s)^(.*?{marker}[^\{opening}]*)\{opening}", 1)
    start = F.when(F.regexp_like("html", F.lit(marker)), F.nullif(F.length(before), F.lit(0)))
    hit = computed(pages, {"__start": start})
    cut = F.pandas_udf(_json_at, "string")
    value = hit.withColumn("__value", cut(F.when(F.col("__start").isNotNull(), F.col("html")), "__start"))
    # computed, so that filters on the value do not cut it out again
    return computed(value, {out: F.col("__value")}).drop("__start", "__value")
