"""Which boards to read: detected links to source seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.functions.keys import computed, first_by_key
from hirestream.functions.text import norm_key, trim_ws
from hirestream.functions.urls import (
    canonical_seed_url,
    host,
    hostname,
    is_url,
    origin,
    param,
    path,
    query,
    with_unwrapped_url,
)
from hirestream.sources.feeds_json import workday_site


def _at(parts: Column, i: int) -> Column:
    return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))


def _after(parts: Column, name: str) -> Column:
    """The path part behind ``name``, NULL when there is none."""
    at = F.array_position(parts, name).cast("int")
    return F.when(at > 0, F.get(parts, at))


def _normal_url(u: Column) -> Column:
    q = query(u)
    fragment = F.regexp_extract(u, r"(#.*)\z", 1)
    return F.concat(origin(u), path(u), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""), fragment)


def classify_detections(detections: DataFrame) -> DataFrame:
    """Add ``provider``, ``token`` and ``source_url`` to unwrapped detections; NULL provider = unknown."""
    d = with_unwrapped_url(detections, "url", "u").where(is_url(F.col("u")))
    u, ats, h, parts = F.col("u"), F.col("ats_name"), F.col("h"), F.col("parts")
    d = computed(
        d,
        {
            "ats_name": F.lower(trim_ws(F.regexp_replace("ats", r"\s*\([^)]+\)\s*\z", ""))),
            "h": hostname(u),
            "parts": F.filter(F.split(path(u), "/"), lambda p: p != ""),
            "site": F.concat(F.lit("https://"), host(u)),
            "p": path(u),
            "own": _normal_url(u),
        },
    )
    own = F.col("own")
    low = F.transform(parts, F.lower)
    a0, a1, a2, a3 = (_at(low, i) for i in range(4))
    third = _at(parts, 3)
    jobs = (a0 == "recruiting") & (a1 == "jobs") & (third != "") & (F.size(parts) >= 4)
    board, detail = jobs & a2.isin("all", "list"), jobs & a2.isin("details", "apply")
    pay_url = (
        F.when(board, F.concat("site", F.lit("/recruiting/jobs/"), a2, F.lit("/"), third))
        .when(detail, F.concat("site", F.lit("/recruiting/jobs/"), a2, F.lit("/"), third))
        .otherwise(F.concat("site", "p"))
    )
    pay_token = (
        F.when(board, F.concat(F.lit("board:"), a2, F.lit(":"), a3))
        .when(detail, F.concat(F.lit("detail:"), a3))
        .otherwise(F.concat(F.lit("other:"), F.lower("p")))
    )
    first = _at(parts, 0)
    # a company code, a segment, and the board: groups of hex digits
    is_board = lambda x, i: (i >= 2) & x.rlike(r"(?i)\A[0-9a-f]+(-[0-9a-f]+)+\z")
    board_at = F.array_position(F.transform(parts, is_board), True).cast("int")
    ulti_board = F.when(board_at > 0, F.concat(F.get(parts, board_at - 2), F.lit("/"), F.get(parts, board_at - 1)))
    ulti_host = h.isin("recruiting.ultipro.com", "recruiting2.ultipro.com")
    ulti_url = F.when(
        ulti_host & ulti_board.isNotNull(), F.concat(origin(u), F.lit("/"), first, F.lit("/"), ulti_board, F.lit("/"))
    ).when(ulti_host & (first != ""), F.concat(origin(u), F.lit("/"), first, F.lit("/")))
    hashed = F.nullif(param(u, "hashed"), F.lit(""))
    icims_url = F.concat(
        origin(u), F.lit("/jobs/search?ss=1"), F.coalesce(F.concat(F.lit("&hashed="), F.url_encode(hashed)), F.lit(""))
    )
    smart = F.coalesce(
        F.nullif(param(u, "dcr_ci"), F.lit("")), _after(parts, "company"), F.when(first != "oneclick-ui", first)
    )
    score_host = h.isin("careers.jobscore.com", "www.jobscore.com")
    score = F.when(score_host, F.coalesce(_after(parts, "careers"), _after(parts, "jobs"))).when(
        h == "widgets.jobscore.com", _after(parts, "jobs")
    )
    sub = lambda domain: F.regexp_replace(h, rf"\.{domain}\z", "")
    vite = F.when(F.lower(first) != "support", first)
    trinet = _after(parts, "companies")
    # fixed values: detector names and hosts; provider, condition, token, URL
    rules = [
        ("ashby", (ats == "ashby") & h.endswith("ashbyhq.com"), first, own),
        ("workable", (ats == "workable") & (h == "apply.workable.com"),
         F.when(first.isin("j", "jobs", "api"), "").otherwise(first), own),
        ("smartrecruiters", (ats == "smartrecruiters") & h.endswith("smartrecruiters.com"), smart, own),
        ("breezy", (ats == "breezy hr") & h.endswith(".breezy.hr"), sub(r"breezy\.hr"), own),
        ("zoho", (ats == "zoho recruit") & h.endswith(".zohorecruit.com"), sub(r"zohorecruit\.com"), own),
        ("jobscore", (ats == "jobscore") & h.endswith("jobscore.com"), score, own),
        ("workday", (ats == "workday") & h.contains("myworkdayjobs.com"), F.lit(""),
         F.concat("site", F.lit("/"), workday_site(u))),
        ("paylocity", (ats == "paylocity") & (h == "recruiting.paylocity.com"), pay_token, pay_url),
        ("ultipro", (ats == "ultipro") & h.endswith(".ultipro.com"), F.lit(""), ulti_url),
        ("icims", (ats == "icims") & h.endswith(".icims.com"), F.lit(""), icims_url),
        ("freshteam", (ats == "freshteam") & h.endswith(".freshteam.com"), sub(r"freshteam\.com"),
         F.concat(F.lit("https://"), sub(r"freshteam\.com"), F.lit(".freshteam.com/jobs"))),
        ("jobvite", (ats == "jobvite") & (h == "jobs.jobvite.com"), vite,
         F.concat(F.lit("https://jobs.jobvite.com/"), F.nullif(vite, F.lit("")), F.lit("/jobs"))),
        ("trinethire", ats.isin("trinet hire", "tri net hire") & (h == "app.trinethire.com"), trinet,
         F.concat(F.lit("https://app.trinethire.com/companies/"), trinet, F.lit("/jobs"))),
    ]

    def pick(i: int) -> Column:
        chain = F
        for rule in rules:
            chain = chain.when(rule[1], F.lit(rule[0]) if i == 0 else rule[i])
        return chain

    return computed(
        d,
        {
            "provider": pick(0),
            "token": F.coalesce(pick(2), F.lit("")),
            "source_url": F.coalesce(pick(3), F.lit("")),
        },
    )


def discover_sources(detections: DataFrame) -> DataFrame:
    """Source seeds from detected links (``schemas.SITE_DETECTION``).

    Links are unwrapped and classified; links without a usable board are dropped;
    per firm, provider and board the first link stays; single-posting links give
    way when the firm has a whole board at the same provider.
    """
    named = detections.where("url <> '' and ats <> ''").withColumn(
        "company_name", F.coalesce(F.nullif(trim_ws(F.coalesce("firm_name", F.lit(""))), F.lit("")), "firm_key")
    )
    d = classify_detections(named.withColumn("firm_key", norm_key(F.col("company_name"))))
    # fixed values: feeds that can do without a token
    tokenless = F.col("provider").isin("workable", "workday", "paylocity", "ultipro", "icims")
    artefact = (F.col("provider") == "breezy") & (
        (F.col("token") == "app") | F.lower("p").contains("/api/messenger/")
    )
    d = d.where("provider is not null and source_url <> ''").where(tokenless | (F.col("token") != ""))
    d = d.where(~artefact)
    d = d.withColumn("dedup", F.lower(F.coalesce(F.nullif("token", F.lit("")), "source_url")))
    d = d.select("firm_ord", "det_ord", "firm_key", "company_name", "provider", "token", "source_url", "dedup")
    kept = first_by_key(d, ["firm_key", "provider", "dedup"], F.struct("firm_ord", "det_ord"))
    return paylocity_board_prune(kept).select(
        "firm_ord", "det_ord", "firm_key", "company_name", "provider", "token", "source_url"
    )


def paylocity_board_prune(seeds: DataFrame) -> DataFrame:
    """Drop single-posting seeds of firms that have a board seed."""
    boards = (
        seeds.where("provider = 'paylocity' and token like 'board:%'")
        .select("firm_key")
        .distinct()
        .withColumn("__board", F.lit(True))
    )
    single = (F.col("provider") == "paylocity") & F.col("token").startswith("detail:")
    marked = seeds.join(boards, "firm_key", "left")
    return marked.where(~(single & F.coalesce("__board", F.lit(False)))).drop("__board")


def allowed_firm_keys(detections: DataFrame) -> DataFrame:
    """Keys of all firms in the detection table, with or without a usable board."""
    name = F.coalesce(F.nullif(trim_ws(F.coalesce("firm_name", F.lit(""))), F.lit("")), "firm_key")
    return detections.select(norm_key(name).alias("firm_key")).where("firm_key <> ''").distinct()


# fixed values: feeds whose seeds are identified by token, by token or URL, or by URL
SEED_BY_TOKEN = ["greenhouse", "lever", "ashby", "smartrecruiters", "breezy", "jobscore"]
SEED_BY_TOKEN_OR_URL = ["workable", "zoho"]


def seed_key() -> Column:
    url = canonical_seed_url(F.col("source_url"))
    return (
        F.when(F.col("provider").isin(SEED_BY_TOKEN), F.col("token"))
        .when(F.col("provider").isin(SEED_BY_TOKEN_OR_URL), F.coalesce(F.nullif("token", F.lit("")), url))
        .otherwise(url)
    )


def seed_dedup(seeds: DataFrame, order: str = "ord") -> DataFrame:
    """First seed per provider and seed key; seeds with a blank key are dropped.

    Seeds that name the same board alike come together first, so each spelling is
    taken apart once, however many seeds have it.
    """
    first = F.min_by(F.struct(*seeds.columns), order).alias("__row")
    alike = seeds.groupBy("provider", "token", "source_url").agg(first, F.min(order).alias("__order"))
    keyed = computed(alike, {"__key": F.trim(seed_key())}).where("__key <> ''")
    keyed = keyed.withColumn("__key", F.lower(F.trim(F.concat("provider", F.lit(" "), "__key")))).where("__key <> ''")
    return keyed.groupBy("__key").agg(F.min_by("__row", "__order").alias("__row")).select("__row.*")


def board_seed_key(u: Column) -> Column:
    """Identity of a search board: its search page with the parameters that select content."""
    is_search = path(u).contains("/jobs/search")
    names = ["pr", "hashed", "searchRelation"]
    pairs = [
        F.when(
            (is_search | F.lit(p == "hashed")) & (F.coalesce(param(u, p), F.lit("")) != ""),
            F.concat(F.lit(f"{p}="), F.url_encode(param(u, p))),
        )
        for p in names
    ]
    q = F.array_join(F.array_compact(F.array(*pairs)), "&")
    return F.when(is_url(u), F.concat(origin(u), F.lit("/jobs/search?"), q)).otherwise(u)


def alias_folding(seeds: DataFrame) -> DataFrame:
    """One row per seed with the board it belongs to and the company the board is read for.

    The first seed of a board is its primary one, the others are aliases of it.
    Names are not gathered into a list, so a board may have any number of them.
    """
    keyed = seeds.withColumn("board_key", board_seed_key(F.col("source_url")))
    first = keyed.groupBy("board_key").agg(
        F.min("ord").alias("primary_ord"),
        F.min_by("company_name", "ord").alias("primary_company"),
        F.min_by("source_url", "ord").alias("seed_url"),
        (F.count(F.lit(1)) - 1).alias("n_aliases"),
    )
    return keyed.join(first, "board_key").select(
        "ord", "board_key", "seed_url", "primary_company", "company_name",
        (F.col("ord") != F.col("primary_ord")).alias("is_alias"), "n_aliases",
    )
