"""URL column expressions.

Only ``http`` and ``https`` URLs are taken apart; anything else counts as
unparsable.  Host names are lower-cased and default ports dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import computed
from hirestream.functions.text import trim_ws, truthy

_URL = r"^(?i)(https?)://(?:[^/?#@]*@)?([^/?#\s:]+)(:[0-9]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def _part(c: Column, n: int) -> Column:
    return F.regexp_extract(c, "(?s)" + _URL, n)


def is_url(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike("(?s)" + _URL)


def scheme(c: Column) -> Column:
    return F.lower(_part(c, 1))


def hostname(c: Column) -> Column:
    """Lower-case host name without port; NULL when not a URL."""
    return F.nullif(F.lower(_part(c, 2)), F.lit(""))


def host(c: Column) -> Column:
    """Host name with a non-default port."""
    port = _part(c, 3)
    default = F.when(scheme(c) == "https", ":443").otherwise(":80")
    return F.concat(hostname(c), F.when(port.isin(":", "") | (port == default), "").otherwise(port))


def origin(c: Column) -> Column:
    return F.concat(scheme(c), F.lit("://"), host(c))


def path(c: Column) -> Column:
    p = _part(c, 4)
    return F.when(p == "", "/").otherwise(p)


def query(c: Column) -> Column:
    """Query text without the question mark."""
    return F.regexp_replace(_part(c, 5), r"^\?", "")


def path_parts(c: Column) -> Column:
    return F.filter(F.split(path(c), "/"), lambda p: p != "")


def param(c: Column, name: str) -> Column:
    """Decoded first value of a query parameter, NULL when absent."""
    raw = F.regexp_extract(F.concat(F.lit("&"), query(c)), rf"&{name}=([^&]*)", 1)
    present = F.concat(F.lit("&"), query(c)).rlike(rf"&{name}(?:=|&|\z)")
    return F.when(present, F.coalesce(F.try_url_decode(raw), raw))


def with_canonical_url(
    df: DataFrame, source: str, out: str, strip: list[str] | None = None
) -> DataFrame:
    """Posting identity of a URL: no fragment, no tracking parameters, no trailing slash."""
    strip = C.TRACKING_PARAMS if strip is None else strip
    t = F.col("__t")
    kept = F.filter(
        F.split(query(t), "&"),
        lambda kv: (kv != "") & ~F.substring_index(kv, "=", 1).isin(strip),
    )
    kept = F.transform(kept, lambda kv: F.when(kv.contains("="), kv).otherwise(F.concat(kv, F.lit("="))))
    search = F.replace(F.array_join(kept, "&"), F.lit("%20"), F.lit("+"))
    df = df.withColumn("__t", trim_ws(F.coalesce(F.col(source), F.lit(""))))
    df = df.withColumns({"__path": F.regexp_replace(path(t), r"/+\z", ""), "__search": search})
    full = F.concat(
        origin(t),
        F.when(F.col("__path") == "", "/").otherwise(F.col("__path")),
        F.when(F.col("__search") != "", F.concat(F.lit("?"), F.col("__search"))).otherwise(""),
    )
    df = computed(df, {out: F.when(is_url(t), full).otherwise(F.regexp_replace(t, r"/+\z", ""))})
    return df.drop("__t", "__path", "__search")


def canonical_seed_url(c: Column) -> Column:
    """Board identity of a seed URL: origin, path without trailing slash, query as is."""
    bare = F.regexp_replace(path(c), r"/+\z", "")
    search = F.when(query(c) == "", "").otherwise(F.concat(F.lit("?"), query(c)))
    full = F.concat(origin(c), F.when(bare == "", "/").otherwise(bare), search)
    return F.when(is_url(c), full).otherwise(F.lower(trim_ws(c)))


def ensure_protocol(c: Column) -> Column:
    t = trim_ws(F.coalesce(c, F.lit("")))
    return (
        F.when(t == "", "").when(t.rlike("(?i)^https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    )


def with_unwrapped_url(df: DataFrame, source: str, out: str) -> DataFrame:
    """Undo up to three rounds of mail-filter link wrapping.

    The result is NULL when a wrapped link holds something that is not a URL.
    """
    def unwrap(u: Column, _: Column) -> Column:
        safelink = hostname(u).contains("safelinks.protection.outlook.com")
        inner = F.when(safelink, F.coalesce(F.nullif(param(u, "url"), F.lit("")), u)).otherwise(u)
        wrapped = F.when(
            hostname(inner).contains("urldefense.com"), F.regexp_extract(path(inner), "__(.+?)__", 1)
        )
        # a plus sign is literal in a path
        decoded = F.try_url_decode(F.replace(wrapped, F.lit("+"), F.lit("%2B")))
        decoded = F.regexp_replace(decoded, r"(?i)^(https?):/(?=[^/])", "$1://")
        step = F.when(truthy(wrapped), decoded).otherwise(inner)
        return F.when(~is_url(u), u).otherwise(F.when(is_url(inner), step))

    rounds = F.array(F.lit(1), F.lit(2), F.lit(3))
    return computed(df, {out: F.aggregate(rounds, trim_ws(F.col(source)), unwrap)})


def resolve(link: Column, base: Column) -> Column:
    """Absolute form of a root-relative or absolute link."""
    return F.when(is_url(link), link).otherwise(F.concat(origin(base), link))


def drop_query(c: Column) -> Column:
    return F.when(is_url(c), F.concat(origin(c), path(c))).otherwise(c)


def with_search_url(df: DataFrame, source: str, out: str, expected_host: Column) -> DataFrame:
    """Canonical search-page URL of one host: known parameters in fixed order, else NULL.

    ``ss=1`` is added when neither ``ss`` nor ``pr`` is given and ``in_iframe=1``
    when ``pr`` is; added parameters come last.
    """
    u = F.col(source)
    df = df.withColumn(
        "__given",
        F.struct(*[F.nullif(param(u, p), F.lit("")).alias(p) for p in C.SEARCH_PARAMS]),
    )
    given = {p: F.col("__given")[p] for p in C.SEARCH_PARAMS}
    pairs = [F.concat(F.lit(f"{p}="), F.url_encode(given[p])) for p in C.SEARCH_PARAMS]
    pairs.append(F.when(given["ss"].isNull() & given["pr"].isNull(), "ss=1"))
    pairs.append(F.when(given["in_iframe"].isNull() & given["pr"].isNotNull(), "in_iframe=1"))
    q = F.array_join(F.array_compact(F.array(*pairs)), "&")
    ok = is_url(u) & (host(u) == expected_host) & path(u).contains("/jobs/search")
    found = F.when(ok, F.concat(origin(u), F.lit("/jobs/search?"), q))
    return df.withColumn(out, found).drop("__given")
