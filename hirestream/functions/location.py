"""Free-form location text to city, state and remote flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.text import RIGHT, WS, blank, quoted, trim_ws, whole_word

_REMOTE = ["remote", "hybrid"]
_NAMES = "|".join(C.STATES.values())


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    flat = ", ".join(quoted(x) for kv in pairs.items() for x in kv)
    return F.try_element_at(F.expr(f"map({flat})"), key)


def clean_part(p: Column) -> Column:
    """Drop parenthesised notes and ZIP codes."""
    p = F.regexp_replace(p, r"\([^\n\r\u2028\u2029]*?\)", "")
    p = F.regexp_replace(p, r"(?<![A-Za-z0-9_])[0-9]{5}(?:-[0-9]{4})?(?![A-Za-z0-9_])", "")
    return trim_ws(p)


def state_of(cleaned: Column) -> Column:
    """Full state name found in a cleaned part, else NULL."""
    head = F.upper(F.regexp_extract(cleaned, rf"^([A-Za-z]{{2}}){RIGHT}", 1))
    named = F.lower(F.regexp_extract(cleaned, rf"(?i)^({_NAMES})", 1))
    return F.coalesce(
        _lookup(C.STATES, F.upper(cleaned)),
        F.when(cleaned.isin(list(C.STATES.values())), cleaned),
        _lookup(C.STATES, head),
        _lookup({s.lower(): s for s in C.STATES.values()}, named),
    )


def with_location(df: DataFrame, source: str, city: str, state: str, remote: str | None) -> DataFrame:
    """Add ``city``, ``state`` and (unless None) ``remote`` columns parsed from ``source``.

    Built in steps, so each intermediate array is computed once per row.
    """
    raw = F.coalesce(F.col(source), F.lit(""))
    mention = raw.rlike(whole_word(_REMOTE))
    bare = F.regexp_replace(
        trim_ws(raw),
        rf"(?i)\([^)]*(?<![A-Za-z0-9_])(?:remote|hybrid){RIGHT}[^)]*\)",
        "",
    )
    bare = F.regexp_replace(bare, whole_word(_REMOTE), "")
    edge = rf"[\-–—,;{WS[1:-1]}]"
    bare = trim_ws(F.regexp_replace(bare, rf"^{edge}+|{edge}+\z", ""))
    parts = F.transform(F.split(F.replace(bare, F.lit(";"), F.lit(",")), ","), trim_ws)
    parts = F.filter(
        parts, lambda p: (p != "") & ~F.lower(p).isin("united states", "us", "usa")
    )
    out = df.withColumn("__parts", F.transform(parts, clean_part))
    out = out.withColumn("__states", F.transform("__parts", state_of))
    out = out.withColumn(
        "__at",
        F.array_max(F.transform("__states", lambda s, i: F.when(s.isNotNull(), i))),
    )
    n = F.size("__parts")
    one = n == 1
    # Which part is not city: the last one with a state, else the last of several.
    drop = F.coalesce(F.col("__at"), F.when(~one, n - 1), F.lit(-1))
    rest = F.filter("__parts", lambda p, i: (i != F.col("__drop")) & (p != ""))
    out = out.withColumn("__drop", drop)
    out = out.withColumns(
        {
            city: F.array_join(rest, ", "),
            state: F.when(F.col("__at").isNotNull(), F.get("__states", F.col("__at")))
            .when(n > 1, F.get("__parts", n - 1))
            .otherwise(F.lit("")),
            **({remote: ~blank(raw) & mention} if remote else {}),
        }
    )
    return out.drop("__parts", "__states", "__at", "__drop")
