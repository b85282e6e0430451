"""Column expressions for names, words and HTML text.

Word boundaries are ASCII everywhere (look-around on ``[A-Za-z0-9_]``) and white
space includes the Unicode spaces, because the results are defined that way;
Java's own ``\\b`` and ``\\s`` differ on accented letters and on NBSP.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C

WS = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
#: The characters of ``WS``.
WS_CHARS = "\t\n\x0B\f\r \u00A0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202F\u205F\u3000\uFEFF"
LEFT = r"(?<![A-Za-z0-9_])"
RIGHT = r"(?![A-Za-z0-9_])"


def trim_ws(c: Column) -> Column:
    """Strip all white space, not only blanks: looks at both ends only, whatever the length of the text."""
    return F.btrim(c, F.lit(WS_CHARS))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WS}+", " ")


def blank(c: Column) -> Column:
    """True for NULL, empty and white-space-only strings."""
    return c.isNull() | (trim_ws(c) == "")


def truthy(c: Column) -> Column:
    """Non-NULL and not the empty string."""
    return F.coalesce(c, F.lit("")) != ""


def first_truthy(*cols: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def whole_word(words: list[str]) -> str:
    """A case-insensitive pattern for any of ``words`` (regex sources) as whole words."""
    return rf"(?i){LEFT}(?:{'|'.join(words)}){RIGHT}"


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The word lists are long, so their conditions are written as SQL text over a named
# column: one expression to parse instead of hundreds of Column objects.


def any_contains(column: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({column}, {quoted(w)})" for w in words) + ")"


def count_contains(column: str, words: list[str]) -> str:
    """How many different ``words`` occur in the column."""
    return "(" + " + ".join(f"cast(contains({column}, {quoted(w)}) as int)" for w in words) + ")"


def first_case(cases: list[tuple[str, str]], default: str = "null") -> str:
    """``case when`` over (condition, value) pairs of SQL text."""
    return "case " + " ".join(f"when {c} then {v}" for c, v in cases) + f" else {default} end"


# --- keys --------------------------------------------------------------------


def norm_key(c: Column) -> Column:
    """Lower case, ASCII letters, digits and single blanks only."""
    kept = F.regexp_replace(F.lower(c), "[^a-z0-9 ]", "")
    return F.trim(F.regexp_replace(kept, " +", " "))


def fingerprint(company: Column, title: Column, location: Column) -> Column:
    return F.concat_ws(
        "|", norm_key(company), norm_key(title), norm_key(F.coalesce(location, F.lit("")))
    )


def _suffix_pattern(suffixes: list[str]) -> str:
    # A suffix that starts with a symbol has its left boundary between a word
    # character and the symbol, the others between a non-word character and a letter.
    words = "|".join(s for s in suffixes if s[0].isalpha())
    alts = [f"{LEFT}(?:{words}){RIGHT}"]
    alts += [f"(?<=[A-Za-z0-9_]){re.escape(s)}{RIGHT}" for s in suffixes if not s[0].isalpha()]
    return "|".join(alts)


def norm_firm(c: Column) -> Column:
    """Firm name for matching: punctuation out first, then legal suffixes."""
    bare = F.regexp_replace(F.lower(c), "[,.]", "")
    return trim_ws(squeeze(F.regexp_replace(bare, _suffix_pattern(C.SUFFIXES_FIRM), "")))


def norm_company(c: Column, suffixes: list[str] | None = None) -> Column:
    """Company name for rank and attribute lookups: punctuation and suffixes in one pass."""
    pattern = "[,.]|" + _suffix_pattern(suffixes or C.SUFFIXES_COMPANY)
    return trim_ws(squeeze(F.regexp_replace(F.lower(c), pattern, "")))


def content_key(company: Column, title: Column, description: Column) -> Column:
    return F.md5(F.concat(company, F.lit("|"), title, F.lit("|"), F.substring(description, 1, 500)))


# --- HTML --------------------------------------------------------------------

# fixed values: block tags that become a line break, entities in decoding order
BLOCKS_BASIC = "p|div|li|h[1-6]|tr"
BLOCKS_LISTS = BLOCKS_BASIC + "|ul|ol"
BLOCKS_FEED = BLOCKS_LISTS + "|span"
BLOCKS_PAGE = BLOCKS_FEED + "|table|tbody|thead|section|article"
ENTITIES_AMP_FIRST = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                      ("&#39;", "'"), ("&nbsp;", " ")]
ENTITIES_FEED = [("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&#x27;", "'"), ("&nbsp;", " ")]
ENTITIES_PAGE = [("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&#x27;", "'"), ("&#x2F;", "/"), ("&nbsp;", " ")]


def decode_entities(c: Column, entities: list[tuple[str, str]] = ENTITIES_PAGE) -> Column:
    for entity, char in entities:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_tags(c: Column, blocks: str) -> Column:
    c = F.regexp_replace(c, rf"(?i)<br{WS}*/?>", "\n")
    c = F.regexp_replace(c, rf"(?i)</?(?:{blocks})[^>]*>", "\n")
    return F.regexp_replace(c, "<[^>]+>", "")


def _tidy(c: Column) -> Column:
    return trim_ws(F.regexp_replace(c, "\n{3,}", "\n\n"))


def html_text(c: Column, variant: str = "A") -> Column:
    """HTML to plain text.

    A  strips tags, then decodes (``&amp;`` first, so double escapes unfold)
    B  decodes, then strips with the widest block-tag list
    C  decodes, then strips with list tags as blocks
    D  as C with spans as blocks and no ``&#x2F;``
    """
    if variant == "A":
        return _tidy(decode_entities(strip_tags(c, BLOCKS_BASIC), ENTITIES_AMP_FIRST))
    blocks, entities = {
        "B": (BLOCKS_PAGE, ENTITIES_PAGE),
        "C": (BLOCKS_LISTS, ENTITIES_PAGE),
        "D": (BLOCKS_FEED, ENTITIES_FEED),
    }[variant]
    return _tidy(strip_tags(decode_entities(c, entities), blocks))


def page_text(c: Column) -> Column:
    """Text of markup whose entities are already decoded."""
    return _tidy(strip_tags(c, BLOCKS_PAGE))


def strip_cdata(c: Column) -> Column:
    """What the first CDATA section holds; the value itself where there is none."""
    begin, end = "<![CDATA[", "]]>"
    # by bytes: counting the characters of a long text costs more than finding the marks
    before = F.octet_length(F.substring_index(c, begin, 1))
    rest = F.substring(c.cast("binary"), before + len(begin) + 1, F.octet_length(c)).cast("string")
    return F.when(c.contains(begin) & rest.contains(end), F.substring_index(rest, end, 1)).otherwise(c)


# --- titles, tools, industries ------------------------------------------------


def experience_level(title: Column) -> Column:
    chain = F
    for level, words in C.LEVELS:
        chain = chain.when(title.rlike(whole_word(words)), F.lit(level))
    return chain.otherwise(F.lit(""))


def tools_array(description: str, lowered: str, tools: list[str]) -> Column:
    """Tools found as whole words, in list order.

    ``lowered`` names the lower-cased description: a byte search on it decides
    nearly every tool before the regular expression has to run.
    """
    hits = ", ".join(
        f"if(contains({lowered}, {quoted(t.lower())}) and "
        f"rlike({description}, {quoted(whole_word([re.escape(t)]))}), {quoted(t)}, null)"
        for t in tools
    )
    return F.expr(f"array_compact(array({hits}))")


def tool_count(tools_text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(tools_text, F.lit("")), ","), lambda t: t != ""))


def ordered_aliases(aliases: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(alias, canonical) pairs, longest alias first, otherwise in list order."""
    pairs = [
        (alias.lower().strip(), canonical)
        for canonical, names in aliases.items()
        for alias in [*names, canonical]
    ]
    return sorted(pairs, key=lambda p: -len(p[0]))


def with_industry(
    df: DataFrame,
    source: str,
    out: str,
    aliases: dict[str, list[str]] = C.INDUSTRY_ALIASES,
    matched: str | None = None,
) -> DataFrame:
    """Add the canonical industry of ``source``.

    Exact alias first, then the longest alias that contains or is contained in
    the value, else the trimmed value itself.  ``matched`` names an optional
    column that stays NULL when no alias applied.
    """
    pairs = ordered_aliases(aliases)
    exact = dict(pairs)
    trimmed, key, hit = F.col("__trimmed"), F.col("__key"), F.col("__hit")
    known = F.expr(f"map({', '.join(quoted(x) for kv in exact.items() for x in kv)})")
    # a constant array: the alias list as data keeps the generated code small
    rows = ", ".join(f"named_struct('alias', {quoted(a)}, 'name', {quoted(c)})" for a, c in pairs)
    table = F.expr(f"array({rows})")
    near = F.filter(table, lambda p: key.contains(p["alias"]) | F.contains(p["alias"], key))
    lookup = F.coalesce(F.try_element_at(known, key), F.get(near, F.lit(0))["name"])
    df = df.withColumn("__trimmed", trim_ws(F.coalesce(F.col(source), F.lit(""))))
    df = df.withColumn("__key", F.lower(trimmed)).withColumn("__hit", F.when(key != "", lookup))
    df = df.withColumn(out, F.coalesce(hit, trimmed))
    if matched:
        df = df.withColumn(matched, hit)
    return df.drop("__trimmed", "__key", "__hit")


def employment_type(text: Column, *, internships: bool = False, lever: bool = False) -> Column:
    """Employment text to a struct ``(contract_type, contract_time)``.

    ``internships`` also maps internships (permanent, part time); ``lever`` is
    the stricter rule where part-time alone does not imply a permanent contract.
    """
    t = F.lower(F.coalesce(text, F.lit("")))
    full, part = t.contains("full"), t.contains("part")
    permanent = full | t.contains("permanent")
    if not lever:
        permanent = permanent | part
    if internships:
        permanent, part = permanent | t.contains("intern"), part | t.contains("intern")
    return F.struct(
        F.when(t.contains("contract"), "contract").when(permanent, "permanent").alias("contract_type"),
        F.when(full, "full_time").when(part, "part_time").alias("contract_time"),
    )


def employee_band(count: Column) -> Column:
    chain = F.when(F.coalesce(count, F.lit(0)) == 0, "")
    for bound, label in C.EMPLOYEE_BANDS:
        chain = chain.when(count < bound, label)
    return chain.otherwise(C.EMPLOYEE_BAND_TOP)


def occupation_code(title: str, role: str) -> Column:
    """Occupation of a lower-cased title (column names)."""
    cases = [
        (f"contains({title}, 'architect') and not contains({title}, 'data architect')", quoted(C.OCCUPATION_ARCHITECT)),
        (any_contains(title, ["civil", "structural", "engineer"]), quoted(C.OCCUPATION_ENGINEER)),
    ]
    cases += [(f"{role} = {quoted(r)}", quoted(code)) for r, code in C.OCCUPATION_BY_ROLE.items()]
    return F.expr(first_case(cases, quoted(C.OCCUPATION_DEFAULT)))


def metro_area(location: str) -> Column:
    """Metro of a lower-cased location, first pattern hit; else NULL."""
    return F.expr(first_case([(any_contains(location, words), quoted(m)) for m, words in C.METRO_PATTERNS]))


def firm_type(name: str) -> Column:
    """Firm type from a lower-cased name."""
    cases = [(any_contains(name, words), quoted(kind)) for kind, words in C.FIRM_TYPES]
    return F.expr(first_case(cases, quoted(C.FIRM_TYPE_DEFAULT)))


def headquarters(city: Column, state: Column, country: Column) -> Column:
    foreign = F.when(country != "United States", country)
    joined = F.concat_ws(", ", *[F.nullif(c, F.lit("")) for c in (city, state, foreign)])
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("Unknown"))


def slug_base(title: Column, company: Column, location: Column, limit: int = 80) -> Column:
    """URL slug ``title-at-company-location``; long slugs are cut at a word if possible."""
    raw = F.lower(F.concat(title, F.lit(" at "), company, F.lit(" "), location))
    s = F.replace(raw, F.lit("&"), F.lit("and"))
    s = F.regexp_replace(s, rf"[^a-z0-9\-{WS[1:-1]}]", "")
    s = F.regexp_replace(F.regexp_replace(s, rf"{WS}+", "-"), "-+", "-")
    s = F.regexp_replace(s, r"^-|-\z", "")
    head = F.substring(s, 1, limit)
    last = limit - F.locate("-", F.reverse(head))  # zero-based; ``limit`` when there is none
    cut = F.when((last < limit) & (last > limit * 0.6), F.left(head, last)).otherwise(head)
    return F.when(F.length(s) > limit, cut).otherwise(s)


# --- dates -------------------------------------------------------------------


def parse_date(c: Column) -> Column:
    """ISO or RFC 822 date text to a timestamp, NULL when it is neither."""
    s = trim_ws(c)
    day_first = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        s.try_cast("timestamp"),
        F.try_to_timestamp(day_first, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(day_first, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(day_first, F.lit("d MMM yyyy")),
    )


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def relative_date(text: Column, run_ts: Column) -> Column:
    """``Posted 3 Days Ago`` style text to a timestamp relative to ``run_ts``."""
    t = F.lower(F.coalesce(text, F.lit("")))

    def back(unit: str, seconds: int) -> tuple[Column, Column]:
        n = F.regexp_extract(t, rf"(\d+){WS}+{unit}", 1)
        return n != "", F.timestamp_micros(
            F.unix_micros(run_ts) - n.try_cast("bigint") * F.lit(seconds * 1_000_000)
        )

    chain = F.when(t.contains("today"), run_ts)
    chain = chain.when(t.contains("yesterday"), run_ts - F.expr("interval 1 day"))
    for unit, seconds in (("day", 86400), ("week", 7 * 86400), ("hour", 3600)):
        cond, value = back(unit, seconds)
        chain = chain.when(cond, value)
    return chain.otherwise(run_ts)
