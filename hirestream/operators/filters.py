"""Row filters and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import computed
from hirestream.functions.text import any_contains, blank, count_contains, first_case, quoted, whole_word


def role_filter(
    df: DataFrame,
    titles: dict[str, list[str]] = C.ROLE_TITLE_KEYWORDS,
    descriptions: list[str] = C.ROLE_DESCRIPTION_KEYWORDS,
) -> DataFrame:
    """Keep rows with a role; adds ``role_category``.

    Title keywords decide in category order; otherwise two different description
    keywords make the row ``operations``.
    """
    lowered = df.withColumns({"__t": F.lower("title"), "__d": F.lower("description")})
    role = role_of("__t", "__d", titles, descriptions)
    return computed(lowered, {"role_category": role}).where("role_category is not null").drop("__t", "__d")


def role_of(
    title: str,
    description: str,
    titles: dict[str, list[str]] = C.ROLE_TITLE_KEYWORDS,
    descriptions: list[str] = C.ROLE_DESCRIPTION_KEYWORDS,
) -> Column:
    """The role of a row, from lower-cased columns; NULL if it has none."""
    cases = [(any_contains(title, words), quoted(category)) for category, words in titles.items()]
    cases.append((f"{count_contains(description, descriptions)} >= 2", "'operations'"))
    return F.expr(first_case(cases))


def has_signals(lowered: str, signals: dict[str, list[str]] = C.INDUSTRY_SIGNALS) -> Column:
    """Two different signals of one industry in the lower-cased text column."""
    return F.expr(" or ".join(f"{count_contains(lowered, words)} >= 2" for words in signals.values()))


def industry_signal_filter(df: DataFrame, signals: dict[str, list[str]] = C.INDUSTRY_SIGNALS) -> DataFrame:
    lowered = df.withColumn("__d", F.lower(F.coalesce("description", F.lit(""))))
    return lowered.where(has_signals("__d", signals)).drop("__d")


def publish_status(df: DataFrame) -> DataFrame:
    s = F.col("quality_score")
    return df.withColumns(
        {
            "is_featured": s >= C.FEATURED_SCORE,
            "publish_status": F.when(s >= C.FEATURED_SCORE, "FEATURED")
            .when(s >= C.PUBLISH_SCORE, "PUBLISH")
            .otherwise("SKIP"),
        }
    )


def publish_filter(df: DataFrame, minimum: int = C.PUBLISH_SCORE) -> DataFrame:
    return publish_status(df.where(F.col("quality_score") >= minimum))


def text_gate(df: DataFrame, threshold: int = C.TEXT_SCORE) -> DataFrame:
    """Why a row gets generated text or not; needs ``pre_score`` and ``already_published``."""
    return df.withColumn(
        "text_gate",
        F.when(F.col("pre_score") < threshold, "low_quality")
        .when(F.col("already_published"), "existing")
        .otherwise("generate"),
    )


def provider_subset(df: DataFrame, names: str | None, column: str = "source") -> DataFrame:
    """Rows of the enabled feeds.

    ``names`` is a comma list.  Unknown names are ignored; a list without any
    known name selects nothing; no list selects every known feed.  On a table
    partitioned by ``source`` this prunes partitions.
    """
    given = [n.strip().lower() for n in (names or "").split(",") if n.strip()]
    enabled = [n for n in given if n in C.PROVIDERS] if given else C.PROVIDERS
    return df.where(F.col(column).isin(enabled) if enabled else F.lit(False))


def ttl_valid(df: DataFrame, column: str, days: int, run_ts: Column) -> DataFrame:
    """Rows younger than ``days`` at ``run_ts``."""
    return df.where(F.col(column) > run_ts - F.expr(f"interval {days} days"))


def drop_incomplete(df: DataFrame, id_column: str, title_column: str = "title") -> DataFrame:
    return df.where(~blank(F.col(id_column).cast("string")) & ~blank(F.col(title_column)))


# fixed values: words that mark a log line
LOG_ERROR = ["error", "fail", "exception"]
LOG_WARN = ["warn", "warning"]


def log_filter(lines: DataFrame, level: str = "all", column: str = "value") -> DataFrame:
    """Classify log lines as error, warn or info and keep one level."""
    line = F.col(column)
    is_error, is_warn = line.rlike(whole_word(LOG_ERROR)), line.rlike(whole_word(LOG_WARN))
    out = lines.withColumn(
        "line_class", F.when(is_error, "error").when(is_warn, "warn").otherwise("info")
    )
    return out.where({"error": is_error, "warn": is_warn}.get(level, F.lit(True)))


def split_row_errors(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected rows (with ``row_error``); a bad row never fails the job."""
    chain = F
    for name, bad in checks.items():
        chain = chain.when(F.coalesce(bad, F.lit(True)), name)
    marked = df.withColumn("row_error", chain)
    return marked.where("row_error is null").drop("row_error"), marked.where("row_error is not null")
