"""Run history: one summary row per run plus long-form facts.

Facts (``kind``, ``name``, ``n``, ``rank``) hold what varies in size: states,
categories, industries, unmatched industries and the top companies of a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.operators.dedup import with_seq

FUNNEL = ["total_ingested", "after_dedup", "after_filter", "after_quality_filter", "created", "updated",
          "expired", "deleted", "skipped", "errors"]


def funnel_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row with a count per stage; names missing from ``stages`` are zero."""
    parts = None
    for name, df in stages.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        parts = one if parts is None else parts.unionAll(one)
    return parts.groupBy().agg(
        *[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)).alias(s) for s in FUNNEL]
    )


def top_companies(df: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent companies; ties go to the one seen first."""
    return (
        with_seq(df)
        .groupBy("company")
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
        .orderBy(F.desc("n"), "first")
        .limit(k)
        .select("company", "n", "first")
    )


def unmatched_industries(df: DataFrame) -> DataFrame:
    """Distinct industry values without a canonical name."""
    return df.where("industry <> '' and matched_industry is null").select("industry").distinct()


def run_facts(listings: DataFrame, run_ts: Column, k: int = 10) -> DataFrame:
    """Facts of a run over all enriched listings."""

    def counted(kind: str, column: str) -> DataFrame:
        return (
            listings.where(F.coalesce(column, F.lit("")) != "")
            .groupBy(F.col(column).alias("name"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(kind).alias("kind"), "name", "n", F.lit(None).cast("int").alias("rank"))
        )

    unmatched = unmatched_industries(listings).select(
        F.lit("unmatched").alias("kind"), F.col("industry").alias("name"),
        F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("int").alias("rank"),
    )
    # ten rows: ranking them in one task is fine
    top = top_companies(listings, k).select(
        F.lit("top_company").alias("kind"), F.col("company").alias("name"), "n",
        F.row_number().over(W.orderBy(F.desc("n"), "first")).alias("rank"),
    )
    facts = (
        counted("state", "job_state")
        .unionByName(counted("category", "role_category"))
        .unionByName(counted("industry", "industry"))
        .unionByName(unmatched)
        .unionByName(top)
    )
    return facts.select(run_ts.alias("run_ts"), "kind", "name", "n", "rank")


def run_summary(
    funnel: DataFrame, listings: DataFrame, run_ts: Column, duration_ms: Column
) -> DataFrame:
    """The summary row of a run; no row when nothing passed the filter."""
    stats = listings.agg(
        F.count_distinct("company").alias("unique_companies"),
        F.count_distinct(F.nullif("job_state", F.lit(""))).alias("unique_states"),
        F.coalesce(F.sum(F.when(F.col("text_gate") == "generate", F.col("calls_needed"))), F.lit(0)).alias("ai_calls_made"),
        F.coalesce(F.sum(F.when(F.col("text_gate") == "generate", F.col("calls_skipped"))), F.lit(0)).alias("ai_calls_skipped"),
    )
    row = funnel.withColumn("stats", stats.select(F.struct(*stats.columns)).scalar())
    return row.where("after_filter > 0").select(
        run_ts.alias("run_ts"), duration_ms.alias("duration_ms"), *FUNNEL, "stats.*"
    )


def match_counters(df: DataFrame) -> DataFrame:
    """Text gate outcomes and calls of a run."""
    def gate(value: str) -> Column:
        return F.count(F.when(F.col("text_gate") == value, 1))

    generate = F.col("text_gate") == "generate"
    return df.agg(
        gate("low_quality").alias("skipped_low_quality"),
        gate("existing").alias("skipped_existing"),
        gate("generate").alias("to_generate"),
        F.coalesce(F.sum(F.when(generate, F.col("calls_needed"))), F.lit(0)).alias("calls_needed"),
        F.coalesce(F.sum(F.when(generate, F.col("calls_skipped"))), F.lit(0)).alias("calls_cached"),
    )


def append_history(
    history: DataFrame, record: DataFrame, run_ts: Column, months: int = C.HISTORY_MONTHS
) -> DataFrame:
    """Append a run and drop runs older than ``months``; works for summaries and facts."""
    return history.unionByName(record).where(F.col("run_ts") >= _months_ago(run_ts, months))


def _months_ago(ts: Column, months: int) -> Column:
    return ts - F.make_interval(months=F.lit(months))


def rolling_created(history: DataFrame, run_ts: Column) -> DataFrame:
    """Items created in the last 30, 60 and 90 days, and the number of runs."""
    def last(days: int) -> Column:
        recent = F.col("run_ts") >= run_ts - F.expr(f"interval {days} days")
        return F.coalesce(F.sum(F.when(recent, F.col("created"))), F.lit(0)).alias(f"created_{days}d")

    return history.agg(F.count(F.lit(1)).alias("total_runs"), last(30), last(60), last(90))


def week_start(ts: Column) -> Column:
    """The Sunday on or before the day."""
    d = F.to_date(ts)
    return F.date_sub(d, F.dayofweek(d) - 1)


def weekly_created(history: DataFrame, run_ts: Column | None = None, days: int | None = None) -> DataFrame:
    """Items created per week starting on Sunday, optionally for the last ``days`` only."""
    rows = history
    if days is not None:
        rows = rows.where(F.col("run_ts") >= run_ts - F.expr(f"interval {days} days"))
    return (
        rows.groupBy(week_start(F.col("run_ts")).alias("week"))
        .agg(F.sum("created").alias("created"))
        .withColumn("label", F.date_format("week", "MM-dd"))
    )


def states_covered(facts: DataFrame) -> DataFrame:
    return facts.where("kind = 'state'").select(F.col("name").alias("state")).distinct()


def top_companies_over_runs(facts: DataFrame, k: int = 10) -> DataFrame:
    """Companies by their summed per-run top-list counts; ties by first appearance."""
    return (
        facts.where("kind = 'top_company'")
        .groupBy(F.col("name").alias("company"))
        .agg(F.sum("n").alias("n"), F.min(F.struct("run_ts", "rank")).alias("first"))
        .orderBy(F.desc("n"), "first")
        .limit(k)
        .select("company", "n")
    )


def latest_runs(history: DataFrame, k: int = 1) -> DataFrame:
    return history.orderBy(F.desc("run_ts")).limit(k)


def dashboard_kpis(history: DataFrame, run_log: DataFrame, run_ts: Column) -> DataFrame:
    """Headline figures and a health colour.

    ``run_log`` lists job runs (``started_at``, ``conclusion``); the health of the
    last one decides before the errors of the last recorded run do.
    """
    last = F.max_by(
        F.struct("after_quality_filter", "unique_companies", "unique_states", "errors", "created", "updated",
                 "expired", "deleted"),
        "run_ts",
    )
    recent = F.col("run_ts") >= run_ts - F.expr("interval 30 days")
    kpis = history.agg(
        last.alias("last"), F.coalesce(F.sum(F.when(recent, F.col("created"))), F.lit(0)).alias("created_30d")
    )
    job = run_log.agg(F.max_by("conclusion", "started_at").alias("conclusion"), F.count(F.lit(1)).alias("runs"))
    both = kpis.withColumn("job", job.select(F.struct(*job.columns)).scalar()).select("*", "job.*")
    errors = F.coalesce("last.errors", F.lit(0))
    failed, none = F.col("conclusion") == "failure", F.col("runs") == 0
    return both.select(
        F.coalesce("last.after_quality_filter", F.lit(0)).alias("active_listings"),
        "created_30d",
        F.coalesce("last.unique_companies", F.lit(0)).alias("companies"),
        F.coalesce("last.unique_states", F.lit(0)).alias("states"),
        F.when(none | F.coalesce(failed, F.lit(False)), "red").when(errors > 0, "yellow").otherwise("green").alias("health"),
        F.when(none, "No runs")
        .when(failed, "Last run failed")
        .when(errors > 0, F.concat(errors.cast("string"), F.lit(" errors")))
        .otherwise("Healthy")
        .alias("health_text"),
    )


def issues_report(history: DataFrame, facts: DataFrame, last: int = 10) -> DataFrame:
    """What needs attention: unmatched industries and errors of recent runs, latest top companies."""
    recent = history.orderBy(F.desc("run_ts")).limit(last)
    newest = recent.agg(F.max("run_ts").alias("run_ts"))
    # at most ``last`` rows and one row
    unmatched = (
        facts.where("kind = 'unmatched'")
        .join(F.broadcast(recent.select("run_ts")), "run_ts", "left_semi")
        .select(F.lit("unmatched_industry").alias("issue"), "name", F.lit(None).cast("bigint").alias("n"))
        .distinct()
    )
    errors = recent.where("errors > 0").select(
        F.lit("run_errors").alias("issue"), F.date_format("run_ts", "yyyy-MM-dd").alias("name"),
        F.col("errors").cast("bigint").alias("n"),
    )
    top = (
        facts.where("kind = 'top_company'")
        .join(F.broadcast(newest), "run_ts", "left_semi")
        .select(F.lit("top_company").alias("issue"), "name", F.col("n").cast("bigint").alias("n"))
    )
    return unmatched.unionByName(errors).unionByName(top)


def history_table(history: DataFrame, limit: int | None = None) -> DataFrame:
    """Runs newest first with readable duration and call ratio."""
    rows = history.orderBy(F.desc("run_ts"))
    if limit:
        rows = rows.limit(limit)
    calls = F.col("ai_calls_made") + F.col("ai_calls_skipped")
    return rows.select(
        F.to_date("run_ts").alias("run_date"), "created", "updated", "expired",
        F.coalesce("deleted", F.lit(0)).alias("deleted"), "errors", "unique_companies",
        F.concat_ws(" / ", F.col("ai_calls_made").cast("string"), calls.cast("string")).alias("ai_calls"),
        F.concat(F.floor(F.col("duration_ms") / 1000 + 0.5).cast("string"), F.lit("s")).alias("duration"),
    )
