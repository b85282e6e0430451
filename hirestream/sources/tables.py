"""Readers and writers for firm lists, caches, landed payloads and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirestream import schemas as S
from hirestream.functions.keys import numbered
from hirestream.operators.filters import provider_subset


def scan_csv(spark: SparkSession, path: str, file: str | None = None, row: str | None = None) -> DataFrame:
    """Quoted CSV with embedded line breaks and doubled quotes; missing cells become ``""``.

    Windows line ends are read like plain ones, also inside quotes and when mixed.
    """
    df = spark.read.csv(
        path, header=True, multiLine=True, quote='"', escape='"', emptyValue="", lineSep="\n",
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
    )
    plain = [F.regexp_replace(F.coalesce(f"`{c}`", F.lit("")), "\r\n?", "\n").alias(c.strip()) for c in df.columns]
    if file and row:
        plain += [F.col("_metadata.file_path").alias(file), F.monotonically_increasing_id().alias(row)]
    return df.select(*plain)


def scan_firm_csv(spark: SparkSession, path: str) -> DataFrame:
    """A firm list under the column names of ``schemas.FIRM_CSV``.

    ``ord`` is the position in the order of the files and their rows.
    """
    # one task reads a file from its beginning, so the running number rises within a file
    df = scan_csv(spark, path, "__file", "__row")
    named = {h: c for h, c in zip(S.FIRM_CSV_HEADER, S.FIRM_CSV.fieldNames()[1:])}
    cols = [
        (F.col(f"`{h}`") if h in df.columns else F.lit("")).alias(c) for h, c in named.items()
    ]
    placed = numbered(df, [], ["__file", "__row"], "ord")
    return placed.select((F.col("ord") - 1).alias("ord"), *cols)


def scan_keyed_json(spark: SparkSession, path: str, value: str | T.DataType, key: str = "key") -> DataFrame:
    """A JSON object keyed by entity as rows ``(key, value...)``; unreadable content gives no rows."""
    text = spark.read.text(path, wholetext=True)
    vtype = value if isinstance(value, T.DataType) else T._parse_datatype_string(value)
    parsed = F.from_json("value", T.MapType(T.StringType(), vtype))
    rows = text.select(F.explode(parsed).alias(key, "__v"))
    if isinstance(vtype, T.StructType):
        return rows.select(key, "__v.*")
    return rows.withColumnRenamed("__v", "value")


def scan_board_cache(spark: SparkSession, path: str) -> DataFrame:
    raw = scan_keyed_json(
        spark, path, "provider string, boardToken string, detectedAt string", "firm_key"
    )
    return raw.select(
        "firm_key", "provider", F.col("boardToken").alias("board_token"),
        F.try_to_timestamp("detectedAt").alias("detected_at"),
    )


def scan_enrichment_cache(spark: SparkSession, path: str) -> DataFrame:
    raw = scan_keyed_json(
        spark, path,
        "employeeCount string, industry string, hq string, summary string, founded string, "
        "companyType string, fetchedAt string",
        "company_key",
    )
    return raw.select(
        "company_key", F.col("employeeCount").alias("employee_count"), "industry", "hq", "summary",
        "founded", F.col("companyType").alias("company_type"),
        F.try_to_timestamp("fetchedAt").alias("fetched_at"),
    )


def scan_firms(spark: SparkSession, path: str) -> DataFrame:
    """Firm master list from a JSON array; list position becomes ``firm_ord``."""
    item = (
        "name string, aliases array<string>, firmType string, industry string, enrRank int, "
        "specializations array<string>, hq string, hqState string, hqCity string, size string, "
        "website string, linkedin string"
    )
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.posexplode(F.from_json("value", f"array<struct<{_colon(item)}>>")).alias("i", "f"))
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("i").cast("bigint").alias("firm_ord"), "f.name", F.coalesce("f.aliases", none).alias("aliases"),
        F.col("f.firmType").alias("firm_type"), "f.industry", F.col("f.enrRank").alias("firm_rank"),
        F.coalesce("f.specializations", none).alias("specializations"), "f.hq",
        F.col("f.hqState").alias("hq_state"), F.col("f.hqCity").alias("hq_city"), "f.size", "f.website",
        "f.linkedin",
    )


def _colon(ddl: str) -> str:
    return ", ".join(":".join(part.split(" ", 1)) for part in ddl.split(", "))


def scan_site_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detected boards per firm, one row per detection; firms without one keep a NULL row."""
    text = spark.read.text(path, wholetext=True)
    schema = (
        "results map<string, struct<firmName:string, industry:string, "
        "atsDetected:array<struct<ats:string, url:string>>>>"
    )
    firms = text.select(F.posexplode(F.map_entries(F.from_json("value", schema)["results"])).alias("i", "e"))
    return firms.select(
        F.col("i").cast("bigint").alias("firm_ord"),
        F.col("e.key").alias("firm_key"),
        F.col("e.value.firmName").alias("firm_name"),
        F.posexplode_outer("e.value.atsDetected").alias("det_ord", "d"),
    ).select("firm_ord", "firm_key", "firm_name", F.col("det_ord").cast("bigint").alias("det_ord"), "d.ats", "d.url")


def scan_run_history(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Run summaries and facts from a JSON array of nested run records."""
    summary = ", ".join(
        f"{n}:bigint"
        for n in ("totalIngested", "afterDedup", "afterFilter", "afterQualityFilter", "created", "updated",
                  "expired", "deleted", "skipped", "errors")
    )
    schema = (
        f"array<struct<timestamp:string, durationMs:bigint, summary:struct<{summary}>, uniqueCompanies:bigint, "
        "uniqueStates:array<string>, listingsByCategory:map<string,bigint>, listingsByIndustry:map<string,bigint>, "
        "unmatchedIndustries:array<string>, aiCallsMade:bigint, aiCallsSkipped:bigint, "
        "topCompanies:array<struct<name:string, count:bigint>>>>"
    )
    runs = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", schema)).alias("r"))
    ts = F.try_to_timestamp("r.timestamp").alias("run_ts")
    r = lambda f: F.col(f"r.{f}")
    s = lambda f: F.col(f"r.summary.{f}")
    summaries = runs.select(
        ts, r("durationMs").alias("duration_ms"), s("totalIngested").alias("total_ingested"),
        s("afterDedup").alias("after_dedup"), s("afterFilter").alias("after_filter"),
        s("afterQualityFilter").alias("after_quality_filter"), s("created").alias("created"),
        s("updated").alias("updated"), s("expired").alias("expired"),
        F.coalesce(s("deleted"), F.lit(0)).alias("deleted"), s("skipped").alias("skipped"),
        s("errors").alias("errors"), r("uniqueCompanies").alias("unique_companies"),
        F.size("r.uniqueStates").cast("bigint").alias("unique_states"),
        r("aiCallsMade").alias("ai_calls_made"), r("aiCallsSkipped").alias("ai_calls_skipped"),
    )

    def fact(kind: str, name: Column, n: Column, rank: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.alias("name"), n.cast("bigint").alias("n"), rank.cast("int").alias("rank")
        )

    null = F.lit(None)
    facts = F.concat(
        F.transform(r("uniqueStates"), lambda x: fact("state", x, null, null)),
        F.transform(F.map_entries(r("listingsByCategory")), lambda e: fact("category", e.key, e.value, null)),
        F.transform(F.map_entries(r("listingsByIndustry")), lambda e: fact("industry", e.key, e.value, null)),
        F.transform(r("unmatchedIndustries"), lambda x: fact("unmatched", x, null, null)),
        F.transform(r("topCompanies"), lambda c, i: fact("top_company", c["name"], c["count"], i + 1)),
    )
    return summaries, runs.select(ts, F.inline(facts))


def scan_raw_payloads(spark: SparkSession, path: str, providers: str | None = None) -> DataFrame:
    """Landed feed pages; the table is partitioned by ``source``, so other feeds are not read."""
    return provider_subset(spark.read.schema(S.RAW_PAYLOAD).parquet(path), providers)


def scan_published_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
