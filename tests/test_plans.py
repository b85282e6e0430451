"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream import session
from hirestream.operators import dedup, firm_match, hub, lookups, publish


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def listings(spark):
    return spark.range(100).select(
        F.col("id").alias("ord"), F.lit("t").alias("title"), F.concat(F.lit("c"), F.col("id") % 7).alias("company"), F.lit("l").alias("location"),
        F.lit("d").alias("description"), F.concat(F.lit("http://x/"), "id").alias("source_url"), F.lit("s").alias("source"),
        F.lit(None).cast("double").alias("salary_min"), F.lit(None).cast("double").alias("salary_max"), F.lit("").alias("contract_type"),
        F.lit("").alias("contract_time"), F.concat(F.lit("r"), F.col("id") % 3).alias("role_category"), F.lit("2024").alias("date_posted"))


def firms(spark):
    return spark.range(20).select(
        F.col("id").alias("firm_ord"), F.concat(F.lit("some firm "), "id").alias("name"), F.array().cast("array<string>").alias("aliases"))


def test_no_cross_product(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = listings(spark)
        companies = rows.select("company").distinct()
        items = rows.select(F.col("ord").cast("string").alias("id"), F.col("ord").alias("item_ord"), "source_url", "company", "title", "location")
        for df in (
            dedup.fingerprint_dedup(rows), dedup.url_dedup(rows), firm_match.company_matches(companies, firms(spark)),
            lookups.rank_lookup(rows), publish.match_published(rows, items),
        ):
            p = plan(df)
            assert "CartesianProduct" not in p and "NestedLoop" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_has_no_window_over_wide_rows(spark):
    p = plan(dedup.url_dedup(listings(spark)))
    assert "Window" not in p
    # the fingerprint window runs over group rows only
    w = plan(dedup.fingerprint_dedup(listings(spark)))
    assert w.count("+- Window ") + w.count("Window [") <= 2


def test_related_limits_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(hub.related_listings(listings(spark)))


def test_filters_reach_the_scan(spark, tmp_path):
    listings(spark).write.parquet(str(tmp_path / "l"))
    df = spark.read.parquet(str(tmp_path / "l"))
    p = plan(hub.category_page(df, "role_category", "r1").select("ord"))
    assert "EqualTo(role_category,r1)" in p and "ReadSchema: struct<ord:bigint,role_category:string>" in p


def test_item_places(spark):
    from hirestream.sources.feeds_json import item_ord

    at = lambda page, item: spark.range(1).select(item_ord("lever", F.lit(page).cast("bigint"), F.lit(item)).alias("o")).first().o
    assert at(3, (1 << 20) - 1) + 1 == at(4, 0)
    assert at((1 << 38) - 1, 0) >> 58 == C.PROVIDERS.index("lever")
    for page, item in ((0, 1 << 20), (1 << 38, 0)):
        with pytest.raises(Exception, match="no place for item"):
            at(page, item)


def test_a_run_stages_no_texts_before_the_gate(spark, monkeypatch):
    from checks.queries import Ctx, run_ts
    from hirestream.plans import listings as plan_

    c, staged = Ctx(spark, "/root/testdata/sf0.001"), {}
    rows, dims = c.view("listings"), c.dims()
    real = plan_.stage

    def watch(df, name):
        staged[name] = df.columns
        return real(df, name)

    monkeypatch.setattr(plan_, "stage", watch)
    before = len(session.STAGED)
    raw = rows.withColumn("row_error", F.when(F.col("ord") % 10 == 3, "bad_date"))
    run = plan_.daily_run(raw, dims, run_ts())
    funnel = run.funnel.first()
    assert funnel.errors == raw.where("row_error is not null").count() > 0
    assert funnel.total_ingested + funnel.errors == rows.count()
    assert [n for n, cols in staged.items() if "description" in cols] == ["enriched"]
    session.remove_stages(spark, before)
    assert len(session.STAGED) == before


def test_failed_rows_of_landed_pages_are_put_aside(spark):
    from hirestream.plans import landed

    assert list(landed.FEEDS) == C.PROVIDERS
    body = '{"jobs": [{"title": "A", "published_on": "soon", "url": "u1"}, {"title": "B", "published_on": "2024-01-05", "url": "u2"}]}'
    pages = spark.createDataFrame(
        [("workable", "b", "Acme", 1, "http://x", body, 4), ("workable", "b", "Acme", 1, "http://x", "no json", 5), ("lever", "b", "Acme", 1, "http://x", "[]", 6)],
        "source string, board_token string, company string, page_no int, url string, body string, ord long").withColumn("fetched_at", F.current_timestamp())
    rows = landed.listings_from_pages(pages, F.current_timestamp(), ["lever", "workable", "nobody"])
    assert [r.title for r in rows.where("row_error is null").collect()] == ["B"]
    assert [(r.source_url, r.row_error) for r in landed.failed_rows(rows).collect()] == [("u1", "bad_date")]


def test_posting_is_walked_once(spark):
    from hirestream.sources import feeds_html

    pages = spark.range(5).select(
        F.col("id").alias("ord"), F.lit("c").alias("company"), F.lit("https://example.com/j").alias("url"), F.lit("<html></html>").alias("body"))
    assert plan(feeds_html.icims(pages, F.current_timestamp())).split("== Physical Plan ==")[-1].count("ArrowEvalPython") == 1


def test_embedded_value_is_cut_once(spark):
    from hirestream.sources.pages import embedded_json

    pages = spark.range(5).select(F.col("id").alias("ord"), F.concat(F.lit("window.pageData = {"), "id", F.lit("}")).alias("html"))
    cut = embedded_json(pages, r"window\.pageData", "{", "block").where("length(block) > 2")
    assert plan(cut).split("== Physical Plan ==")[-1].count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name, columns", [
    ("pre_score", {"ord", "pre_score"}), ("quality_score", {"ord", "quality_score"}), ("publish_filter", {"ord", "quality_score"}),
    ("run_summary", {"company", "job_state", "text_gate", "calls_needed", "calls_skipped"}),
])
def test_a_query_writes_only_the_columns_it_reads(spark, tmp_path, name, columns):
    """the enriched listings went out whole, texts included, for a few narrow columns."""
    from checks.queries import QUERIES
    from hirestream.session import STAGED

    docs = [(i, f"Resource planning with Revit and AutoCAD in architecture, text {i}. " * 4) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    QUERIES[name](spark, str(tmp_path)).collect()
    written = [p for p in STAGED if "/enriched-" in p][-1]
    assert set(spark.read.parquet(written).columns) == columns
