"""Files, configuration and feeds."""

import json

import pytest
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream import schemas as S
from hirestream.operators.filters import provider_subset, split_row_errors
from hirestream.sources import config_files, discovery, feeds_html, feeds_json, pages, tables
from hirestream.streaming import incremental
from hirestream.streaming.incremental import ingest_available, ingest_distinct


def run_ts():
    return F.to_timestamp(F.lit("2024-01-31"))


def payload(spark, rows):
    """(source, board, company, url, body, ord)"""
    return spark.createDataFrame(
        [(s, b, c, 1, None, u, body, o) for s, b, c, u, body, o in rows], S.RAW_PAYLOAD)


def test_csv(spark, tmp_path):
    p = tmp_path / "firms.csv"
    p.write_text('Account Name,Industry,Website,LinkedIn,Country,State,City\r\n"A ""x"",\n Inc", Design ,w\nB,,,,"United States"\n')
    rows = tables.scan_firm_csv(spark, str(p)).orderBy("ord").collect()
    assert [(r.name, r.industry, r.website, r.country, r.city) for r in rows] == [
        ('A "x",\n Inc', "Design", "w", "", ""), ("B", "", "", "United States", "")]
    p.write_bytes(b'Account Name,City\r\n"A\r\nB","x"\r\nC, y \r\n')
    rows = tables.scan_firm_csv(spark, str(p)).orderBy("ord").collect()
    assert [(r.name, r.city) for r in rows] == [("A\nB", "x"), ("C", "y")]


def test_keyed_json(spark, tmp_path):
    p = tmp_path / "cache.json"
    p.write_text(json.dumps({"acme": {"provider": "lever", "boardToken": "t", "detectedAt": "2024-01-01T00:00:00Z"}}, indent=2))
    r = tables.scan_board_cache(spark, str(p)).first()
    assert (r.firm_key, r.provider, r.board_token, r.detected_at.year) == ("acme", "lever", "t", 2024)
    p.write_text("{broken")
    assert tables.scan_board_cache(spark, str(p)).count() == 0


def test_firms_detections_history(spark, tmp_path):
    f = tmp_path / "firms.json"
    f.write_text(json.dumps([{"name": "A", "aliases": ["B"], "firmType": "T", "enrRank": 3, "hqState": "Utah"}, {"name": "C"}]))
    rows = tables.scan_firms(spark, str(f)).orderBy("firm_ord").collect()
    assert [(r.firm_ord, r.name, r.aliases, r.firm_rank, r.hq_state) for r in rows] == [(0, "A", ["B"], 3, "Utah"), (1, "C", [], None, None)]
    d = tmp_path / "sites.json"
    d.write_text(json.dumps({"results": {"k1": {"firmName": "K", "atsDetected": [{"ats": "Ashby", "url": "u"}, {"ats": "X", "url": "v"}]}, "k2": {}}}))
    got = tables.scan_site_detections(spark, str(d)).orderBy("firm_ord", "det_ord").collect()
    assert [(r.firm_key, r.ats, r.url) for r in got] == [("k1", "Ashby", "u"), ("k1", "X", "v"), ("k2", None, None)]
    h = tmp_path / "history.json"
    h.write_text(json.dumps([{
        "timestamp": "2024-01-30T00:00:00Z", "durationMs": 5, "summary": {"created": 7, "errors": 1}, "uniqueCompanies": 2,
        "uniqueStates": ["Utah"], "listingsByCategory": {"operations": 4}, "listingsByIndustry": {}, "unmatchedIndustries": ["Z"],
        "aiCallsMade": 1, "aiCallsSkipped": 0, "topCompanies": [{"name": "A", "count": 3}]}]))
    summary, facts = tables.scan_run_history(spark, str(h))
    s = summary.first()
    assert (s.created, s.deleted, s.unique_states) == (7, 0, 1)
    assert sorted((r.kind, r.name, r.n, r["rank"]) for r in facts.collect()) == [
        ("category", "operations", 4, None), ("state", "Utah", None, None), ("top_company", "A", 3, 1), ("unmatched", "Z", None, None)]


def test_config_files(spark, tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(json.dumps(value))
        return str(tmp_path / name)

    missing = str(tmp_path / "nothing.json")
    assert config_files.tool_names(spark, put("t.json", {"a": ["X", "Y"], "b": ["X", "Z"]})) == ["X", "Y", "Z"]
    titles, words = config_files.role_keywords(spark, put("r.json", {"titleKeywords": {"operations": ["coo"]}, "descriptionKeywords": ["pmo"]}))
    assert titles["operations"] == ["coo"] and titles["project-management"] == [] and words == ["pmo"]
    assert config_files.industry_aliases(spark, put("i.json", {"canonical": ["A"], "aliases": {"A": ["b"]}})) == {"A": ["b"]}
    assert config_files.industry_signals(spark, missing) == C.INDUSTRY_SIGNALS
    assert config_files.tool_names(spark, missing) == []
    assert config_files.ranking(spark, put("k.json", [{"rank": 2, "firm": "F"}])) == [(2, "F")]
    w = config_files.scan_wages(spark, put("w.json", [{"soc": "1", "title": "t", "national": {"p25": 1, "median": 2, "p75": 3}, "metro": {"Rome": {"p25": 4, "median": 5, "p75": 6}}}]))
    assert sorted(tuple(r) for r in w.collect()) == [("1", "", 1.0, 3.0), ("1", "Rome", 4.0, 6.0)]
    assert config_files.config_table(spark, {"a": ["x", "y"]}, "kind", "word").count() == 2


def test_provider_subset(spark):
    df = spark.createDataFrame([(p,) for p in [*C.PROVIDERS, "other"]], "source string")
    assert provider_subset(df, None).count() == 15
    assert provider_subset(df, "nosuch").count() == 0
    assert [r.source for r in provider_subset(df, " LEVER ,x").collect()] == ["lever"]


def test_partition_pruning(spark, tmp_path):
    rows = payload(spark, [(p, "b", "c", "u", "x", i) for i, p in enumerate(C.PROVIDERS)])
    tables.sink_table(rows, str(tmp_path / "t"), ["source"])
    df = tables.scan_raw_payloads(spark, str(tmp_path / "t"), "lever,zoho")
    assert sorted(r.source for r in df.collect()) == ["lever", "zoho"]
    assert "PartitionFilters: [source" in df._jdf.queryExecution().executedPlan().toString()


def test_row_errors(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "i int, t string")
    good, bad = split_row_errors(df, {"no_title": F.col("t") == ""})
    assert [r.i for r in good.collect()] == [1]
    assert sorted((r.i, r.row_error) for r in bad.collect()) == [(2, "no_title"), (3, "no_title")]


def test_broken_json_gives_no_rows(spark):
    p = payload(spark, [("greenhouse", "b", "c", "u", "{oops", 0), ("greenhouse", "b", "c", "u", '{"jobs":[{"title":"T"}]}', 1)])
    rows = feeds_json.greenhouse(p).collect()
    assert [(r.title, r.description, r.location) for r in rows] == [("T", "", "")]


def test_feed_links(spark):
    html = """<a href="/acme/job/o1">x</a><a href='/other/job/o2'>y</a><a href="/acme/job/o1">z</a><a href='https://c.icims.com/jobs/7/t/job?a=1&amp;b=2'>w</a>"""
    df = spark.createDataFrame([(1, "https://jobs.jobvite.com/acme/jobs", html)], "page_id long, url string, html string")
    assert [r.link for r in pages.extract_links(df, pages.link_pattern("jobvite", "acme")).collect()] == ["https://jobs.jobvite.com/acme/job/o1"]
    assert [r.link for r in pages.extract_links(df, pages.link_pattern("icims_detail_absolute")).collect()] == ["https://c.icims.com/jobs/7/t/job?a=1&b=2"]


def test_embedded_json(spark):
    html = 'x {"a":1} window.pageData = {"s":"} \\" {","n":[{"é":1}]}; more {'
    df = spark.createDataFrame([(1, html), (2, "none {}"), (3, "window.pageData = {broken")], "page_id long, html string")
    got = {r.page_id: r.block for r in pages.embedded_json(df, r"window\.pageData", "{", "block").collect()}
    assert got == {1: '{"s":"} \\" {","n":[{"é":1}]}', 2: None, 3: None}


def test_paylocity_falls_back_to_posting(spark):
    body = '<script type="application/ld+json">{"@type":"JobPosting","title":"T","datePosted":"junk","jobLocation":[{"address":{"addressCountry":"NO"}}]}</script>'
    p = payload(spark, [("paylocity", "b", "Co", "https://x.com/p", body, 0)])
    r = feeds_html.paylocity(p, run_ts()).first()
    assert (r.title, r.location, r.source_url, r.date_posted, r.row_error) == ("T", "NO", "https://x.com/p", "2024-01-31T00:00:00.000Z", None)


def test_bad_posting_date_is_an_error(spark):
    body = '<script type="application/ld+json">{"@type":"JobPosting","title":"T","datePosted":"junk"}</script>'
    r = feeds_html.icims(payload(spark, [("icims", "b", "Co", "https://x.com/p", body, 0)]), run_ts()).first()
    assert r.row_error == "bad_date"


def test_incremental_ingestion(spark, tmp_path):
    land, out, cp = (str(tmp_path / n) for n in ("land", "out", "cp"))
    feeds = {"greenhouse": feeds_json.greenhouse, "lever": lambda p: feeds_json.lever(p, run_ts())}

    def land_page(i, source, body):
        payload(spark, [(source, "b", "Co", "u", body, i)]).write.mode("append").parquet(land)

    land_page(0, "greenhouse", '{"jobs":[{"title":"A"},{"title":"B"}]}')
    land_page(1, "lever", '[{"text":"C"}]')
    ingest_available(spark, land, out, cp, feeds)
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]
    ingest_available(spark, land, out, cp, feeds)
    land_page(2, "greenhouse", '{"jobs":[{"title":"D"}]}')
    ingest_available(spark, land, out, cp, feeds)
    assert sorted(r.title for r in spark.read.parquet(out).collect()) == ["A", "B", "C", "D"]


def jobs(*rows):
    """A page of greenhouse: (title, place, URL) each."""
    items = [{"title": t, "location": {"name": p}, "absolute_url": u} for t, p, u in rows]
    return json.dumps({"jobs": items})


def test_postings_come_out_once(spark, tmp_path, monkeypatch):
    land, out, state, cp = (str(tmp_path / n) for n in ("land", "out", "state", "cp"))
    feeds = {"greenhouse": feeds_json.greenhouse, "lever": lambda p: feeds_json.lever(p, run_ts())}

    def land_page(i, source, body):
        payload(spark, [(source, "b", "Co", "u", body, i)]).write.mode("append").parquet(land)

    def run():
        ingest_distinct(spark, land, out, state, cp, feeds, compact_every=2)
        rows = spark.read.parquet(out).collect()
        return sorted((r.title, r.location, r.batch_id) for r in rows)

    land_page(0, "greenhouse", jobs(("A", "X", "https://h.com/1"), ("B", "Y", "https://h.com/2"), ("B", "Z", "https://h.com/2?utm_source=q")))
    first = [("A", "X", 0), ("B", "Y", 0)]
    assert run() == first
    assert run() == first  # nothing landed
    # again by fingerprint with a new URL, again by URL with a new title, and two new ones without URL
    land_page(1, "greenhouse", jobs(("a", "x", "https://h.com/9"), ("C", "Y", "https://h.com/2/"), ("D", "Y", ""), ("E", "Y", "")))

    def fails(*_):
        raise RuntimeError("lost")

    keys = iter([incremental.posting_keys, fails])
    with monkeypatch.context() as m:  # the rows are written, their keys are not
        m.setattr(incremental, "posting_keys", lambda *a: next(keys)(*a))
        with pytest.raises(Exception):
            run()
    with monkeypatch.context() as m:  # everything is written, the batch is not committed
        m.setattr(incremental, "remove_stages", fails)
        with pytest.raises(Exception):
            run()
    second = first + [("D", "Y", 1), ("E", "Y", 1)]
    assert run() == second
    # the keys come from the compacted folder; C has not come out yet, only a row of that name with the URL of B
    land_page(2, "lever", json.dumps([{"text": "D", "categories": {"location": "Y"}}, {"text": "C", "categories": {"location": "Y"}}]))
    assert run() == second[:2] + [("C", "Y", 2)] + second[2:]
    assert [p.name for p in (tmp_path / "state" / "all").iterdir()] == ["batch_id=1"]


def test_alike_seeds_are_taken_apart_once(spark):
    """The first seed per key, also among spellings of one board; no URL is taken apart before equal seeds came together."""
    rows = [
        (5, "E", "workday", "", "https://S1.example.com/Site/"), (3, "C", "workday", "", "https://s1.example.com/Site"),
        (4, "D", "workday", "", "https://s1.example.com/Site"), (2, "B", "ashby", " Org ", "x"), (1, "A", "ashby", "org", "y"),
        (6, "F", "ashby", " ", "z"), (7, "G", None, "t", "https://s2.example.com/"), (8, "H", "workable", None, None),
        (9, "I", "workable", "", "https://S3.example.com"), (None, "J", "workable", "", "https://s3.example.com/"),
    ]
    seeds = spark.createDataFrame(rows, "ord long, company_name string, provider string, token string, source_url string")
    out = discovery.seed_dedup(seeds)
    assert sorted(tuple(r) for r in out.collect()) == [rows[4], rows[1], rows[8]]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in plan and "regexp_extract" not in plan.rsplit("Aggregate [provider", 1)[1]
