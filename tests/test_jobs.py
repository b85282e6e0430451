"""Jobs against brute force or worked examples."""

import random

import pytest
from pyspark.sql import functions as F

from hirestream.functions.keys import numbered
from hirestream.operators import caches, dedup, enrichment, firm_match, firms, history, hub, lookups, name_tries, publish, slugs
from hirestream.sources import discovery, pages
from hirestream import schemas as S


def run_ts():
    return F.to_timestamp(F.lit("2024-01-31"))


def seq(a, b):
    return {"a": a, "b": b}


def test_fingerprint_dedup_matches_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc"), rng.choice("xy"), "l", "d" * rng.randint(0, 4), f"s{rng.randint(0, 5)}") for i in range(300)]
    df = spark.createDataFrame(rows, "ord long, title string, company string, location string, description string, source string")
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[2]), []).append(r)
    want = []
    for g in groups.values():
        n = {}
        for r in g:
            n[r[5]] = n.get(r[5], 0) + 1
        multi = [r for r in g if n[r[5]] > 1]
        want += multi or [max(g, key=lambda r: (len(r[4]), -r[0]))]
    got = [r.ord for r in dedup.fingerprint_dedup(df).orderBy("seq").collect()]
    assert got == [r[0] for r in want]


def test_url_dedup_matches_loop(spark):
    rng = random.Random(2)
    rows = [
        (i, rng.choice(["", "http://a/1", "http://a/1?utm_source=q", "http://a/2", "http://a/3/"]), "d" * rng.randint(0, 3), "l",
         None if rng.random() < 0.5 else 1.0)
        for i in range(200)
    ]
    schema = "ord long, source_url string, description string, location string, salary_min double"
    none = F.lit(None)
    df = spark.createDataFrame(rows, schema).withColumns(
        {"salary_max": none.cast("double"), "contract_type": none.cast("string"), "contract_time": none.cast("string")})
    key = lambda u: u.split("?")[0].rstrip("/")
    score = lambda r: len(r[2]) + 25 + (50 if r[4] is not None else 0)
    out, at = [], {}
    for r in rows:
        k = key(r[1])
        if not k:
            out.append(r)
        elif k not in at:
            at[k] = len(out)
            out.append(r)
        elif score(r) > score(out[at[k]]):
            out[at[k]] = r
    got = [r.ord for r in dedup.url_dedup(df).orderBy("seq").collect()]
    assert got == [r[0] for r in out]
    again = dedup.url_dedup(dedup.url_dedup(df))
    assert again.count() == len(out)


def test_numbered_with_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), (-F.col("id")).alias("o"))
    got = {(r.k, r.o): r.n for r in numbered(df, ["k"], ["o"], "n").collect()}
    groups = {}
    for k, o in sorted(got):
        groups.setdefault(k, []).append(o)
    assert len(got) == 5000
    assert all(got[(k, o)] == i + 1 for k, os in groups.items() for i, o in enumerate(sorted(os)))
    hot = df.where("k = 'hot'").repartitionByRange(4, "k", "o").withColumn("p", F.spark_partition_id())
    assert hot.select("p").distinct().count() > 1


def greedy(rows, taken):
    used, out = set(taken), []
    for s in rows:
        c, k = s, 2
        while c in used:
            c, k = f"{s}-{k}", k + 1
        used.add(c)
        out.append(c)
    return out


def test_slugs_match_loop(spark):
    rng = random.Random(3)
    for trial in range(4):
        pool = ["a", "a-2", "a-3", "a-2-2", "b", "b-5", "c-02", "d-2"]
        rows = [rng.choice(pool) for _ in range(rng.randint(5, 60))]
        taken = rng.sample(["a", "a-2", "a-4", "b", "a-2-3", "zz"], rng.randint(0, 4))
        df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "ord long, slug_base string")
        existing = spark.createDataFrame([(t,) for t in taken], "slug string") if taken else None
        got = [r.slug for r in slugs.slug_uniquify(dedup.with_seq(df), existing).orderBy("ord").collect()]
        assert got == greedy(rows, taken), (trial, rows, taken)


def test_slug_groups_hold_contested_names_only(spark, monkeypatch):
    rows = ["s"] * 400 + ["s-7", "s-7", "s-1000", "s-300", "s-7-2", "s", "t"] + ["s"] * 50 + ["s-300"]
    taken = ["s-9999999", "s-3", "t", "t-2", "t-3", *(f"s-{i}" for i in range(500, 900)), "s-99999999999999999999"]
    sizes = []
    settle = slugs._settle
    monkeypatch.setattr(slugs, "_settle", lambda events: sizes.append(events.count()) or settle(events))
    df = dedup.with_seq(spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "ord long, slug_base string"))
    existing = spark.createDataFrame([(t,) for t in taken], "slug string")
    assert [r.slug for r in slugs.slug_uniquify(df, existing).orderBy("ord").collect()] == greedy(rows, taken)
    assert sizes == [4]


def test_taken_slugs(spark):
    items = spark.createDataFrame([(0, "u", "a"), (1, "u", "b"), (2, "", "c"), (3, None, "d"), (4, "v", "b")], "item_ord long, source_url string, slug string")
    assert sorted(r.slug for r in slugs.taken_slugs(items).collect()) == ["b", "b"]


def test_slug_examples(spark):
    def run(rows, taken=()):
        df = dedup.with_seq(spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "ord long, slug_base string"))
        ex = spark.createDataFrame([(t,) for t in taken], "slug string") if taken else None
        return [r.slug for r in slugs.slug_uniquify(df, ex).orderBy("ord").collect()]

    assert run(["s", "s", "s"]) == ["s", "s-2", "s-3"]
    assert run(["my-slug"], ["my-slug"]) == ["my-slug-2"]
    assert run(["a", "b", "a"]) == ["a", "b", "a-2"]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_fuzzy_match_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["north", "south", "architects", "engineering", "stone", "river", "harbor", "mill", "x", "design"]

    def name():
        return " ".join(rng.sample(words, rng.randint(1, 4)))

    def noisy(s):
        s = list(s)
        for _ in range(rng.randint(0, max(1, len(s) // 6))):
            p = rng.randrange(len(s) + 1)
            op = rng.random()
            if op < 0.4:
                s.insert(p, rng.choice("abcz"))
            elif s and op < 0.7:
                s.pop(min(p, len(s) - 1))
            elif s:
                s[min(p, len(s) - 1)] = rng.choice("abcz")
        return "".join(s)

    firm_names = [name() for _ in range(120)]
    companies = sorted({noisy(rng.choice(firm_names)) for _ in range(300)} | {"", "a", "north"})
    fdf = spark.createDataFrame([(i, n, []) for i, n in enumerate(firm_names)], "firm_ord long, name string, aliases array<string>")
    cdf = spark.createDataFrame([(c,) for c in companies], "company string")
    norm = lambda s: " ".join(s.split())
    want = {}
    for c in companies:
        for i, f in enumerate(firm_names):
            a, b = norm(f), norm(c)
            m = max(len(a), len(b))
            if m == 0 or 1 - lev(a, b) / m >= 0.85:
                want[c] = i
                break
    got = {r.company: r.firm_ord for r in firm_match.firm_match_fuzzy(cdf, fdf).collect()}
    assert got == want


def test_similar_names_share_rare_grams(spark):
    """Long names that differ in a number only: one candidate in ten pairs at most, and none is lost."""
    firm_names = [f"merchant {i:09d} trading" for i in range(1, 301)] + ["abcdef", "abcdefg", "xbcdefg", "abcdeg"]
    companies = [f"mercant {i * 70:09d} trading" for i in range(1, 1501)] + ["abcdefg", "abcdef", "abcde", "", "é" * 40]
    n = spark.createDataFrame([(c,) for c in companies], "norm string")
    f = spark.createDataFrame([(c,) for c in firm_names], "name string")
    pairs = firm_match.candidate_pairs(n, f).join(n.withColumn("probe", F.xxhash64("norm")), "probe").join(
        f.withColumn("firm", F.xxhash64("name")), "firm").select("norm", "name").collect()
    found = {(a, b) for a, b in pairs}
    assert len(found) == len(pairs) < 0.1 * len(firm_names) * len(companies)
    close = lambda a, b: 1 - lev(a, b) / max(len(a), len(b)) >= 0.85
    for a in [*companies[::97], *companies[-5:]]:
        assert {b for b in firm_names if a and len(a) > 5 and abs(len(a) - len(b)) < 4 and close(a, b)} <= {b for x, b in found if x == a}


def test_candidates_of_names_that_differ_in_a_number(spark):
    """Four times the names on both sides: their keys fill up, but not with the square of the names."""
    def candidates(n):
        f = spark.range(n).select(F.format_string("merchant %09d trading", "id").alias("name"))
        c = spark.range(15 * n).select(F.format_string("mercant %09d trading", F.col("id") * 7).alias("norm"))
        return firm_match.candidate_pairs(c, f).count()

    assert candidates(1600) < 6.5 * candidates(400)


@pytest.mark.parametrize("states", [1, 1 << 20])
def test_near_names_are_all_found(monkeypatch, states):
    monkeypatch.setattr(name_tries, "STATES", states)
    rng = random.Random(29)
    for letters in ("ab", "abc", "aé0"):
        for limit in (0, 1, 3):
            a, b = (sorted({rng.choice(["", "xx"]) + "".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(40)}) for _ in range(2))
            found = {(a[i], b[j]) for x, y in name_tries.near_names(name_tries.NameTrie(a), name_tries.NameTrie(b), limit) for i, j in zip(x, y)}
            assert {(x, y) for x in a for y in b if lev(x, y) <= limit} <= found


def test_crowded_names_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(firm_match, "BLOCK", 100)
    monkeypatch.setattr(firm_match, "FIRM_BLOCK", 30)
    monkeypatch.setattr(firm_match, "CROWD", 2)
    firm_names = [f"merchant {i * 3:09d} trading" for i in range(70)] + [f"merchants {i:09d} trading" for i in range(20)]
    companies = [f"mercant {i * 7:09d} trading" for i in range(250)]
    fdf = spark.createDataFrame([(i, n, []) for i, n in enumerate(firm_names)], "firm_ord long, name string, aliases array<string>")
    got = {r.company: r.firm_ord for r in firm_match.firm_match_fuzzy(spark.createDataFrame([(c,) for c in companies], "company string"), fdf).collect()}
    for c in companies[::5]:
        near = (i for i, f in enumerate(firm_names) if 1 - lev(f, c) / max(len(f), len(c)) >= 0.85)
        assert got.get(c) == next(near, None)


def test_alias_and_earlier_fuzzy_firm(spark):
    fdf = spark.createDataFrame(
        [(0, "Blue Harbor Architects", []), (1, "Blue Harbour Architects", []), (2, "Northwind Engineers", ["Cedar & Stone"])],
        "firm_ord long, name string, aliases array<string>")
    cdf = spark.createDataFrame([("Blue Harbour Architects LLP",), ("Cedar & Stone, Inc.",), ("Nobody",)], "company string")
    got = {r.company: r.firm_ord for r in firm_match.company_matches(cdf, fdf).collect()}
    assert got == {"Blue Harbour Architects LLP": 0, "Cedar & Stone, Inc.": 2, "Nobody": None}


def push_loop(batch, snapshot):
    """Sequential statement of the publish decision."""
    by_url, by_fp = {}, {}
    for id_, url, fp in snapshot:
        if url:
            by_url[url] = id_
        by_fp.setdefault(fp, []).append(id_)
    out = []
    for i, url, fp in batch:
        item = by_url.get(url)
        if item is None and len(by_fp.get(fp, [])) == 1:
            item = by_fp[fp][0]
        if item is not None:
            out.append(("update", item))
            continue
        item = f"new:{i}"
        by_url[url] = item
        by_fp.setdefault(fp, []).append(item)
        out.append(("create", item))
    return out


def test_match_published_matches_loop(spark):
    rng = random.Random(5)
    for _ in range(5):
        batch = [(i, "" if rng.random() < 0.4 else f"u{i}", rng.choice("abcdef")) for i in range(40)]
        snap = [(f"it{i}", rng.choice(["", f"u{rng.randint(0, 60)}"]), rng.choice("abcd")) for i in range(rng.randint(0, 8))]
        b = spark.createDataFrame([(i, u, "co", t, "") for i, u, t in batch], "ord long, source_url string, company string, title string, location string")
        p = spark.createDataFrame([(d, n, u, "co", t, "") for n, (d, u, t) in enumerate(snap)],
                                  "id string, item_ord long, source_url string, company string, title string, location string")
        got = [(r.action, r.item_id) for r in publish.match_published(b, p).orderBy("ord").collect()]
        assert got == push_loop(batch, snap)


SCORE = ("ord long, salary_min double, salary_max double, salary_estimated boolean, firm_ord long, has_enrichment boolean, rank int, "
         "description string, tools_mentioned string, experience_level string, location string, role_summary string, company_description string")


def test_scores(spark):
    base = (None, None, False, None, False, None, "Short", "", "", "New York", "", "")
    full = (9e4, 1.3e5, False, 1, True, 2, "x" * 2000, "Revit, AutoCAD, Bluebeam", "Senior", "New York, NY", "r", "c")
    rows = [
        (base, 0, 0), ((8e4, 1.2e5, False, *base[3:]), 15, 15), ((8e4, 1.2e5, True, *base[3:]), 5, 5),
        ((*base[:3], 7, *base[4:]), 15, 15), ((*base[:6], "x" * 501, *base[7:]), 10, 10), ((*base[:6], "x" * 1501, *base[7:]), 15, 15),
        ((*base[:7], "Revit, AutoCAD, Bluebeam", *base[8:]), 10, 10), (full, 85, 95), ((0.0, 1.0, False, *base[3:]), 0, 0),
        ((*base[:5], 0, *base[6:]), 0, 0),
    ]
    df = spark.createDataFrame([(i, *r[0]) for i, r in enumerate(rows)], SCORE)
    got = [(r.pre_score, r.quality_score) for r in enrichment.quality_score(enrichment.pre_score(df)).orderBy("ord").collect()]
    assert got == [(r[1], r[2]) for r in rows]


def test_salary_rules(spark):
    rows = [
        (0, "Project Manager", "Seattle, Washington", "project-management", None, None), (1, "Architect", "Nowhere", "operations", 0.0, 5.0),
        (2, "Civil PM", "Austin", "operations", 1.0, 2.0), (3, "Data Architect", "NYC", "resource-management", None, 5.0),
    ]
    df = spark.createDataFrame(rows, "ord long, title string, location string, role_category string, salary_min double, salary_max double")
    got = [(r.soc, r.metro, r.salary_min, r.salary_max, r.salary_estimated) for r in lookups.salary_estimate(df).orderBy("ord").collect()]
    assert got == [
        ("11-9021", "Washington", 95000.0, 158000.0, True), ("17-1011", None, 65000.0, 106000.0, True),
        ("17-2051", "Austin", 1.0, 2.0, False), ("11-3013", "New York", 88000.0, 158000.0, True),
    ]


def test_history(spark):
    h = spark.createDataFrame([("2022-06-30", 5), ("2024-01-20", 5), ("2024-01-28", 8)], "d string, created long").select(F.to_timestamp("d").alias("run_ts"), "created")
    kept = history.append_history(h.limit(2), h.where("created = 8"), run_ts())
    assert sorted(r.created for r in kept.collect()) == [5, 8]
    r = history.rolling_created(kept, run_ts()).first()
    assert (r.total_runs, r.created_30d) == (2, 13)
    assert history.rolling_created(h.where("false"), run_ts()).first().created_90d == 0
    weeks = {str(r.week): r.created for r in history.weekly_created(kept).collect()}
    assert weeks == {"2024-01-14": 5, "2024-01-28": 8}


def test_merge_firms_example(spark):
    old = spark.createDataFrame(
        [(0, "Acme Inc", [], "T", "", None, [], "", "", "", "", "", "x"), (1, "ACME", [], "T", "", None, [], "", "", "", "", "", "")], S.FIRM)
    lst = spark.createDataFrame(
        [(0, "Acme LLC", "Design", "w1", "", "US", "Texas", ""), (1, "acme", "", "w2", "l2", "US", "", "Austin"),
         (2, "New Co", "", "", "", "US", "Utah", "Provo"), (3, "New", "SaaS", "w3", "", "US", "", ""), (4, "", "", "", "", "", "", "")], S.FIRM_CSV)
    got = {(r.is_new, r.merge_ord): (r.name, r.website, r.linkedin, r.hq, r.hq_state, r.hq_city, r.industry) for r in firms.merge_firms(old, lst).collect()}
    ae = "Architecture & Engineering"
    assert got == {
        (False, 0): ("Acme Inc", "", "x", "", "", "", ""),
        (False, 1): ("ACME", "w1", "l2", "Texas", "Texas", "Austin", ae),
        (True, 2): ("New Co", "w3", "", "Provo, Utah", "Utah", "Provo", ae),
    }
    c = firms.merge_counters(old, lst).first()
    assert (c.added, c.updated, c.skipped) == (1, 3, 0)


def test_change_set_replay(spark):
    items = spark.createDataFrame(
        [("a", "old", True, "2024-02-05"), ("b", "old", True, "2024-01-20"), ("c", "old", True, "2023-12-01"), ("d", "old", False, "2023-12-01")],
        "id string, name string, pipeline_managed boolean, e string").select("id", "name", "pipeline_managed", F.to_timestamp("e").alias("expiration_date"))
    ch = spark.createDataFrame(
        [(0, "a", "first", True, "2024-02-07"), (1, "a", "second", True, "2024-02-07"), (2, "new:2", "made", True, "2024-01-30")],
        "ord long, item_id string, name string, pipeline_managed boolean, e string").withColumn("expiration_date", F.to_timestamp("e"))
    out = {r.id: (r.name, r.live) for r in publish.apply_change_set(items, dedup.with_seq(ch), run_ts()).collect()}
    assert out == {"a": ("second", True), "b": ("old", False), "d": ("old", True), "new:2": ("made", False)}


def test_frontier_and_details(spark):
    u = lambda n: f"https://b.icims.com/jobs/search?pr={n}"
    seeds = spark.createDataFrame([("x", u(1)), ("y", "https://b.icims.com/jobs/9/title/job?x=1")], "board string, page string")
    links = spark.createDataFrame([(u(1), u(2)), (u(2), u(1)), (u(2), u(3)), (u(3), "https://other.com/jobs/search?pr=4")], "page string, link string")
    got = {(r.board, r.page): r.level for r in pages.search_page_frontier(seeds, links).collect()}
    assert got[("x", u(3))] == 2 and len(got) == 4
    details = spark.createDataFrame([(u(2), "https://b.icims.com/jobs/7/t/job?in=1#f"), (u(3), "https://b.icims.com/jobs/7/t/job")], "page string, link string")
    found = pages.detail_links(pages.search_page_frontier(seeds, links), details, seeds)
    assert sorted((r.board, r.link) for r in found.collect()) == [
        ("x", "https://b.icims.com/jobs/7/t/job"), ("y", "https://b.icims.com/jobs/9/title/job")]


def test_frontier_of_many_crawls(spark):
    u = lambda n: f"https://b.icims.com/jobs/search?pr={n}"
    rng = random.Random(5)
    pairs = {(rng.randrange(150), rng.randrange(150)) for _ in range(260)}
    seeds = [(b, n) for b in range(140) for n in {b % 120, b % 7}]
    want = {}
    for b in range(140):
        level, last = 0, {n for x, n in seeds if x == b}
        while last:
            want |= {(b, u(n)): level for n in last}
            last = {t for f, t in pairs if f in last and (b, u(t)) not in want}
            level += 1
    found = pages.search_page_frontier(
        spark.createDataFrame([(b, u(n)) for b, n in seeds], "board long, page string"),
        spark.createDataFrame([(u(a), u(b)) for a, b in pairs], "page string, link string")).collect()
    assert len(found) == len(want) and {(r.board, r.page): r.level for r in found} == want


def test_frontier_merges_what_was_visited(spark):
    """Later rounds read one row a page and block, not one for each level in which crawls reached it."""
    from hirestream.session import STAGED

    u = lambda n: f"https://b.icims.com/jobs/search?pr={n}"
    seeds, links = [(b, u(b)) for b in range(7)], [(u(n), u((n + 1) % 11)) for n in range(11)]
    since = len(STAGED)
    found = pages.search_page_frontier(
        spark.createDataFrame(seeds, "board long, page string"), spark.createDataFrame(links, "page string, link string")).collect()
    assert {(r.board, r.page, r.level) for r in found} == {(b, u((b + k) % 11), k) for b in range(7) for k in range(11)}
    merged = [spark.read.parquet(p) for p in STAGED[since:] if "/merged-pages-" in p]
    assert merged and all(m.count() == m.select("block", "id").distinct().count() for m in merged)


def test_frontier_query_follows_links_over_the_whole_table(spark, tmp_path):
    from checks.queries import QUERIES

    spark.range(1, 131).withColumnRenamed("id", "page_id").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.board: r.pages for r in QUERIES["search_page_frontier"](spark, str(tmp_path)).collect()}
    assert got == {b: 130 for b in (*range(1, 10), 107)}


def test_jsonld_search_order(spark):
    docs = {
        1: '<script type="application/ld+json">{"a":{"@type":"JobPosting","title":"child"},"@graph":[{"@type":["X","jobposting"],"title":"graph"}]}</script>',
        2: "<script type='application/ld+json'><![CDATA[{bad]]></script><script type='application/ld+json'>[[{\"@type\":\"JOBPOSTING\",\"title\":\"é\"}]]</script>",
        3: '<script type="application/ld+json">{"@type":"Thing","x":NaN}</script>',
        4: '<script type="application/ld+json">' + "[" * 100_000 + "]" * 100_000 + "</script>"
           '<script type="application/ld+json">{"@type":"JobPosting","title":"after"}</script>',
        5: "no script at all",
    }
    df = spark.createDataFrame(list(docs.items()), "page_id long, html string")
    got = {r.page_id: r.t for r in pages.extract_jsonld_postings(df).select("page_id", F.get_json_object("posting", "$.title").alias("t")).collect()}
    assert got == {1: "graph", 2: "é", 4: "after"}
    assert "Exchange" not in pages.with_posting(df)._jdf.queryExecution().executedPlan().toString()


def test_text_by_class(spark):
    df = spark.createDataFrame([(1, "<p class='x'>no</p><div class=\"a big-ad b\">One<br>Two &amp; <b>three</b></div><div class='ad'>later</div>")], "page_id long, html string")
    assert pages.extract_text_by_class(df, "ad").first().text == "One\nTwo & three"


def test_seed_dedup_blank_keys(spark):
    df = spark.createDataFrame(
        [(0, "A", "ashby", " Tok ", "u"), (1, "B", "ashby", "tok", "u"), (2, "C", "ashby", "", "u"), (3, "D", "workable", "", "https://W.com/x/"), (4, "E", "workable", "", "https://w.com/x")],
        "ord long, company_name string, provider string, token string, source_url string")
    assert sorted(r.ord for r in discovery.seed_dedup(df).collect()) == [0, 3]


def test_cache_upsert(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, t int")
    new = spark.createDataFrame([("a", 2, 5), ("a", 3, 4), ("c", 9, 1)], "k string, v int, t int")
    assert sorted((r.k, r.v) for r in caches.cache_upsert(old, new, "k", "t").collect()) == [("a", 2), ("b", 1), ("c", 9)]


def test_related_listings(spark):
    df = spark.createDataFrame([(i, "r", f"2024-01-{i + 1:02d}") for i in range(8)] + [(8, "s", "2024-01-01")], "ord long, role_category string, date_posted string")
    got = {}
    for r in hub.related_listings(df).orderBy("ord", "position").collect():
        got.setdefault(r.ord, []).append(r.related_ord)
    assert got[7] == [6, 5, 4, 3] and got[0] == [7, 6, 5, 4] and got[5] == [7, 6, 4, 3] and 8 not in got
