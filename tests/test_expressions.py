"""Expected values of the column expressions, each table checked in one job."""

from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions import text as X
from hirestream.functions import urls as U
from hirestream.functions.location import with_location
from hirestream.operators.enrichment import add_experience_level, add_tools
from hirestream.operators.filters import industry_signal_filter, role_filter
from hirestream.operators.firm_match import similarity


def table(spark, pairs, schema="x string"):
    return spark.createDataFrame([(i, *(p if isinstance(p, tuple) else (p,))) for i, p in enumerate(pairs)], "i int, " + schema)


def column(df, name="y"):
    return [r[name] for r in df.orderBy("i").collect()]


def check(spark, cases, expr):
    got = column(table(spark, [k for k, _ in cases]).select("i", expr(F.col("x")).alias("y")))
    assert got == [v for _, v in cases]


def test_norm_firm(spark):
    check(spark, [
        ("Gensler Inc", "gensler"), ("Page LLC", "page"), ("AECOM Corp", "aecom"),
        ("Skidmore, Owings & Merrill LLP", "skidmore owings & merrill"),
        ("Walter P Moore & Associates, Inc.", "walter p moore &"), ("HDR", "hdr"), ("X& Associates", "x"),
        ("Société Co", "société"), ("L.L.C.", ""),
    ], X.norm_firm)


def test_norm_company_one_pass(spark):
    # punctuation and suffixes go in one pass, so dotted suffixes stay
    check(spark, [("Foo L.L.C.", "foo llc"), ("Foo, Inc.", "foo"), ("The Page Group", "the page")], X.norm_company)


def test_norm_key(spark):
    check(spark, [("  A-B  c\tD! ", "ab cd"), ("Ünïque", "nque"), ("", "")], X.norm_key)


def test_similarity(spark):
    t = table(spark, [("gensler", "gensler"), ("gensler", "genslr"), ("gensler", "amazon"), ("", "")], "a string, b string")
    same, near, far, empty = column(t.select("i", similarity(F.col("a"), F.col("b")).alias("y")))
    assert same == 1 and near > 0.8 and far < 0.5 and empty == 1


def test_role_by_title(spark):
    pm, rm, op = C.ROLE_TITLE_KEYWORDS
    cases = {
        "Senior Project Manager": pm, "Project Director": pm, "Project Coordinator": pm, "Resource Manager": rm,
        "Resource Planner": rm, "Utilization Manager": rm, "Operations Manager": op, "Director of Operations": op,
        "Studio Director": op, "COO": op, "Office Coordinator": op, "Software Engineer": None, "Marketing Manager": None,
        "Data Analyst": None,
    }
    df = table(spark, [(t, "") for t in cases], "title string, description string")
    got = {r.title: r.role_category for r in role_filter(df).collect()}
    assert got == {t: v for t, v in cases.items() if v}


def test_role_by_description(spark):
    df = table(spark, [
        ("x", "Responsible for resource management and capacity planning across teams"),
        ("x", "Experience with resource management preferred"), ("x", "Build and deploy microservices"),
    ], "title string, description string")
    assert [(r.i, r.role_category) for r in role_filter(df).collect()] == [(0, "operations")]


def test_industry_signals(spark):
    df = table(spark, ["Join our architecture practice working with AutoCAD", "one word: architecture", "cloud and kubernetes", "leed"], "description string")
    # "architecture" also contains "architect": two signals
    assert sorted(r.i for r in industry_signal_filter(df).collect()) == [0, 1]


def test_experience_level(spark):
    cases = [
        ("Senior Project Manager", "Senior"), ("Sr. Operations Manager", "Senior"), ("Lead Project Engineer", "Senior"),
        ("Director of Operations", "Director"), ("VP of Project Management", "Director"), ("Senior Director", "Senior"),
        ("Junior Project Manager", "Junior"), ("Entry Level Coordinator", "Junior"), ("Entry-level", "Junior"),
        ("Mid-level Planner", "Mid-Level"), ("Office Assistant", "Entry-Level"), ("Project Manager", ""),
        ("Operations Manager", ""), ("Seniority", ""), ("ése senior", "Senior"),
    ]
    df = table(spark, [k for k, _ in cases], "title string")
    assert column(add_experience_level(df), "experience_level") == [v for _, v in cases]


def test_tools(spark):
    cases = [
        ("Experience with Revit, AutoCAD, and Bluebeam. Must know Procore.", "Procore, Bluebeam, Revit, AutoCAD"),
        ("REVIT and autocad", "Revit, AutoCAD"), ("We will revisit the plans", ""),
        ("Deltek Vision and Smartsheet", "Deltek, Deltek Vision, Smartsheet"), ("Salesforce CRM and Power BI", "Salesforce, Power BI"),
        ("General management", ""), ("Microsoft Project and Oracle Primavera P6", "Microsoft Project, Oracle Primavera, P6, Primavera P6"),
        ("éRevité", "Revit"), ("Monday.com or Mondayxcom", "Monday.com"),
    ]
    df = table(spark, [k for k, _ in cases], "description string")
    assert column(add_tools(df), "tools_mentioned") == [v for _, v in cases]


def test_locations(spark):
    cases = [
        ("New York, NY", ("New York", "New York", False)), ("San Francisco, California", ("San Francisco", "California", False)),
        ("Chicago, IL, United States", ("Chicago", "Illinois", False)), ("Remote", ("", "", True)),
        ("Remote - New York, NY", ("New York", "New York", True)), ("Houston, TX (Remote)", ("Houston", "Texas", True)),
        ("", ("", "", False)), ("Washington, DC", ("Washington", "District of Columbia", False)),
        ("Austin, TX 78728", ("Austin", "Texas", False)), ("Dallas, Texas 75034", ("Dallas", "Texas", False)),
        ("TX 77380", ("", "Texas", False)), ("Florida 32960", ("", "Florida", False)), ("FL; Hybrid", ("", "Florida", True)),
        ("NC (Hybrid)", ("", "North Carolina", True)), ("TX (Hybrid - 2 days in-office)", ("", "Texas", True)),
        ("United States; Texas", ("", "Texas", False)), ("United States; Utah", ("", "Utah", False)),
        ("Houston, TX 77042 (Hybrid)", ("Houston", "Texas", True)), ("Paris, France", ("Paris", "France", False)),
        ("Oslo", ("Oslo", "", False)), ("Texas, Dallas", ("Dallas", "Texas", False)), ("US", ("", "", False)), (None, ("", "", False)),
    ]
    df = with_location(table(spark, [k for k, _ in cases]), "x", "city", "state", "remote")
    got = [(r.city, r.state, r.remote) for r in df.orderBy("i").collect()]
    assert got == [v for _, v in cases]


def test_industries(spark):
    ae = "Architecture & Engineering"
    cases = [
        ("Architecture & Engineering", ae), ("A&E", ae), ("AEC", ae), ("A/E", ae), ("Architecture", ae), ("Engineering", ae),
        ("Structural Engineering", ae), ("Civil Engineering", ae), ("MEP", ae), ("Landscape Architecture", ae),
        ("Interior Design", ae), ("Surveying", ae), ("ARCHITECTURE", ae), ("  Architecture  ", ae), ("Construction", "Construction"),
        ("Construction Management", "Construction"), ("Real Estate", "Real Estate"), ("Technology", "Technology"), ("SaaS", "Technology"),
        ("Structural Engineering Firm", ae), ("Architecture / Planning", ae), ("Commercial Real Estate Development", "Real Estate"),
        ("Construction & General Contracting", "Construction"), ("Design", ae), ("Structural Engineering Services", ae),
        ("Underwater Basket Weaving", "Underwater Basket Weaving"), ("", ""), ("  ", ""), ("hospitality", "Technology"),
    ]
    df = X.with_industry(table(spark, [k for k, _ in cases]), "x", "y")
    assert column(df) == [v for _, v in cases]


def test_slug_base(spark):
    cases = [
        (("Senior Project Manager", "Gensler", "New York"), "senior-project-manager-at-gensler-new-york"),
        (("Project Manager", "Perkins&Will", "Chicago"), "project-manager-at-perkinsandwill-chicago"),
        (("Project Manager (Sr.)", "HOK", "St. Louis, MO"), "project-manager-sr-at-hok-st-louis-mo"),
        (("OPERATIONS MANAGER", "AECOM", "LOS ANGELES"), "operations-manager-at-aecom-los-angeles"),
        (("Project   Manager", "HDR  Inc", "Omaha"), "project-manager-at-hdr-inc-omaha"),
    ]
    long = ("Senior Vice President of Project Management and Strategic Operations", "Thornton Tomasetti International", "San Francisco")
    df = table(spark, [k for k, _ in cases] + [long], "t string, c string, l string")
    got = column(df.select("i", X.slug_base(F.col("t"), F.col("c"), F.col("l")).alias("y")))
    assert got[:-1] == [v for _, v in cases]
    assert len(got[-1]) <= 80 and not got[-1].endswith("-")


def test_html_variants(spark):
    x = "<p>a&amp;lt;b&amp;gt;</p><br/>x<span>y</span><ul><li>z</li></ul>&#x2F;"
    df = table(spark, [x])
    r = df.select(*[X.html_text(F.col("x"), v).alias(v) for v in "ABCD"]).first()
    assert r.A == "a<b>\n\nxy\nz\n&#x2F;"
    assert r.B == "a&lt;b&gt;\n\nx\ny\n\nz\n\n/"
    assert r.C == "a&lt;b&gt;\n\nxy\n\nz\n\n/"
    assert r.D == "a&lt;b&gt;\n\nx\ny\n\nz\n\n&#x2F;"


def test_canonical_url(spark):
    df = table(spark, [
        "HTTP://Foo.com:80/a/b/?utm_source=x&b=1&c#z", "https://x.com", "  not a url// ", "https://x.com/p?ref=1&gh_jid=2", "", None,
        "https://u:p@x.com:444/a//?q=a%20b",
    ])
    got = column(U.with_canonical_url(df, "x", "y"))
    assert got == ["http://foo.com/a/b?b=1&c=", "https://x.com/", "not a url", "https://x.com/p", "", "", "https://x.com:444/a?q=a+b"]


def test_unwrap_redirect(spark):
    df = table(spark, [
        "https://nam.safelinks.protection.outlook.com/?url=https%3A%2F%2Fjobs.x.com%2Fa&d=1",
        "https://urldefense.com/v3/__https:/jobs.x.com/z__;!!abc", "https://plain.com/x",
        "https://nam.safelinks.protection.outlook.com/?url=broken",
    ])
    assert column(U.with_unwrapped_url(df, "x", "y")) == ["https://jobs.x.com/a", "https://jobs.x.com/z", "https://plain.com/x", None]


def test_dates(spark):
    df = table(spark, ["2024-01-02T03:04:05Z", "Tue, 02 Jan 2024 10:00:00 +0100", "Tue, 02 Jan 2024 10:00:00 GMT", "2024-01-02", "soon", ""])
    got = column(df.select("i", X.iso(X.parse_date(F.col("x"))).alias("y")))
    assert got == ["2024-01-02T03:04:05.000Z", "2024-01-02T09:00:00.000Z", "2024-01-02T10:00:00.000Z", "2024-01-02T00:00:00.000Z", None, None]


def test_relative_dates(spark):
    run = F.to_timestamp(F.lit("2024-01-31"))
    df = table(spark, ["Posted Today", "Posted Yesterday", "3 Days Ago", "2 weeks ago", "5 Hours ago", "30+ Days Ago", None])
    got = column(df.select("i", X.iso(X.relative_date(F.col("x"), run)).alias("y")))
    assert [g[:13] for g in got] == ["2024-01-31T00", "2024-01-30T00", "2024-01-28T00", "2024-01-17T00", "2024-01-30T19", "2024-01-31T00", "2024-01-31T00"]


def test_employment_rules(spark):
    df = table(spark, ["Full-time", "Part-time", "Contract", "Internship", "", "Permanent"])
    plain = column(df.select("i", X.employment_type(F.col("x")).alias("y")))
    assert [tuple(p) for p in plain] == [("permanent", "full_time"), ("permanent", "part_time"), ("contract", None), (None, None), (None, None), ("permanent", None)]
    lever = column(df.select("i", X.employment_type(F.col("x"), lever=True).alias("y")))
    assert tuple(lever[1]) == (None, "part_time")
    intern = column(df.select("i", X.employment_type(F.col("x"), internships=True).alias("y")))
    assert tuple(intern[3]) == ("permanent", "part_time")


def test_ends_and_sections_without_a_search_of_the_whole_text(spark):
    """Trimming and CDATA look for fixed characters; no regular expression is tried at every place of a text."""
    import re

    ends = ["", " ", " a ", "\ufeff\u2003a b\u00a0\n", "\u180ea", "\x1fa\x85", "é\u3000", "\u2028", "a\u202f\u205f", None]
    check(spark, [(t, t if t is None else re.sub(rf"^{X.WS}+|{X.WS}+\Z", "", t)) for t in ends], X.trim_ws)
    check(spark, [
        ("<![CDATA[é]]>", "é"), ("é<![CDATA[]]>", ""), ("a<![CDATA[b<![CDATA[c]]>d]]>", "b<![CDATA[c"), ("]]>a<![CDATA[b", "]]>a<![CDATA[b"),
        ("]]><![CDATA[x\n\ny]]><![CDATA[z]]>", "x\n\ny"), ("", ""), (None, None), ("<![CDATA[a]]", "<![CDATA[a]]"),
    ], X.strip_cdata)
    plan = spark.range(1).select(X.strip_cdata(X.trim_ws(F.col("id").cast("string"))))._jdf.queryExecution().analyzed().toString().lower()
    assert "regexp" not in plan and "rlike" not in plan
