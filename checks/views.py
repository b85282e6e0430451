"""Job-shaped tables derived from the given parquet tables.

One text per table, used by both engines ({S} is the string type).  Every table
grows with the table it is derived from.
"""

from __future__ import annotations

RUN_TS = "2024-01-31 00:00:00"

# name -> (tables it needs, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {}

VIEWS["listings"] = ([], """
with t(i,title) as (values (0,'Senior Project Manager'),(1,'Resource Planner'),(2,'Operations Manager'),
  (3,'Software Engineer'),(4,'Project Architect Lead'),(5,'Director of Operations'),(6,'Marketing Coordinator'),
  (7,'Junior Project Engineer'),(8,'Data Analyst'),(9,'Studio Director')),
c(i,company) as (values (0,'Acme Design Group'),(1,'Northwind Engineers, Inc.'),(2,'Blue Harbor Architects LLP'),
  (3,'Blue Harbour Architects'),(4,'Cedar & Stone Associates'),(5,'Totally Unrelated Foods')),
l(i,location) as (values (0,'New York, NY'),(1,'San Francisco, California'),(2,'Remote'),
  (3,'Houston, TX 77042 (Hybrid)'),(4,'FL; Hybrid'),(5,'United States; Texas'),(6,'Seattle, Washington'),
  (7,'Chicago, IL, United States'),(8,''),(9,'Remote - Austin, TX'),(10,'Paris, France')),
d as (select doc_id, text, cast(floor(doc_id/3) as bigint) k, doc_id % 3 m from documents)
select d.doc_id ord, t.title,
 case when k % 5 < 3 then c.company else concat('Studio ', cast(k as {S})) end company, l.location,
 concat(case cast(doc_id % 4 as int) when 0 then 'Experience with Revit and AutoCAD on schematic design. '
   when 1 then 'Resource planning and capacity planning with Procore, Bluebeam, Power BI. ' else '' end, text) description,
 concat('https://jobs.example.com/p/', cast(doc_id - (case when doc_id % 10 = 9 then 1 else 0 end) as {S}),
   case cast(doc_id % 3 as int) when 0 then '?utm_source=feed' when 1 then '/' else '#apply' end) source_url,
 concat('2024-01-', lpad(cast(1 + doc_id % 28 as {S}), 2, '0'), 'T08:00:00.000Z') date_posted,
 case when doc_id % 5 = 0 then cast(60000 + (doc_id % 40)*1000 as double) end salary_min,
 case when doc_id % 5 = 0 and doc_id % 10 = 0 then cast(90000 + (doc_id % 40)*1000 as double) end salary_max,
 doc_id % 30 = 20 salary_is_predicted,
 case cast(doc_id % 4 as int) when 0 then 'permanent' when 1 then 'contract' when 2 then '' end contract_type,
 case cast(doc_id % 6 as int) when 0 then 'full_time' when 1 then 'part_time' end contract_time,
 case when doc_id % 7 = 0 then 'Ops' end category,
 concat('src', cast((k + case cast(k % 4 as int) when 0 then 0 when 2 then cast(floor(m/2) as bigint) else m end) % 15 as {S})) source
from d join t on t.i = k % 10 join c on c.i = k % 6 join l on l.i = k % 11
""")

VIEWS["published"] = (["listings"], """
select concat('it', cast(ord as {S})) id, ord item_ord,
 case when ord % 11 = 0 then concat('https://old.example.com/', cast(ord as {S})) else source_url end source_url,
 title, company, location, ord % 14 <> 0 pipeline_managed,
 timestamp '2024-01-31 00:00:00' + interval 1 day * cast(ord % 60 - 45 as int) expiration_date,
 lower(replace(concat(title, ' at ', company, ' ', location), ' ', '-')) slug
from listings where ord % 7 = 0 or ord % 11 = 0
""")

VIEWS["firm"] = ([], """
with named as (
 select cast(firm_ord as bigint) firm_ord, name, alias from (values (0,'Blue Harbor Architects',''),(1,'Acme Design',''),
   (2,'Northwind Engineers','Cedar & Stone'),(3,'Gensler','')) v(firm_ord, name, alias)
 union all
 select 4 + k, case when k % 50 = 13 then concat('Studios ', cast(k as {S})) when k % 25 = 13 then concat('Studio ', cast(k as {S}), ' Inc') else concat('Atelier Nr ', cast(k as {S})) end, ''
 from (select distinct cast(floor(doc_id/3) as bigint) k from documents) x)
select firm_ord, name, alias, concat('Type ', cast(firm_ord % 3 as {S})) firm_type,
 case cast(firm_ord % 4 as int) when 0 then 'Architecture & Engineering' when 1 then 'Structural Engineering Firm'
   when 2 then '' else 'Food Service' end industry,
 case when firm_ord % 3 = 0 then cast(firm_ord % 100 + 1 as int) end firm_rank,
 case cast(firm_ord % 3 as int) when 0 then 'Austin, TX' when 1 then 'Paris, France' else '' end hq,
 case when firm_ord % 2 = 0 then 'Texas' else '' end hq_state,
 case when firm_ord % 4 = 0 then 'Dallas' else '' end hq_city,
 case when firm_ord % 5 = 0 then '' else '1000+' end size,
 case when firm_ord % 2 = 0 then concat('www.firm', cast(firm_ord as {S}), '.com') else 'http://x.example.com' end website,
 case when firm_ord % 3 = 0 then 'linkedin.com/company/x' else '' end linkedin
from named
""")

VIEWS["enrichment"] = ([], """
with keys as (
 select company_key, cast(i as bigint) i from (values ('acme design',0),('northwind engineers',40),('blue harbor architects',2),
   ('blue harbour architects',3),('cedar & stone',4),('totally unrelated foods',5)) v(company_key, i)
 union all
 select concat('studio ', cast(k as {S})), k from (select distinct cast(floor(doc_id/3) as bigint) k from documents) x
 where k % 5 >= 3 and k % 3 = 0)
select company_key, case when i % 2 = 0 then '50–200 employees' else '5,000+ employees' end employee_count,
 case cast(i % 3 as int) when 0 then 'Construction Management' when 1 then 'Hospitality' else 'Basket Weaving' end industry,
 case when i % 2 = 0 then 'Denver, CO' else '' end hq, concat('About ', company_key) summary,
 cast(1900 + i % 100 as {S}) founded, 'private' company_type,
 timestamp '2024-01-31 00:00:00' - interval 1 day * cast(i % 60 as int) fetched_at
from keys
""")

VIEWS["role_texts"] = (["listings"], """
select md5(concat(company, '|', title, '|', substring(description, 1, 500))) content_key,
 max(concat('Role text for ', title)) role_summary
from listings where ord % 3 <> 1 group by 1
""")

VIEWS["company_texts"] = ([], """
select company_key, concat('Company text for ', company_key) description,
 timestamp '2024-01-31 00:00:00' - interval 1 day * cast((i * 13) % 500 as int) generated_at
from (
 select company_key, cast(i as bigint) i from (values ('acme design group',0),('northwind engineers inc',1),('blue harbor architects llp',2),
   ('blue harbour architects',37),('cedar stone associates',4)) v(company_key, i)
 union all
 select concat('studio ', cast(k as {S})), k from (select distinct cast(floor(doc_id/3) as bigint) k from documents) x where k % 2 = 0
) y
""")

VIEWS["firm_csv"] = ([], """
with s as (select s_suppkey k, s_name, n_name, s_nationkey from supplier join nation on s_nationkey = n_nationkey),
base as (
 select k * 2 ord, k, s_name name, n_name, s_nationkey, 0 again from s
 union all
 select k * 2 + 1, k, upper(s_name), n_name, s_nationkey, 1 from s where k % 10 = 0)
select cast(ord as bigint) ord, name,
 case cast(k % 5 as int) when 0 then 'Civil Engineering' when 1 then '' when 2 then 'Food Service' when 3 then 'SaaS' else 'Landscape Architecture Studio' end industry,
 case when again = 0 and k % 4 = 0 then '' else concat('www.supplier', cast(k as {S}), case when again = 1 then 'b' else '' end, '.com') end website,
 case when k % 3 = 0 then '' else concat('linkedin.com/company/', cast(k as {S})) end linkedin,
 case when k % 2 = 0 then 'United States' else 'Canada' end country,
 case when k % 6 = 0 then '' else n_name end state,
 case when again = 0 and k % 7 = 0 then '' else concat('City ', cast(s_nationkey as {S})) end city
from base
""")

VIEWS["firm_old"] = ([], """
select cast(s_suppkey as bigint) firm_ord, case when s_suppkey % 3 = 0 then concat(s_name, ', Inc.') else concat('Former ', s_name) end name, 'Old Type' firm_type,
 case when s_suppkey % 4 = 0 then 'Consulting' else '' end industry, cast(null as int) firm_rank,
 case when s_suppkey % 9 = 0 then 'Old HQ' else '' end hq, '' hq_state,
 case when s_suppkey % 12 = 0 then 'Old City' else '' end hq_city, '10+' size,
 case when s_suppkey % 15 = 0 then 'old.example.com' else '' end website, '' linkedin
from supplier
""")

VIEWS["board_cache"] = ([], """
select lower(replace(s_name, '#', '')) firm_key,
 case cast(s_suppkey % 3 as int) when 0 then 'greenhouse' when 1 then 'lever' else 'none' end provider,
 concat('tok', cast(s_suppkey as {S})) board_token,
 timestamp '2024-01-31 00:00:00' - interval 1 day * cast(s_suppkey % 60 as int) detected_at
from supplier
""")

VIEWS["history"] = ([], """
select cast(cast(ts as date) as timestamp) run_ts, cast(extract(day from cast(ts as date)) * 1234 as bigint) duration_ms,
 count(*) total_ingested, count(*) - 10 after_dedup, count(*) - 20 after_filter, count(*) - 30 after_quality_filter,
 cast(sum(case when event_type='purchase' then 1 else 0 end) as bigint) created,
 cast(sum(case when event_type='view' then 1 else 0 end) as bigint) updated,
 cast(sum(case when event_type='click' then 1 else 0 end) as bigint) expired,
 cast(sum(case when event_type='signup' then 1 else 0 end) as bigint) deleted, cast(10 as bigint) skipped,
 cast(sum(case when event_type='error' and value > 200 then 1 else 0 end) as bigint) errors,
 count(distinct user_id) unique_companies, count(distinct event_type) unique_states,
 cast(sum(case when user_id % 2 = 0 then 1 else 0 end) as bigint) ai_calls_made,
 cast(sum(case when user_id % 3 = 0 then 1 else 0 end) as bigint) ai_calls_skipped
from events group by cast(ts as date)
""")

VIEWS["history_facts"] = ([], """
with c as (
 select cast(cast(ts as date) as timestamp) run_ts, concat('Company ', cast(user_id as {S})) name, count(*) n, min(user_id) u
 from events group by 1, 2),
r as (select run_ts, name, n, row_number() over (partition by run_ts order by n desc, u) rk from c)
select run_ts, 'top_company' kind, name, n, cast(rk as int) rank from r where rk <= 10
union all
select cast(cast(ts as date) as timestamp), 'state', concat('State ', cast(user_id % 60 as {S})), cast(count(*) as bigint), cast(null as int)
from events where value > 50 group by 1, 3
union all
select cast(cast(ts as date) as timestamp), 'unmatched', concat('Odd ', cast(user_id % 17 as {S})), cast(null as bigint), cast(null as int)
from events where event_type = 'error' group by 1, 3
""")

VIEWS["run_log"] = ([], """
select cast(cast(ts as date) as timestamp) started_at, case when max(event_id) % 5 = 0 then 'failure' else 'success' end conclusion
from events group by 1
""")

VIEWS["log_lines"] = ([], """
select event_id, concat('[', cast(cast(ts as date) as {S}), '] ',
 case event_type when 'error' then 'ERROR' when 'click' then 'Warn' when 'view' then 'failure' else 'INFO' end,
 ' user ', cast(user_id as {S}), case when event_id % 50 = 0 then ' exception raised' else ' ok' end) value
from events
""")

# detected links: pattern number -> (detector name, URL around {T}, provider, token, board URL); NULL = dropped
DETECTIONS: list[tuple[str, str, str | None, str, str]] = [
    ("Paylocity", "https://recruiting.paylocity.com/recruiting/jobs/Details/{T}", None, "", ""),
    ("Paylocity", "https://recruiting.paylocity.com/Recruiting/Jobs/All/G{T}/x", "paylocity", "board:all:g{T}",
     "https://recruiting.paylocity.com/recruiting/jobs/all/G{T}"),
    ("Ashby", "https://jobs.ashbyhq.com/Org{T}/abc", "ashby", "Org{T}", "https://jobs.ashbyhq.com/Org{T}/abc"),
    ("Ashby (beta)", "https://jobs.ashbyhq.com/org{T}", None, "", ""),
    ("Workable", "https://apply.workable.com/j/{T}", "workable", "", "https://apply.workable.com/j/{T}"),
    ("Workable", "https://apply.workable.com/acct{T}/?x=1#top", "workable", "acct{T}",
     "https://apply.workable.com/acct{T}/?x=1#top"),
    ("SmartRecruiters", "https://jobs.smartrecruiters.com/?dcr_ci=Co{T}", "smartrecruiters", "Co{T}",
     "https://jobs.smartrecruiters.com/?dcr_ci=Co{T}"),
    ("SmartRecruiters", "https://careers.smartrecruiters.com/company/In{T}/jobs", "smartrecruiters", "In{T}",
     "https://careers.smartrecruiters.com/company/In{T}/jobs"),
    ("SmartRecruiters", "https://jobs.smartrecruiters.com/oneclick-ui/{T}", None, "", ""),
    ("Breezy HR", "https://Shop{T}.breezy.hr/p/1", "breezy", "shop{T}", "https://shop{T}.breezy.hr/p/1"),
    ("Breezy HR", "https://app.breezy.hr/p/{T}", None, "", ""),
    ("Zoho Recruit", "https://zo{T}.zohorecruit.com/careers", "zoho", "zo{T}", "https://zo{T}.zohorecruit.com/careers"),
    ("JobScore", "https://careers.jobscore.com/careers/sc{T}/jobs", "jobscore", "sc{T}",
     "https://careers.jobscore.com/careers/sc{T}/jobs"),
    ("JobScore", "https://widgets.jobscore.com/jobs/wi{T}/widget_iframe", "jobscore", "wi{T}",
     "https://widgets.jobscore.com/jobs/wi{T}/widget_iframe"),
    ("Workday", "https://t{T}.wd5.myworkdayjobs.com/en-US/Site{T}/job/1", "workday", "",
     "https://t{T}.wd5.myworkdayjobs.com/Site{T}"),
    ("Workday", "https://t{T}.wd5.myworkdayjobs.com/", None, "", ""),
    ("UltiPro", "https://recruiting2.ultipro.com/CO{T}/Openings/b0-{T}/?q=1", "ultipro", "",
     "https://recruiting2.ultipro.com/CO{T}/Openings/b0-{T}/"),
    ("UltiPro", "https://other.ultipro.com/CO{T}", None, "", ""),
    ("iCIMS", "https://careers-{T}.icims.com/jobs/intro?hashed=h{T}", "icims", "",
     "https://careers-{T}.icims.com/jobs/search?ss=1&hashed=h{T}"),
    ("Freshteam", "https://fr{T}.freshteam.com/jobs/abc", "freshteam", "fr{T}", "https://fr{T}.freshteam.com/jobs"),
    ("Jobvite", "https://jobs.jobvite.com/jv{T}/job/o1", "jobvite", "jv{T}", "https://jobs.jobvite.com/jv{T}/jobs"),
    ("Jobvite", "https://jobs.jobvite.com/support/{T}", None, "", ""),
    ("TriNet Hire", "https://app.trinethire.com/companies/{T}-co/jobs", "trinethire", "{T}-co",
     "https://app.trinethire.com/companies/{T}-co/jobs"),
    ("Ashby", "https://nam02.safelinks.protection.outlook.com/?url=https%3A%2F%2Fjobs.ashbyhq.com%2Fsafe{T}&data=1",
     "ashby", "safe{T}", "https://jobs.ashbyhq.com/safe{T}"),
    ("Zoho Recruit", "https://urldefense.com/v3/__https:/ud{T}.zohorecruit.com/jobs__;!!x", "zoho", "ud{T}",
     "https://ud{T}.zohorecruit.com/jobs"),
    ("Unknown ATS", "https://example.com/{T}", None, "", ""),
]


def _case(values: list[str]) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case cast((s_suppkey * 2 + det) % {len(values)} as int) {whens} end"


def around_token(text: str | None) -> str:
    """SQL for a text with the firm number in place of {T}."""
    if text is None:
        return "cast(null as {S})"
    parts = [f"'{p}'" for p in text.split("{T}")]
    return "concat(" + ", cast(s_suppkey as {S}), ".join(parts) + ")"


VIEWS["site_detection"] = ([], f"""
select cast(s_suppkey as bigint) firm_ord, lower(replace(s_name, '#', '')) firm_key,
 case when s_suppkey % 4 = 0 then '' else s_name end firm_name, cast(det as bigint) det_ord,
 {_case([f"'{d[0]}'" for d in DETECTIONS])} ats, {_case([around_token(d[1]) for d in DETECTIONS])} url
from (select *, 0 det from supplier union all select *, 1 det from supplier) x
""")

VIEWS["source_seed"] = ([], """
select cast(c_custkey as bigint) ord, concat('Firm ', cast(c_custkey as {S})) company_name,
 case cast(c_custkey % 4 as int) when 0 then 'ashby' when 1 then 'workable' when 2 then 'icims' else 'workday' end provider,
 case cast(c_custkey % 4 as int) when 0 then concat('Org', cast(c_custkey % 100 as {S}))
   when 1 then case when c_custkey % 8 = 1 then '' else concat('ACCT', cast(c_custkey % 50 as {S})) end else '' end token,
 case cast(c_custkey % 4 as int) when 2 then concat('https://c', cast(c_custkey % 30 as {S}), '.icims.com/jobs/search?ss=1&pr=',
   cast(c_custkey % 2 as {S})) else concat('https://S', cast(c_custkey % 40 as {S}), '.myworkdayjobs.com/Site/') end source_url
from customer
""")


def with_views(names: list[str], body: str, string: str, given: tuple[str, ...] = ()) -> str:
    """``body`` with the named tables (and what they need) as common table expressions.

    Tables in ``given`` exist already.
    """
    order: list[str] = []

    def add(name: str) -> None:
        if name in order or name in given:
            return
        for dep in VIEWS[name][0]:
            add(dep)
        order.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} as ({VIEWS[n][1].replace('{S}', string).strip()})" for n in order)
    body = body.replace("{S}", string).strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    return f"with {ctes},\n{body[5:]}" if body.lower().startswith("with ") else f"with {ctes}\n{body}"
