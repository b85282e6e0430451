"""The same results as ``checks.queries``, as SQL for DuckDB.

Written from the rules, not from the Spark code: look-arounds become ``\\b``,
aggregates with join-back become window functions, the similarity join becomes
a brute-force comparison.
"""

from __future__ import annotations

from checks.queries import RANKING
from checks.views import DETECTIONS, RUN_TS, _case, around_token, with_views
from hirestream import config as C

ORACLE: dict[str, str] = {}
RUN = f"timestamp '{RUN_TS}'"
WS = r"[\t\n\v\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def add(name: str, views: str, body: str) -> None:
    ORACLE[name] = with_views(views.split(), body, "varchar")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(x: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {to}, 'g')"


def trim(x: str) -> str:
    return rx(x, f"^{WS}+|{WS}+$")


def norm_key(x: str) -> str:
    return f"trim({rx(rx(f'lower({x})', '[^a-z0-9 ]'), ' +', repr(' '))})"


def squeeze(x: str) -> str:
    return rx(x, f"{WS}+", "' '")


def norm_firm(x: str) -> str:
    bare = rx(f"lower({x})", "[,.]")
    return trim(squeeze(rx(bare, rf"\b({'|'.join(C.SUFFIXES_FIRM)})\b")))


def norm_company(x: str, suffixes: list[str] = C.SUFFIXES_COMPANY) -> str:
    return trim(squeeze(rx(f"lower({x})", rf"[,.]|(\b({'|'.join(suffixes)})\b)")))


def fp(t: str = "") -> str:
    return f"concat({norm_key(t + 'company')}, '|', {norm_key(t + 'title')}, '|', {norm_key(t + 'location')})"


def case(pairs: list[tuple[str, str]], default: str = "null") -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in pairs) + f" else {default} end"


def has(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def count(x: str, words: list[str]) -> str:
    return "(" + " + ".join(f"(contains({x}, {q(w)}))::int" for w in words) + ")"


def role(t: str = "title", d: str = "description") -> str:
    pairs = [(has(f"lower({t})", w), q(k)) for k, w in C.ROLE_TITLE_KEYWORDS.items()]
    pairs.append((f"{count(f'lower({d})', C.ROLE_DESCRIPTION_KEYWORDS)} >= 2", "'operations'"))
    return case(pairs)


SIGNALS = " or ".join(f"{count('lower(description)', w)} >= 2" for w in C.INDUSTRY_SIGNALS.values())


def canon(x: str) -> str:
    t = trim(x)
    names = ", ".join(q(p) for p in C.TRACKING_PARAMS)
    base = f"lower(regexp_extract({t}, '^(https?://[^/?#]+)', 1))"
    path = f"rtrim(regexp_extract({t}, '^https?://[^/?#]+([^?#]*)', 1), '/')"
    search = (
        f"array_to_string(list_transform(list_filter(string_split(regexp_extract({t}, '^[^?#]*\\?([^#]*)', 1), '&'), "
        f"lambda p: p <> '' and split_part(p, '=', 1) not in ({names})), "
        "lambda p: case when contains(p, '=') then p else concat(p, '=') end), '&')"
    )
    return (
        f"case when {t} = '' then '' else concat({base}, coalesce(nullif({path}, ''), '/'), "
        f"case when {search} <> '' then concat('?', {search}) else '' end) end"
    )


def completeness() -> str:
    return (
        f"(case when {trim('description')} <> '' then least(length(description), 5000) else 0 end"
        f" + case when {trim('location')} <> '' then 25 else 0 end + case when salary_min is not null then 50 else 0 end"
        " + case when salary_max is not null then 50 else 0 end + case when coalesce(contract_type, '') <> '' then 10 else 0 end"
        " + case when coalesce(contract_time, '') <> '' then 10 else 0 end)"
    )


# --- duplicates: reusable steps ------------------------------------------------

FP_STEP = f"""
w01a as (select *, {fp()} fp from listings),
w01b as (select *, count(*) over (partition by fp, source) c from w01a),
w01c as (select *, max(c) over (partition by fp) mc, min(ord) over (partition by fp) fo,
  row_number() over (partition by fp order by length(description) desc, ord) rn from w01b),
w01 as (select * exclude (fp, c, mc, rn, fo), fo seq_a, ord seq_b from w01c where case when mc > 1 then c > 1 else rn = 1 end)"""


def url_step(source: str, out: str = "w02") -> str:
    return f"""
{out}a as (select *, {canon('source_url')} k, {completeness()} sc from {source}),
{out}b as (select *, row_number() over (partition by k order by sc desc, seq_a, seq_b) rn,
  first_value(seq_a) over (partition by k order by seq_a, seq_b) fa, first_value(seq_b) over (partition by k order by seq_a, seq_b) fb from {out}a),
{out} as (select * exclude (k, sc, rn, fa, fb, seq_a, seq_b), case when k = '' then seq_a else fa end seq_a,
  case when k = '' then seq_b else fb end seq_b from {out}b where k = '' or rn = 1)"""


DEDUP = FP_STEP + "," + url_step("w01")
LIST = "ord, title, company, location, source_url, source"

add("fingerprint_dedup", "listings", f"with {FP_STEP} select {LIST}, description, seq_a, seq_b from w01")
add("url_dedup", "listings", f"with s as (select *, ord seq_a, ord seq_b from listings), {url_step('s')} select {LIST}, description, seq_a, seq_b from w02")
add("url_dedup_pages", "", f"""with s as (select page_id ord, html description, '' as location, url source_url, null salary_min, null salary_max,
 '' contract_type, '' contract_time, page_id seq_a, page_id seq_b from pages), {url_step('s')} select ord, source_url, seq_a, seq_b from w02""")
add("dedup_both", "listings", f"with {DEDUP} select ord, seq_a, seq_b from w02")
SEED = "concat(lower(regexp_extract(source_url, '^(https://[^/]+)', 1)), coalesce(nullif(rtrim(regexp_extract(source_url, '^https://[^/]+([^?]*)', 1), '/'), ''), '/'), regexp_extract(source_url, '(\\?.*)$', 1))"
add("canonical_seed", "source_seed", f"select ord, {SEED} seed from source_seed")
add("seed_dedup", "source_seed", f"""with k as (select *, case provider when 'ashby' then token when 'workable' then coalesce(nullif(token, ''), {SEED}) else {SEED} end sk from source_seed)
select ord, company_name, provider, token from (select *, row_number() over (partition by provider, lower(trim(sk)) order by ord) rn from k where trim(sk) <> '') where rn = 1""")
add("firm_dedup", "firm_csv", f"select ord, name from (select *, row_number() over (partition by {norm_company('name', C.SUFFIXES_BUILD)} order by ord) rn from firm_csv) where rn = 1")
add("posting_dedup", "listings", f"select {LIST} from (select *, row_number() over (partition by company, title, location order by ord) rn from listings) where rn = 1")

# --- filters -------------------------------------------------------------------

add("role_filter", "listings", f"select ord, title, {role()} role_category from listings where {role()} is not null")
add("industry_signal_filter", "listings", f"select ord, company from listings where {SIGNALS}")

# brute-force firm match per distinct company
MATCH = f"""
co as (select distinct company, {norm_firm('company')} cn from listings),
fi as (select firm_ord, {norm_firm('name')} fn, case when alias <> '' then {norm_firm('alias')} end an from firm),
fm as (select company, min(firm_ord) firm_ord from co join fi on fn = cn or an = cn
  or case when greatest(length(fn), length(cn)) = 0 then true else 1 - levenshtein(fn, cn)::double / greatest(length(fn), length(cn)) >= 0.85 end group by 1)"""
add("firm_match_exact", "listings firm", f"""with co as (select distinct company, {norm_firm('company')} cn from listings),
fi as (select firm_ord, {norm_firm('name')} fn from firm union all select firm_ord, {norm_firm('alias')} from firm where alias <> '')
select company, min(firm_ord) firm_ord from co join fi on fn = cn group by 1""")
add("firm_match_fuzzy", "listings firm", f"with {MATCH} select company, firm_ord from fm")
add("firm_match_fuzzy_suppliers", "", f"""with s as (select s_suppkey firm_ord, concat('Merchant ', lpad(s_suppkey::varchar, 9, '0'), ' Trading Ltd') as name from supplier),
cu as (select distinct concat('Mercant ', lpad((c_custkey * 7)::varchar, 9, '0'), ' Trading') company from customer),
a as (select firm_ord, {norm_firm('name')} fn from s), b as (select company, {norm_firm('company')} cn from cu)
select company, min(firm_ord) firm_ord from a join b on 1 - levenshtein(fn, cn)::double / greatest(length(fn), length(cn)) >= 0.85 group by 1""")
ALLOW = f"al as (select distinct {norm_key('company')} k from listings where ord % 9 = 0)"
add("firm_gate", "listings firm", f"""with {MATCH}, {ALLOW},
g as (select l.ord, l.company, f.firm_ord, f.name firm_name, f.industry firm_industry, f.firm_rank,
 case when fm.firm_ord is not null then 'firm' when al.k is not null then 'allow_list' when {SIGNALS.replace('description', 'l.description')} then 'signals' end gate
 from listings l left join fm on fm.company = l.company left join firm f on f.firm_ord = fm.firm_ord left join al on al.k = {norm_key('l.company')})
select ord, company, gate, firm_ord, firm_name, firm_industry, firm_rank from g where gate is not null""")
PROV = ", ".join(q(p) for p in [*C.PROVIDERS, "other"])
add("provider_subset", "listings", f"select ord, source from (select ord, [{PROV}][(ord % 16 + 1)::int] source from listings) where source in ('lever', 'icims')")
add("ttl_valid", "board_cache", f"select * from board_cache where detected_at > {RUN} - interval 30 day")
add("drop_incomplete", "listings", "select ord, title from listings where ord % 7 <> 0 and ord % 5 <> 0")
ERR, WARN = r"(?i)\b(error|fail|exception)\b", r"(?i)\b(warn|warning)\b"
LOGCLASS = f"case when regexp_matches(value, {q(ERR)}) then 'error' when regexp_matches(value, {q(WARN)}) then 'warn' else 'info' end"
add("log_filter_errors", "log_lines", f"select event_id, value, {LOGCLASS} line_class from log_lines where regexp_matches(value, {q(ERR)})")
add("log_filter_all", "log_lines", f"select {LOGCLASS} line_class, count(*) n from log_lines group by 1")
add("row_error_isolation", "listings", "select case when ord % 6 = 0 then 'bad_date' when starts_with(title, 'Data') then 'title' else 'none' end row_error, count(*) n, min(ord) first_ord from listings group by 1")

# --- lookups ---------------------------------------------------------------------

RANK_ROWS = ", ".join(f"({i}, {r}, {q(n)})" for i, (r, n) in enumerate(RANKING))
RANKS = f"""
rk as (select i, r, {norm_company('n')} n from (values {RANK_ROWS}) v(i, r, n)),
cr as (select company, arg_min(r, i) company_rank from (select distinct company, {norm_company('company')} c from listings) x join rk on contains(c, n) or contains(n, c) group by 1)"""
add("allow_list_semi", "listings", f"with {ALLOW} select ord, company from listings where {norm_key('company')} in (select k from al where k <> '')")
add("rank_lookup", "listings", f"with {RANKS} select ord, l.company, company_rank as rank from listings l left join cr on cr.company = l.company")
WAGE_ROWS = ", ".join(
    f"({q(soc)}, {q('' if m == 'National' else m)}, {float(lo)}, {float(hi)})"
    for soc, (_, by_metro) in C.WAGES.items() for m, (lo, hi) in by_metro.items()
)
SOC = case(
    [("contains(lower(title), 'architect') and not contains(lower(title), 'data architect')", q(C.OCCUPATION_ARCHITECT)),
     (has("lower(title)", ["civil", "structural", "engineer"]), q(C.OCCUPATION_ENGINEER)),
     *[(f"role_category = {q(r)}", q(s)) for r, s in C.OCCUPATION_BY_ROLE.items()]], q(C.OCCUPATION_DEFAULT))
METRO = case([(has("lower(location)", w), q(m)) for m, w in C.METRO_PATTERNS])


def salary(source: str) -> str:
    return f"""
wg as (select * from (values {WAGE_ROWS}) v(soc, metro, p25, p75)),
sa0 as (select *, {SOC} soc, {METRO} metro, coalesce(salary_min, 0) = 0 or coalesce(salary_max, 0) = 0 need from {source}),
sa as (select s.* exclude (salary_min, salary_max, need), case when need then coalesce(m.p25, n.p25) else s.salary_min end salary_min,
 case when need then coalesce(m.p75, n.p75) else s.salary_max end salary_max, need or salary_is_predicted salary_estimated
 from sa0 s left join wg m on m.soc = s.soc and m.metro = s.metro left join wg n on n.soc = s.soc and n.metro = '')"""


add("salary_estimate", "listings", f"with r as (select *, {role()} role_category from listings where {role()} is not null), {salary('r')} select ord, soc, metro, salary_min, salary_max, salary_estimated from sa")
VALID = f"va as (select * from enrichment where fetched_at > {RUN} - interval 30 day)"
add("company_enrich", "listings enrichment", f"""with {VALID} select ord, company, va.company_key is not null has_enrichment, employee_count enr_employee_count, industry enr_industry, hq enr_hq
from listings l left join va on va.company_key = {norm_company('l.company')}""")
add("enrichment_worklist", "listings enrichment", f"""with {VALID} select company_key, company from (select {norm_company('company')} company_key, arg_min(company, ord) company from listings group by 1)
where company_key not in (select company_key from va)""")
add("mark_existing", "listings published", "select ord, source_url in (select source_url from published) already_published from listings")
CKEY = "md5(concat(company, '|', title, '|', substring(description, 1, 500)))"


def hits(source: str) -> str:
    return f"""
ct as (select * from company_texts where generated_at > {RUN} - interval 365 day),
hi as (select s.*, {CKEY.replace('company', 's.company').replace('title', 's.title').replace('description,', 's.description,')} content_key, {norm_key('s.company')} ckey from {source} s),
hs as (select h.*, r.role_summary is not null role_hit, ct.company_key is not null company_hit, r.role_summary rs, ct.description cd
 from hi h left join role_texts r on r.content_key = h.content_key left join ct on ct.company_key = h.ckey)"""


add("cache_hit_split", "listings role_texts company_texts", f"""with {hits('listings')} select ord, role_hit, company_hit, 2 - role_hit::int - company_hit::int calls_needed, role_hit::int + company_hit::int calls_skipped,
case when role_hit and company_hit then rs else '' end role_summary, case when role_hit and company_hit then cd else '' end company_description from hs""")
add("generation_worklist", "listings role_texts company_texts enrichment", f"""with {hits('listings')}, {VALID},
t as (select * from hs where ord % 4 <> 0),
k as (select 'role' task, content_key task_key, ord, company, title, substring(description, 1, 2000) description,
  row_number() over (partition by content_key order by ord) rn from t where not role_hit
 union all select 'company', ckey, ord, company, null, null, row_number() over (partition by ckey order by ord) from t where not company_hit)
select task, task_key, ord, company, title, description, coalesce(va.industry, '') firm_type_text, coalesce(va.employee_count, '') size_text,
 coalesce(va.hq, '') hq_text, coalesce(va.founded, '') founded, coalesce(va.summary, '') summary
from k left join va on va.company_key = {norm_company('k.company')} where rn = 1""")
FK = f"fk as (select *, {norm_key('name')} firm_key, row_number() over (partition by {norm_key('name')} order by ord) rn from firm_csv)"
VB = f"vb as (select * from board_cache where detected_at > {RUN} - interval 30 day)"
add("board_seed_join", "firm_csv board_cache", f"with {FK}, {VB} select ord, name company_name, firm_key, provider, board_token from fk join vb using (firm_key) where rn = 1 and provider in ('greenhouse', 'lever')")


def slug_rows(cand: str) -> str:
    return f"""cand as ({cand}),
sl as (select *, {rx(rx("lower(name)", rf"\b({'|'.join(C.SUFFIXES_FIRM)})\b"), '[^a-z0-9 ]')} b,
 regexp_replace(regexp_replace(lower(website), '^www\\.', ''), '\\.(com|org|net|io|co|us|ca|uk).*$', '') d from cand),
s3 as (select ord, firm_key, replace(b, ' ', '') a1, {rx("replace(b, ' ', '-')", '^-|-$')} a2, case when length(d) > 2 then d end a3 from sl),
s4 as (select ord, firm_key, a1 slug, 1 p from s3 where a1 <> '' union all select ord, firm_key, a2, 2 from s3 where a2 <> '' and a2 <> a1
 union all select ord, firm_key, a3, 3 from s3 where a3 is not null and a3 <> a1 and a3 <> a2),
sr as (select ord, firm_key, slug, row_number() over (partition by ord order by p) - 1 slug_ord from s4)"""


add("probe_worklist", "firm_csv board_cache", f"with {FK}, {VB}, {slug_rows('select * from fk where rn = 1 and firm_key not in (select firm_key from vb)')} select ord, firm_key, slug_ord, slug from sr")
add("resolve_boards", "firm_csv board_cache", f"""with {FK}, {slug_rows('select * from fk')},
kn as (select distinct case when s_suppkey % 2 = 0 then 'greenhouse' else 'lever' end provider, case when s_suppkey % 5 = 0 then concat('supplier', s_suppkey)
 when s_suppkey % 3 = 0 then lower(replace(s_name, '#', '')) else 'nosuch' end slug from supplier),
h as (select sr.*, provider, row_number() over (partition by firm_key order by provider is null, provider, slug_ord) r from sr left join kn using (slug))
select firm_key, coalesce(provider, 'none') provider, case when provider is null then '' else slug end board_token from h where r = 1""")

# --- derived columns ----------------------------------------------------------------

ABBR = ", ".join(f"{q(k)}: {q(v)}" for k, v in C.STATES.items())
FULL = ", ".join(q(v) for v in C.STATES.values())
LOWER = ", ".join(f"{q(v.lower())}: {q(v)}" for v in C.STATES.values())
NAMES = "|".join(C.STATES.values())


def clean(p: str) -> str:
    return trim(rx(rx(p, r"\(.*?\)"), r"\b\d{5}(-\d{4})?\b"))


def state(c: str) -> str:
    ab = f"map {{{ABBR}}}"
    return (
        f"coalesce({ab}[upper({c})], case when {c} in ({FULL}) then {c} end, {ab}[upper(regexp_extract({c}, '(?i)^([A-Z]{{2}})\\b', 1))], "
        f"map {{{LOWER}}}[lower(regexp_extract({c}, '(?i)^({NAMES})', 1))])"
    )


def location(source: str, col: str, pre: str = "lo") -> str:
    t = trim(col)
    bare = trim(rx(rx(rx(t, r"(?i)\([^)]*\b(remote|hybrid)\b[^)]*\)"), r"(?i)\b(remote|hybrid)\b"), rf"^[\-–—,;{WS[1:-1]}]+|[\-–—,;{WS[1:-1]}]+$"))
    return f"""
{pre}a as (select *, list_filter(list_transform(string_split(replace({bare}, ';', ','), ','), lambda p: {trim('p')}),
  lambda p: p <> '' and not regexp_matches(p, '(?i)^(united states|us|usa)$')) ps from {source}),
{pre}b as (select *, list_transform(ps, lambda p: {clean('p')}) cs from {pre}a),
{pre}c as (select *, list_transform(cs, lambda c: {state('c')}) ss from {pre}b),
{pre}d as (select *, list_max(list_transform(range(1, len(ss) + 1), lambda i: case when ss[i] is not null then i end)) mx from {pre}c),
{pre} as (select * exclude (ps, cs, ss, mx), regexp_matches({t}, '(?i)\\b(remote|hybrid)\\b') lo_remote,
 case when mx is not null then ss[mx] when len(cs) > 1 then cs[len(cs)] else '' end lo_state,
 array_to_string(list_filter(list_transform(range(1, len(cs) + 1), lambda i: case when i = coalesce(mx, case when len(cs) > 1 then len(cs) else 0 end) then '' else cs[i] end), lambda p: p <> ''), ', ') lo_city from {pre}d)"""


add("structured_location", "listings", f"with {location('listings', 'location')} select ord, location, lo_city job_city, lo_state job_state, lo_remote is_remote from lo")
ALIASES = sorted([(a.lower(), k) for k, v in C.INDUSTRY_ALIASES.items() for a in [*v, k]], key=lambda p: -len(p[0]))


def industry(x: str) -> str:
    key = f"lower({trim(x)})"
    pairs = [(f"{key} = ''", "null")] + [(f"{key} = {q(a)}", q(k)) for a, k in ALIASES]
    pairs += [(f"contains({key}, {q(a)}) or contains({q(a)}, {key})", q(k)) for a, k in ALIASES]
    return case(pairs)


add("add_industry", "firm", f"""with r as (select firm_ord, coalesce(case when firm_ord % 7 <> 0 then industry end, '{C.DEFAULT_INDUSTRY}') raw from firm),
m as (select *, {industry('raw')} mi from r) select firm_ord, coalesce(mi, raw) industry, mi matched_industry from m""")
add("normalize_industry", "firm_csv enrichment", f"""with r as (select ord, industry from firm_csv union all select length(company_key), industry from enrichment)
select ord, industry, coalesce({industry('industry')}, {trim('industry')}) canonical from r""")
add("unmatched_industries", "enrichment", f"select distinct industry from enrichment where {industry('industry')} is null and industry <> ''")
LEVEL_RX = [("Senior", r"\b(senior|sr\.?|lead|principal)\b"), ("Director", r"\b(director|vp|vice president|chief|head of)\b"),
            ("Junior", r"\b(junior|jr\.?|entry[- ]level|associate)\b"), ("Mid-Level", r"\b(mid[- ]level|intermediate)\b"),
            ("Entry-Level", r"\b(assistant|coordinator)\b")]
LEVEL = case([(f"regexp_matches(title, {q('(?i)' + r)})", q(k)) for k, r in LEVEL_RX], "''")
add("experience_level", "listings", f"with t as (select ord, concat(title, case when ord % 3 = 0 then ' / Sr. Associate, entry-level' else '' end) title from listings) select ord, title, {LEVEL} experience_level from t")
TOOLS = "array_to_string(list_filter([" + ", ".join(
    f"case when regexp_matches(description, {q(r'(?i)\b' + t.replace('.', chr(92) + '.') + r'\b')}) then {q(t)} end" for t in C.TOOLS
) + "], lambda x: x is not null), ', ')"
add("extract_tools", "listings", f"select ord, {TOOLS} tools_mentioned from listings")
add("employee_band", "", "select p_partkey, " + case(
    [("p_partkey * 4 = 0", "''"), *[(f"p_partkey * 4 < {b}", q(label)) for b, label in C.EMPLOYEE_BANDS]], q(C.EMPLOYEE_BAND_TOP)) + " band from part")


def slug(title: str = "title", company: str = "company", loc: str = "location") -> str:
    s = f"replace(lower(concat({title}, ' at ', {company}, ' ', {loc})), '&', 'and')"
    s = rx(s, rf"[^a-z0-9\-{WS[1:-1]}]")
    s = rx(rx(rx(s, f"{WS}+", "'-'"), "-+", "'-'"), "^-|-$")
    head = f"left({s}, 80)"
    cut = f"length({head}) - strpos(reverse({head}), '-')"
    return f"case when length({s}) > 80 then case when strpos({head}, '-') > 0 and {cut} > 48 then left({head}, {cut}) else {head} end else {s} end"


add("slug_base", "listings", f"select ord, {slug()} slug_base from listings")

AMP = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]
FEED = [("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " ")]
PAGE = [*FEED[:-1], ("&#x2F;", "/"), FEED[-1]]
BLOCKS = {"A": "p|div|li|h[1-6]|tr", "B": "p|div|li|h[1-6]|tr|ul|ol|span|table|tbody|thead|section|article",
          "C": "p|div|li|h[1-6]|tr|ul|ol", "D": "p|div|li|h[1-6]|tr|ul|ol|span"}


def decode(x: str, table: list[tuple[str, str]] = PAGE) -> str:
    for a, b in table:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def untag(x: str, blocks: str) -> str:
    x = rx(x, rf"(?i)<br{WS}*/?>", "chr(10)")
    return rx(rx(x, f"(?i)</?({blocks})[^>]*>", "chr(10)"), "<[^>]+>")


def tidy(x: str) -> str:
    return trim(rx(x, "\\n{3,}", "concat(chr(10), chr(10))"))


def html(x: str, v: str) -> str:
    if v == "A":
        return tidy(decode(untag(x, BLOCKS["A"]), AMP))
    return tidy(untag(decode(x, FEED if v == "D" else PAGE), BLOCKS[v]))


add("html_text_variants", "", "select page_id, " + ", ".join(f"{html('html', v)} text_{v.lower()}" for v in "ABCD") + " from pages")


def protocol(x: str) -> str:
    t = trim(f"coalesce({x}, '')")
    return f"case when {t} = '' then '' when regexp_matches({t}, '(?i)^https?://') then {t} else concat('https://', {t}) end"


add("ensure_protocol_urls", "firm_csv", f"select ord, {protocol('website')} website, {protocol('linkedin')} linkedin from firm_csv")

# --- the enriched table ---------------------------------------------------------------

TOOLN = "len(list_filter(string_split(tools_mentioned, ','), lambda x: x <> ''))"
SCORE = f"""(case when salary_min <> 0 and salary_max <> 0 then case when salary_estimated then 5 else 15 end else 0 end
 + case when firm_ord is not null then 15 else 0 end + case when has_enrichment then 10 else 0 end + case when coalesce(rank, 0) <> 0 then 10 else 0 end
 + case when length(description) > 500 then 10 else 0 end + case when length(description) > 1500 then 5 else 0 end
 + case when {TOOLN} >= 1 then 5 else 0 end + case when {TOOLN} >= 3 then 5 else 0 end
 + case when experience_level <> '' then 5 else 0 end + case when contains(location, ',') then 5 else 0 end)"""
ENRICHED = f"""{DEDUP},
rl as (select *, {role()} role_category from w02 where {role()} is not null), {MATCH}, {RANKS}, {VALID},
gt as (select r.*, f.firm_ord, f.name firm_name, f.firm_type, f.industry firm_industry, f.firm_rank, f.hq firm_hq, f.hq_state firm_hq_state, f.hq_city firm_hq_city, f.size firm_size,
  f.website firm_website, f.linkedin firm_linkedin, coalesce(f.firm_rank, cr.company_rank) as rank, va.company_key is not null has_enrichment, va.industry enr_industry,
  va.hq enr_hq, va.employee_count enr_employee_count, case when fm.firm_ord is not null then 'firm' when {SIGNALS.replace('description', 'r.description')} then 'signals' end gate
 from rl r left join fm on fm.company = r.company left join firm f on f.firm_ord = fm.firm_ord left join cr on cr.company = r.company
 left join va on va.company_key = {norm_company('r.company')}),
gg as (select * from gt where gate is not null), {salary('gg')},
tl as (select *, {TOOLS} tools_mentioned, {LEVEL} experience_level from sa),
ps as (select *, {SCORE} pre_score, source_url in (select source_url from published) already from tl),
tg as (select *, case when pre_score < 45 then 'low_quality' when already then 'existing' else 'generate' end text_gate from ps), {hits('tg')},
tx as (select *, 2 - role_hit::int - company_hit::int calls_needed, role_hit::int + company_hit::int calls_skipped,
 case when role_hit and company_hit and text_gate = 'generate' then rs else '' end role_summary, case when role_hit and company_hit and text_gate = 'generate' then cd else '' end company_description from hs),
qs as (select *, pre_score + case when role_summary <> '' then 5 else 0 end + case when company_description <> '' then 5 else 0 end quality_score,
 case when coalesce(firm_hq_state, '') = '' then coalesce(firm_hq, enr_hq, '') else '' end hq_raw from tx), {location('qs', 'location')},
l1 as (select * exclude (lo_remote, lo_state, lo_city), lo_remote is_remote, lo_state job_state, lo_city job_city from lo), {location('l1', 'hq_raw', 'lh')},
en as (select *, coalesce(nullif(firm_hq_city, ''), lo_city) company_hq_city, coalesce(nullif(firm_hq_state, ''), lo_state) company_hq_state,
 coalesce(firm_industry, enr_industry, '{C.DEFAULT_INDUSTRY}') ind_raw, {protocol('firm_website')} company_website, {protocol('firm_linkedin')} company_linkedin from lh),
enriched as (select *, coalesce({industry('ind_raw')}, ind_raw) industry, {industry('ind_raw')} matched_industry from en)"""
EV = "listings firm enrichment published role_texts company_texts"
SC = ("ord, company, role_category, gate, firm_ord, rank, salary_min, salary_max, salary_estimated, tools_mentioned, experience_level, "
      "pre_score, text_gate, quality_score")
add("enrich_listings", EV, f"with {ENRICHED} select {SC}, job_city, job_state, is_remote, company_hq_city, company_hq_state, industry, company_website, role_summary, company_description from enriched")
add("pre_score", EV, f"with {ENRICHED} select ord, pre_score from enriched")
add("quality_score", EV, f"with {ENRICHED} select ord, quality_score from enriched")
add("text_gate", EV, f"with {ENRICHED} select text_gate, count(*) n from enriched group by 1")
add("publish_filter", EV, f"with {ENRICHED} select ord, quality_score >= 70 is_featured, case when quality_score >= 70 then 'FEATURED' else 'PUBLISH' end publish_status from enriched where quality_score >= 40")
add("match_counters", EV, f"""with {ENRICHED} select count(*) filter (text_gate = 'low_quality') skipped_low_quality, count(*) filter (text_gate = 'existing') skipped_existing,
 count(*) filter (text_gate = 'generate') to_generate, coalesce(sum(calls_needed) filter (text_gate = 'generate'), 0) calls_needed,
 coalesce(sum(calls_skipped) filter (text_gate = 'generate'), 0) calls_cached from enriched""")
add("hq_resolution", "firm", f"""with r as (select *, case when hq_state = '' then hq else '' end raw from firm), {location('r', 'raw')}
select firm_ord, coalesce(nullif(hq_city, ''), lo_city) company_hq_city, coalesce(nullif(hq_state, ''), lo_state) company_hq_state from lo""")
FACTS = f"""{ENRICHED},
tc as (select company, count(*) n, min((seq_a, seq_b)) f from enriched group by 1),
tr as (select company, n, row_number() over (order by n desc, f) rk from tc),
facts as (select 'state' kind, job_state as name, count(*) n, null::int as rank from enriched where job_state <> '' group by 2
 union all select 'category', role_category, count(*), null from enriched group by 2 union all select 'industry', industry, count(*), null from enriched where industry <> '' group by 2
 union all select distinct 'unmatched', industry, null::bigint, null::int from enriched where industry <> '' and matched_industry is null
 union all select 'top_company', company, n, rk from tr where rk <= 10)"""
add("run_facts", EV, f"with {FACTS} select {RUN} run_ts, kind, name, n, rank from facts")
add("run_summary", EV, f"""with {ENRICHED} select {RUN} run_ts, 5000 duration_ms, (select count(*) from listings) total_ingested, 0 after_dedup, count(*) after_filter, 0 after_quality_filter,
 0 created, 0 updated, 0 expired, 0 deleted, 0 skipped, 0 errors, count(distinct company) unique_companies, count(distinct nullif(job_state, '')) unique_states,
 coalesce(sum(calls_needed) filter (text_gate = 'generate'), 0) ai_calls_made, coalesce(sum(calls_skipped) filter (text_gate = 'generate'), 0) ai_calls_skipped from enriched having count(*) > 0""")
ITEM = f"""concat(title, ' at ', company) as name, slug, title job_title, company company_name, location, source_url, date_posted, salary_min, salary_max, salary_estimated,
 coalesce(contract_type, '') contract_type, coalesce(firm_type, '') firm_type, rank firm_rank, coalesce(firm_size, enr_employee_count, '') company_size, coalesce(firm_hq, enr_hq, '') company_hq,
 company_website, company_linkedin, company_hq_state, industry, job_city, job_state, is_remote, role_summary, company_description, tools_mentioned, quality_score, experience_level, role_category,
 quality_score >= 70 is_featured, least({RUN} + interval 7 day, replace(replace(date_posted, 'T', ' '), 'Z', '')::timestamp + interval 60 day) expiration_date, true pipeline_managed"""
add("map_published_item", EV, f"with {ENRICHED}, s as (select *, concat('s-', ord) slug from enriched) select ord, {ITEM} from s")

# --- slugs and publishing ------------------------------------------------------------------


def slugged(source: str) -> str:
    """Row numbers are exact as long as no slug is another slug plus a number."""
    return f"""
sb as (select *, {slug()} slug_base from {source}),
tk as (select arg_max(slug, item_ord) slug from published where source_url <> '' group by source_url),
sn as (select *, row_number() over (partition by slug_base order by seq_a, seq_b) + (slug_base in (select slug from tk))::int n from sb),
slugged as (select * exclude (n), case when n = 1 then slug_base else concat(slug_base, '-', n) end slug from sn)"""


# the loop itself, row after row within each family of slugs that differ in trailing numbers only
FAMILY = "regexp_replace({}, '(-[0-9]+)+$', '')"
add("slug_uniquify_contested", "listings published", f"""with recursive li as (select * replace (case ord % 5 when 0 then '2' when 1 then '3' else '' end as location) from listings),
 sb as (select ord, {slug()} slug_base from li),
 wa as (select *, {FAMILY.format('slug_base')} fam, row_number() over (partition by {FAMILY.format('slug_base')} order by ord) i from sb),
 tk as (select arg_max(slug, item_ord) slug from published where source_url <> '' group by source_url),
 us as (select {FAMILY.format('slug')} fam, list(slug) used from tk where slug <> '' group by 1),
 lo as (
  select fam, 0::bigint i, null::bigint as ord, null::varchar slug_base, null::varchar slug, coalesce(used, []) used from (select distinct fam from wa) left join us using (fam)
  union all
  select wa.fam, wa.i, wa.ord, wa.slug_base, x.slug, list_append(lo.used, x.slug) from lo join wa on wa.fam = lo.fam and wa.i = lo.i + 1,
   lateral (select list_filter(list_transform(range(1, len(lo.used) + 2), lambda k: case when k = 1 then wa.slug_base else wa.slug_base || '-' || k end),
    lambda c: not list_contains(lo.used, c))[1] slug) x)
 select ord, slug_base, slug from lo where i > 0""")
add("slug_uniquify", "listings published", f"with s as (select *, ord seq_a, ord seq_b from listings), {slugged('s')} select ord, slug_base, slug from slugged")


def matched(source: str, merge: bool = True) -> str:
    creator = "first_value(ord) over (partition by fp order by seq_a, seq_b)"
    if not merge:
        creator = "ord"
    return f"""
pu as (select source_url, arg_max(id, item_ord) uid from published where source_url <> '' group by 1),
pf as (select {fp()} fp, count(*) n0, arg_max(id, item_ord) fid from published group by 1),
mb as (select *, {fp()} fp from {source}),
mj as (select mb.*, uid, coalesce(n0, 0) n0, fid from mb left join pu on pu.source_url = mb.source_url left join pf on pf.fp = mb.fp),
mo as (select *, {creator} cr from mj where uid is null),
matched as (select ord, 'update' as action, uid item_id from mj where uid is not null
 union all select ord, case when n0 >= 2 or n0 = 0 and cr = ord then 'create' else 'update' end, case when n0 = 1 then fid when n0 >= 2 then concat('new:', ord) else concat('new:', cr) end from mo)"""


add("match_published", "listings published", f"with {DEDUP}, {matched('w02')} select ord, action, item_id from matched")
add("match_published_no_merge", "listings published", f"with {DEDUP}, {matched('w02', False)} select ord, action, item_id from matched")
POSTED = "replace(replace(date_posted, 'T', ' '), 'Z', '')::timestamp"
add("set_expiration", "listings", f"select ord, least({RUN} + interval 7 day, {POSTED} - interval 1 day * (ord % 90)::int + interval 60 day) expiration_date from listings")
add("expire_items", "published", f"select id item_id, 'unpublish' as action from published where pipeline_managed and expiration_date < {RUN}")
add("delete_items", "published", f"select id item_id, 'delete' as action from published where pipeline_managed and expiration_date < {RUN} - interval 30 day")
APPLIED = f"""b as (select * replace (concat(source_url, 'x') as source_url), ord seq_a, ord seq_b from listings), {matched('b')},
lst as (select item_id, max(ord) ord from matched group by 1),
fresh as (select item_id id, l.source_url, concat('s', l.ord) slug, least({RUN} + interval 7 day, {POSTED} + interval 60 day) expiration_date, true pipeline_managed from lst join listings l using (ord)),
al as (select id, source_url, slug, expiration_date, pipeline_managed from published where id not in (select id from fresh) union all select * from fresh)"""
add("apply_change_set", "listings published", f"""with {APPLIED}
select id, source_url, slug, expiration_date, not (pipeline_managed and expiration_date < {RUN}) live from al where not (pipeline_managed and expiration_date < {RUN} - interval 30 day)""")
# what has gone after the first run is gone in the second, too; live is as of the second
add("update_snapshot", "listings published", f"""with {APPLIED}
select id, source_url, slug, expiration_date, not (pipeline_managed and expiration_date < {RUN} + interval 8 day) live from al
where not (pipeline_managed and expiration_date < {RUN} + interval 8 day - interval 30 day)""")
add("publish_batches", "listings", "select concat('it', ord) item_id, case when ord % 3 = 0 then 'create' else 'update' end as action, row_number() over (order by ord) as position, floor((row_number() over (order by ord) - 1) / 100)::bigint batch_no from listings")
MONEY = "case when {0} is null then '?' else format('{{:,}}', {0}::bigint) end"
add("dry_run_preview", "listings", f"""select ord, ord % 100 quality_score, concat(title, ' at ', company, ' — ', location, case when ord % 100 >= 70 then ' ★ FEATURED' else '' end) headline,
 concat('s-', ord) slug, case when ord % 2 = 0 then 'Revit' else 'none' end tools,
 concat('$', {MONEY.format('salary_min')}, '-$', {MONEY.format('salary_max')}, case when ord % 3 = 0 then ' (est)' else '' end) salary,
 case when ord % 4 = 0 or ord % 6 = 0 then concat('Web: ', case when ord % 4 = 0 then 'https://w' else '—' end, ' | LinkedIn: ', case when ord % 6 = 0 then 'https://l' else '—' end) end links from listings""")
add("job_posting_jsonld", "listings", "select concat('it', ord) id, title, description, company org, 'Texas' region, salary_min pay_min, '2024-01-31T00:00:00Z' valid_through, 'operations' crumb from listings")

# --- firm master data -------------------------------------------------------------------------

FTYPE = case([(has("lower(name)", w), q(k)) for k, w in C.FIRM_TYPES], q(C.FIRM_TYPE_DEFAULT))
BN = lambda x: norm_company(x, C.SUFFIXES_BUILD)
add("build_firms", "firm_csv", f"""with src as (select * replace (concat(name, ([' Architects', ' Civil Engineering', ' Foods', ''])[ord % 4 + 1]) as name) from firm_csv),
f as (select * from (select *, row_number() over (partition by {BN('name')} order by ord) rn from src) where rn = 1),
rk as (select i, r, {BN('n')} n from (values {RANK_ROWS}) v(i, r, n)),
rr as (select ord, arg_min(r, i) r from (select ord, {BN('name')} c from f) x join rk on contains(c, n) or contains(n, c) group by 1)
select f.ord firm_ord, name, {FTYPE} firm_type, coalesce(nullif(coalesce({industry('industry')}, {trim('industry')}), ''), '{C.DEFAULT_INDUSTRY}') industry, rr.r firm_rank,
 coalesce(nullif(array_to_string(list_filter([city, state, case when country <> 'United States' then country else '' end], lambda x: x <> ''), ', '), ''), 'Unknown') hq,
 state hq_state, city hq_city, '' size, website, linkedin from f left join rr on rr.ord = f.ord""")
HQ = "array_to_string(list_filter([city, state], lambda x: x <> ''), ', ')"
FIELDS = {"website": "website", "linkedin": "linkedin", "hq": "lhq", "hq_state": "state", "hq_city": "city", "industry": "industry"}
MERGE = f"""
ls as (select *, {norm_firm('name')} k, {HQ} lhq, row_number() over (partition by {norm_firm('name')} order by ord) rn from firm_csv where name <> ''),
ex as (select *, {norm_firm('name')} k from firm_old),
fv as (select k, count(*) cnt, min(ord) first_ord, arg_min(name, ord) fname, {", ".join(f"arg_min({c}, ord) filter ({c} <> '') v_{f}, min(ord) filter ({c} <> '') o_{f}, arg_min({c}, ord) f_{f}" for f, c in FIELDS.items())} from ls group by 1)"""
add("merge_firms", "firm_csv firm_old", f"""with {MERGE}
select false is_new, firm_ord merge_ord, name, firm_type, case when industry = '' then coalesce({industry('v_industry')}, v_industry, '') else industry end industry, firm_rank,
 coalesce(nullif(hq, ''), v_hq, '') hq, coalesce(nullif(hq_state, ''), v_hq_state, '') hq_state, coalesce(nullif(hq_city, ''), v_hq_city, '') hq_city, size,
 coalesce(nullif(website, ''), v_website, '') website, coalesce(nullif(linkedin, ''), v_linkedin, '') linkedin from ex left join fv on fv.k = ex.k
union all
select true, first_ord, fname, '{C.FIRM_TYPE_DEFAULT}', coalesce({industry('f_industry')}, nullif(f_industry, ''), '{C.DEFAULT_INDUSTRY}'), null, coalesce(v_hq, ''), coalesce(v_hq_state, ''),
 coalesce(v_hq_city, ''), '', coalesce(v_website, ''), coalesce(v_linkedin, '') from fv where k not in (select k from ex)""")
CH = lambda base: "len(list_distinct(list_filter([" + ", ".join(
    f"case when {base(f)} = '' then o_{f} end" for f in FIELDS) + "], lambda x: x is not null)))"
add("merge_counters", "firm_csv firm_old", f"""with {MERGE},
c as (select 0 added, {CH(lambda f: f)} updated, cnt from ex join fv on fv.k = ex.k
 union all select 1, {CH(lambda f: "'set'" if f == 'industry' else 'f_' + f)}, cnt - 1 from fv where k not in (select k from ex))
select sum(added) added, sum(updated) updated, sum(cnt - updated) skipped from c""")
add("cache_upsert", "board_cache", f"""with n as (select concat('supplier', lpad((c_custkey % 150)::varchar, 9, '0')) firm_key, 'lever' provider, concat('new', c_custkey) board_token, {RUN} + interval 1 minute * c_custkey::int detected_at,
 row_number() over (partition by c_custkey % 150 order by c_custkey desc) rn from customer)
select firm_key, provider, board_token, detected_at from n where rn = 1 union all select * from board_cache where firm_key not in (select firm_key from n)""")
add("cache_add_missing", "listings role_texts", f"""with l as (select distinct {CKEY} content_key from listings where ord % 4 <> 0)
select * from role_texts union all select content_key, 'legacy' from l where content_key not in (select content_key from role_texts)""")
DISC = f"""
ds as (select s_suppkey, det, {_case([q(d[2]) if d[2] else 'null' for d in DETECTIONS])} provider, {_case([around_token(d[3]).replace('{S}', 'varchar') for d in DETECTIONS])} token,
 {_case([around_token(d[4]).replace('{S}', 'varchar') for d in DETECTIONS])} source_url, case when s_suppkey % 4 = 0 then lower(replace(s_name, '#', '')) else s_name end company_name
 from (select *, 0 det from supplier union all select *, 1 det from supplier)),
disc as (select s_suppkey firm_ord, {norm_key('company_name')} firm_key, company_name, provider, token, source_url,
 row_number() over (partition by {norm_key('company_name')}, provider, lower(coalesce(nullif(token, ''), source_url)) order by s_suppkey, det) rn from ds where provider is not null)"""
add("discover_sources", "", f"with {DISC} select firm_ord, firm_key, company_name, provider, token, source_url from disc where rn = 1")
add("detection_dedup_prune", "", f"with {DISC} select provider, count(*) n from disc where rn = 1 group by 1")
add("paylocity_board_prune", "", """with s as (select c_custkey ord, (c_custkey % 200)::varchar firm_key, case when c_custkey % 7 = 0 then 'zoho' else 'paylocity' end provider,
 case when c_custkey % 11 = 0 then concat('board:all:', c_custkey) else concat('detail:', c_custkey) end token from customer)
select * from s where not (provider = 'paylocity' and starts_with(token, 'detail:') and firm_key in (select firm_key from s where provider = 'paylocity' and starts_with(token, 'board:')))""")
add("allowed_firm_keys", "site_detection", f"select distinct {norm_key('coalesce(nullif(firm_name, ' + repr('') + '), firm_key)')} firm_key from site_detection")
add("alias_folding", "source_seed", """with s as (select *, concat('https://c', ord % 30, '.icims.com/jobs/search?pr=', ord % 2) board_key from source_seed where provider = 'icims')
select ord, board_key, first_value(source_url) over w seed_url, first_value(company_name) over w primary_company, company_name, row_number() over w > 1 is_alias,
 count(*) over (partition by board_key) - 1 n_aliases from s window w as (partition by board_key order by ord)""")

# --- statistics -----------------------------------------------------------------------------------

add("funnel_counts", "listings", f"""with {DEDUP} select (select count(*) from listings) total_ingested, (select count(*) from w02) after_dedup,
 (select count(*) from w02 where {role()} is not null) after_filter, 0 after_quality_filter, 0 created, 0 updated, 0 expired, 0 deleted, 0 skipped, 0 errors""")
add("top_companies", "listings", "select company, count(*) n from listings group by 1 order by n desc, min(ord) limit 10")
LAST = lambda d, at: f"coalesce(sum(created) filter (run_ts >= timestamp '{at}' - interval {d} day), 0) created_{d}d"
add("rolling_created", "history", f"select count(*) total_runs, {LAST(30, '2024-02-10')}, {LAST(60, '2024-02-10')}, {LAST(90, '2024-02-10')} from history")
WEEK = "(run_ts::date - dayofweek(run_ts)::int)"
add("weekly_created", "history", f"select {WEEK} as week, sum(created) created, strftime({WEEK}, '%m-%d') as label from history group by 1, 3")
add("weekly_created_recent", "history", f"select {WEEK} as week, sum(created) created, strftime({WEEK}, '%m-%d') as label from history where run_ts >= timestamp '2024-04-05' - interval 90 day group by 1, 3")
add("states_covered", "history_facts", "select distinct name state from history_facts where kind = 'state'")
add("top_companies_over_runs", "history_facts", "select name company, sum(n) n from history_facts where kind = 'top_company' group by 1 order by n desc, min((run_ts, rank)) limit 10")
add("latest_runs", "history", "select run_ts, created, errors from history order by run_ts desc limit 10")
add("dashboard_kpis", "history run_log", """with l as (select * from history order by run_ts desc limit 1), j as (select * from run_log order by started_at desc limit 1)
select after_quality_filter active_listings, (select sum(created) from history where run_ts >= timestamp '2024-02-10' - interval 30 day) created_30d, unique_companies companies, unique_states states,
 case when conclusion = 'failure' then 'red' when errors > 0 then 'yellow' else 'green' end health,
 case when conclusion = 'failure' then 'Last run failed' when errors > 0 then concat(errors, ' errors') else 'Healthy' end health_text from l, j""")
add("issues_report", "history history_facts", """with r as (select * from history order by run_ts desc limit 10)
select distinct 'unmatched_industry' issue, name, null::bigint n from history_facts where kind = 'unmatched' and run_ts in (select run_ts from r)
union all select 'run_errors', strftime(run_ts, '%Y-%m-%d'), errors from r where errors > 0
union all select 'top_company', name, n from history_facts where kind = 'top_company' and run_ts = (select max(run_ts) from r)""")
add("history_table", "history", """select run_ts::date run_date, created, updated, expired, deleted, errors, unique_companies, concat(ai_calls_made, ' / ', ai_calls_made + ai_calls_skipped) ai_calls,
 concat(floor(duration_ms / 1000.0 + 0.5)::bigint, 's') duration from history""")
add("append_history", "history", """with a as (select run_ts - interval 18 month run_ts, created from history union all select run_ts, created from history)
select run_ts, created from a where run_ts >= timestamp '2024-01-15' - interval 18 month""")
COV = lambda c, x: f"round(avg(case when {trim(x)} <> '' then 1.0 else 0.0 end)::double, 2) {c}_coverage"
QUALITY = f"""
li as (select * replace (case when ord % 9 = 0 then concat(' ', chr(10)) else description end as description) from listings),
bo as (select distinct company, case when length(company) % 2 = 0 then 'ashby' else 'zoho' end provider, not ends_with(company, '8') fetch_ok from listings union all select n_name, 'lever', true from nation),
st as (select company, count(*) listing_count, {COV('title', 'title')}, {COV('source_url', 'source_url')}, {COV('date_posted', 'date_posted')}, {COV('location', 'location')}, {COV('description', 'description')},
 coalesce(round(avg(length({trim('description')})) filter ({trim('description')} <> ''), 2), 0) avg_description_length from li group by 1),
bq0 as (select bo.company, provider, fetch_ok, {", ".join(f"case when fetch_ok then coalesce({c}, 0) else 0 end {c}" for c in ("listing_count", "title_coverage", "source_url_coverage", "date_posted_coverage", "location_coverage", "description_coverage", "avg_description_length"))}
 from bo left join st on st.company = bo.company),
bq as (select *, case when not fetch_ok then 'fetch-error' when listing_count = 0 then 'no-openings-or-invalid' when title_coverage >= 1 and source_url_coverage >= 1 and date_posted_coverage >= 1
 and location_coverage >= 0.8 and description_coverage >= 0.8 then 'good' else 'mixed' end quality_flag from bq0)"""
add("board_quality", "listings", f"with {QUALITY} select * from bq")
add("provider_quality_summary", "listings", f"""with {QUALITY} select provider, count(*) total, count(*) filter (fetch_ok) ok, count(*) filter (listing_count > 0) with_listings,
 count(*) filter (fetch_ok and listing_count = 0) zero_listings, count(*) filter (not fetch_ok) fetch_errors, round(avg(listing_count), 2) avg_listings, count(*) filter (quality_flag <> 'good') mixed_or_worse from bq group by rollup (provider)""")

# --- listing pages --------------------------------------------------------------------------------

ITEMS = f"""
ri as (select *, {role()} role_category, {LEVEL} experience_level from listings where {role()} is not null), {location('ri', 'location')},
items as (select ord, title job_title, company company_name, location, lo_state job_state, lo_remote is_remote, role_category, experience_level, date_posted, salary_max,
 case ord % 3 when 0 then 'Revit, Power BI' when 1 then 'Revit' else '' end tools_mentioned, ord % 101 quality_score from lo)"""
add("hub_filter", "listings", f"with {ITEMS} select ord, job_title, company_name from items where role_category = 'project-management' and is_remote and (contains(lower(job_title), 'manager') or contains(lower(company_name), 'manager') or contains(lower(location), 'manager'))")
add("hub_filter_count", "listings", f"with {ITEMS} select count(*) n from items where job_state = 'Texas' and experience_level = 'Senior'")
add("category_page", "listings", f"with {ITEMS} select ord, job_title from items where role_category = 'operations'")
add("hub_sort_page", "listings", f"with {ITEMS} select ord, salary_max from items order by salary_max desc nulls last, ord limit 400 offset 10")
add("paged_newest", "listings", f"with {ITEMS} select ord, date_posted from items order by date_posted desc nulls last, ord limit 100")
add("related_listings", "listings", f"""with {ITEMS}, b as (select ord, role_category, row_number() over (partition by role_category order by date_posted desc, ord) rn from items),
p as (select i.ord, b.ord related_ord, row_number() over (partition by i.ord order by b.rn) as position from items i join b on b.role_category = i.role_category and b.ord <> i.ord and b.rn <= 5)
select ord, related_ord, position from p where position <= 4""")
add("facet_counts", "listings", f"""with {ITEMS}, v as (select 'job_state' facet, job_state v from items union all select 'role_category', role_category from items union all select 'experience_level', experience_level from items
 union all select 'is_remote', is_remote::varchar from items union all select 'tool', unnest(string_split(tools_mentioned, ', ')) from items)
select facet, v as value, count(*) n from v where v <> '' group by 1, 2""")
add("score_distribution", "listings", f"with {ITEMS} select (quality_score // 10) * 10 score_band, count(*) n, (select count(*) from items) total_items, round((select count(*) from items) / 10000.0, 4)::double ceiling_share from items group by 1")

# --- sources ---------------------------------------------------------------------------------------

add("scan_firm_csv", "firm_csv", """select row_number() over (order by ord) - 1 as ord, concat('The "Best",', chr(10), name) as name, industry, website, linkedin, country, state, city from firm_csv""")
add("scan_board_cache", "board_cache", "select firm_key, provider, board_token, detected_at from board_cache")
add("scan_raw_payloads", "", f"select source, page_id ord, url, length(html) n from (select *, [{PROV}][(page_id % 15 + 1)::int] source from pages) where source in ('lever', 'zoho')")
add("snapshot_round_trip", "published", "select * from published")
KW = ", ".join(f"({q(k)}, {q(w)})" for k, ws in C.ROLE_TITLE_KEYWORDS.items() for w in ws)
add("config_lists", "listings", f"select v.category, v.keyword, count(*) n from listings join (values {KW}) v(category, keyword) on contains(lower(title), v.keyword) group by 1, 2")

# --- feeds -----------------------------------------------------------------------------------------

HTML = lambda c="description": f"concat('<p>', {c}, '</p><ul><li>A &amp;amp; B</li><LI>C<br />D</LI></ul>')"
RUNISO = "'2024-01-31T00:00:00.000Z'"
COLS = ["title", "company", "location", "description", "source_url", "date_posted", "salary_min", "salary_max", "contract_type", "contract_time", "category", "row_error"]


def feed(name: str, source: str, cols: dict[str, str], where: str = "true", pos: str = "ord % 10", page: str = "ord // 10", wrap: str = "") -> None:
    rank = C.PROVIDERS.index(source)
    base = {
        "title": "title", "company": "concat('Board ', ord // 10)", "location": "location", "description": "''", "source_url": "source_url",
        "date_posted": "date_posted", "salary_min": "null::double", "salary_max": "null::double", "contract_type": "null::varchar",
        "contract_time": "null::varchar", "category": "null::varchar", "row_error": "null::varchar",
        "salary_is_predicted": "false", "source": q(source), "ord": f"{rank} * 288230376151711744 + ({page}) * 1048576 + {pos}",
    }
    sel = ", ".join(f"{v} as {k}" for k, v in {**base, **cols}.items())
    add(name, "listings", f"with f as (select * from listings{wrap}) select {sel} from f where {where}")


feed("feed_greenhouse", "greenhouse", {
    "location": "case when ord % 4 <> 0 then location else concat('HQ, ', location) end", "description": html(HTML(), "A"),
    "category": "concat('Dept, ', source)"})
feed("feed_lever", "lever", {
    "description": f"""array_to_string(list_filter([case when ord % 2 = 0 then coalesce(nullif(description, ''), {html(HTML(), 'A')}) else {html(HTML(), 'A')} end, concat('Needs:', chr(10), 'x', chr(10), chr(10), 'y'),
     case when ord % 6 = 0 then 'Plain more' when ord % 3 = 0 then 'More' end], lambda x: x is not null and x <> ''), concat(chr(10), chr(10)))""",
    "date_posted": f"case when ord % 7 = 0 then strftime(timestamp '2024-01-01' + interval 1 second * ord::int, '%Y-%m-%dT%H:%M:%S.000Z') else {RUNISO} end",
    "salary_min": "case when ord % 10 = 0 then salary_min end", "salary_max": "case when ord % 10 = 0 then salary_max end",
    "contract_type": "case when ord % 4 = 1 then 'permanent' end", "contract_time": "case when ord % 4 = 1 then 'full_time' end",
    "category": "case when ord % 5 = 0 then 'Team' else 'Dept' end"})
feed("feed_ashby", "ashby", {
    "description": f"case when ord % 2 = 1 then description else {html(HTML(), 'A')} end",
    "source_url": "case when ord % 4 = 0 then source_url when ord % 4 = 1 then 'https://apply' else concat('https://jobs.ashbyhq.com/b', ord // 10, '/', ord) end",
    "date_posted": f"case when ord % 2 = 0 then date_posted else {RUNISO} end", "salary_min": "salary_min", "salary_max": "salary_max",
    "contract_type": "case ord % 3 when 0 then 'permanent' when 1 then 'contract' end", "contract_time": "case when ord % 3 = 0 then 'part_time' end",
    "category": "case when ord % 3 = 0 then 'Dept' else 'Team' end"})
feed("feed_workable", "workable", {
    "location": "case when ord % 10 = 0 then 'Paris, IDF' when ord % 5 = 0 then 'Paris' when ord % 2 = 0 then 'IDF' else 'France' end", "description": html(HTML(), "A"),
    "source_url": "case when ord % 3 = 0 then source_url when ord % 3 = 1 then 'https://short' else concat('https://apply.workable.com/b', ord // 10, '/j/SC', ord) end",
    "date_posted": f"case ord % 4 when 0 then '2024-01-05T00:00:00.000Z' when 1 then '2024-01-06T01:02:03.000Z' when 3 then {RUNISO} end",
    "contract_type": "'permanent'", "contract_time": "'full_time'", "row_error": "case when ord % 4 = 2 then 'bad_date' end"})
feed("feed_smartrecruiters", "smartrecruiters", {
    "location": "case when ord % 3 = 0 then coalesce(nullif(location, ''), 'Lyon, fr') else 'Lyon, fr' end",
    "description": trim(f"concat('About:', chr(10), {html(HTML(), 'A')}, chr(10), chr(10), 'Plain')"),
    "source_url": "case when ord % 4 = 0 then source_url when ord % 4 = 1 then concat('https://careers.smartrecruiters.com/x/', ord) else concat('https://api.smartrecruiters.com/v1/companies/b', ord // 10, '/postings/', ord) end",
    "date_posted": f"case when ord % 2 = 0 then date_posted else {RUNISO} end", "contract_type": "'permanent'", "category": "'Dept'"}, "ord % 6 <> 5")
feed("feed_breezy", "breezy", {
    "location": "case ord % 4 when 0 then coalesce(nullif(location, ''), 'Oslo, NO') when 1 then 'Main' when 2 then 'Second' else 'Oslo, NO' end",
    "source_url": "case when ord % 3 = 0 then source_url else concat('https://b', ord // 10, '.breezy.hr/p/', case when ord % 2 = 0 then 'f' else '' end, ord) end",
    "date_posted": f"case when ord % 2 = 0 then date_posted else {RUNISO} end", "contract_type": "'permanent'", "contract_time": "'part_time'", "category": "'Dept'"})
feed("feed_workday", "workday", {
    "source_url": "concat('https://t', ord // 10, '.wd5.myworkdayjobs.com/Careers', case when ord % 10 < 4 then concat('/job/', ord % 10 // 2) else '' end)",
    "date_posted": "case ord % 6 when 0 then '2024-01-31T00:00:00.000Z' when 1 then '2024-01-30T00:00:00.000Z' when 2 then '2024-01-28T00:00:00.000Z' when 3 then '2024-01-17T00:00:00.000Z' when 4 then '2024-01-30T19:00:00.000Z' else '2024-01-31T00:00:00.000Z' end"},
    "ord % 10 <> 7 and rn = 1", wrap=" qualify true")
ORACLE["feed_workday"] = ORACLE["feed_workday"].replace(
    "select * from listings qualify true",
    "select *, row_number() over (partition by ord // 10, case when ord % 10 < 4 then concat('/job/', ord % 10 // 2) else concat(title, '|', location, '|', ord % 6) end order by ord) rn from listings where ord % 10 <> 7")
ZH = "concat('Location: ', coalesce(nullif(location, ''), 'Earth'), '<br>Category: Ops &amp; PM<br><span>', title, ' &lt;b&gt;text&lt;/b&gt; ', description, '</span>')"
feed("feed_zoho", "zoho", {
    "title": "concat(title, ' & more')", "location": "coalesce(nullif(location, ''), 'Earth')", "description": html(ZH, "D"),
    "source_url": decode("source_url", FEED),
    "date_posted": f"case when ord % 5 = 0 then {RUNISO} when ord % 5 > 1 then concat('2024-01-0', ord % 9 + 1, 'T10:00:00.000Z') end",
    "category": "'Ops & PM'", "row_error": "case when ord % 5 = 1 then 'bad_date' end"})
feed("feed_jobscore", "jobscore", {
    "location": "'Rome & Co'", "description": html("concat('<ul><li>', title, '</li></ul><span>s</span>', description)", "C"),
    "source_url": "regexp_replace(source_url, '[?#].*$', '')", "date_posted": f"case when ord % 3 = 0 then {RUNISO} else date_posted end",
    "contract_type": "'permanent'", "contract_time": "case when ord % 2 = 0 then 'part_time' else 'full_time' end", "category": "'D'"})
feed("feed_paylocity", "paylocity", {
    "location": "case when ord % 2 = 0 and location <> '' then location when ord % 3 = 0 then 'Rome' else 'Site' end",
    "source_url": "concat('https://example.com/Recruiting/Jobs/Details/', ord, '?moduleId=7')", "category": q('Dept } { " x')},
    "ord % 9 <> 0")
feed("feed_ultipro", "ultipro", {
    "ord": "10 * 288230376151711744 + (ord // 10) * 1048576 + ord % 10",
    "location": "case when ord % 2 = 0 and location <> '' then location else 'Bern, BE' end", "description": "'Brief'",
    "source_url": "concat('https://recruiting.ultipro.com/B/OpportunityDetail?opportunityId=', ord)",
    "contract_type": "case when ord % 3 = 1 then null else 'permanent' end", "contract_time": "case when ord % 3 = 0 then 'full_time' end", "category": "'Cat'"},
    "ord % 20 >= 10 or ord % 10 < 3")


def detail(name: str, source: str, title: str, url: str, blank_title_kept: bool) -> None:
    has_p = "ord % 5 < 3"
    keep = f"({has_p} or ord % 5 = 3 {'' if blank_title_kept else 'and ord % 10 <> 3'})"
    feed(name, source, {
        "title": f"case when {has_p} then title else {title} end", "company": "company",
        "location": f"case when {has_p} then case when ord % 2 = 0 then 'Gent, OVL' else 'Gent' end else '' end",
        "description": f"case when {has_p} then {html(decode(HTML()), 'B')} else 'Some text' end",
        "source_url": f"case when {has_p} and ord % 3 = 0 then {url} else concat('https://example.com/j/', ord) end",
        "date_posted": f"case when {has_p} and ord % 5 <> 0 then date_posted else {RUNISO} end",
        "contract_type": f"case when {has_p} then 'permanent' end", "contract_time": f"case when {has_p} then 'full_time' end"},
        keep, "0", "ord")


detail("feed_icims", "icims", "case when ord % 10 = 3 then 'Job Opening' else title end", "source_url", True)
detail("feed_freshteam", "freshteam", "title", "source_url", False)
detail("feed_jobvite", "jobvite", "title", "source_url", False)
feed("feed_trinethire", "trinethire", {
    "title": "case when ord % 4 <> 0 then title else 'Meta title' end", "company": "company", "location": trim("location"),
    "description": "concat(title, chr(10), chr(10), 'b & c')", "source_url": "concat('https://example.com/j/', ord)", "date_posted": RUNISO,
    "contract_type": "'permanent'", "contract_time": "'full_time'"}, "true", "0", "ord")
add("union_feeds", "listings", """with s as (select ord, case ord % 3 when 0 then 'lever' when 1 then 'greenhouse' else 'jobvite' end source, case ord % 3 when 0 then 1 when 1 then 0 else 13 end r from listings)
select source, count(*) n, min(r * 288230376151711744 + ord * 1048576 + 1) first_ord from s group by 1""")

# --- pages -------------------------------------------------------------------------------------------

add("jsonld_postings", "listings", "select ord page_id, title, 'BE' country from listings where ord % 5 < 3")
add("extract_meta", "", "select page_id, concat('Page ''', page_id, '''') og, 'a & b' keywords from pages")
# the first element with "ad" in its class is a div on every page, so no back-reference is needed
AD = q(r"""(?is)<div[^>]*class=["'][^"']*ad[^"']*["'][^>]*>(.*?)</div>""")
add("extract_text_by_class", "", f"select page_id, {tidy(untag(decode(f'regexp_extract(html, {AD}, 1)'), BLOCKS['B']))} as text from pages")
LINKRX = q(r"""(?i)href=["'](/[^"']+)["']""")
add("extract_links", "", f"""with l as (select page_id, lower(regexp_extract(url, '(?i)^(https?://[^/?#]+)', 1)) o, unnest(regexp_extract_all(html, {LINKRX}, 1)) r from pages)
select distinct page_id, concat(o, {decode('r')}) link from l""")
add("search_page_frontier", "", """with recursive mx as (select max(page_id) m from pages),
e as (select page_id p, unnest([page_id * 2, page_id * 2 + 1, page_id // 3]) t from pages), ed as (select p, t from e, mx where t <= m and t > 0),
bf(board, page, lvl) as (select page_id, page_id, 0 from pages where page_id between 1 and 9 or page_id % 100 = 7
 union select board, t, lvl + 1 from bf join ed on ed.p = bf.page where lvl <= (select count(*) from pages)),
fr as (select board, page, min(lvl) lvl from bf group by 1, 2) select board, count(*) pages, max(lvl) depth from fr group by 1""")
BOARDS = """bp as (select page_id // 50 board, page_id % 50 n from pages),
e as (select board, n, unnest([n * 2, n * 2 + 1, n // 3]) t from bp), ed as (select * from e where t > 0 and t < 50)"""
CLOSURE = """bf(board, n, lvl) as (select distinct board, unnest({}), 0 from bp union select bf.board, t, lvl + 1 from bf join ed on ed.board = bf.board and ed.n = bf.n where lvl < 50),
fr as (select board, n, min(lvl) lvl from bf group by 1, 2)"""
# two more candidates of a board were never landed; a detail seed makes three candidates
add("crawl_search_boards", "", f"""with recursive {BOARDS}, {CLOSURE.format('[1]')},
 li as (select board, count(*) + 2 pages, max(lvl) depth from fr group by 1),
 de as (select fr.board, count(*) details, min(concat('https://b', fr.board, '.icims.com/jobs/', fr.n, '/some-title/job')) first_detail from fr join bp on bp.board = fr.board and bp.n = fr.n group by 1)
 select li.board, case when li.board % 10 = 3 then 3 else pages end pages, case when li.board % 10 = 3 then 0 else depth end depth,
  case when li.board % 10 = 3 then 1 else details end details, case when li.board % 10 = 3 then concat('https://b', li.board, '.icims.com/jobs/5/lead/job') else first_detail end first_detail
 from li left join de using (board)""")
add("normalize_search_url", "source_seed", """select ord, case when ord % 30 = 8 then null end::varchar as search from source_seed where provider = 'icims' and false
union all select ord, case when ord % 30 = 8 then concat('https://c8.icims.com/jobs/search?ss=1&pr=', ord % 2, case when ord % 3 = 0 then '&hashed=9' when ord % 3 = 1 then '&in_iframe=2' else '' end,
 case when ord % 3 = 1 then '' else '&in_iframe=1' end) end from source_seed where provider = 'icims'""")
add("feed_path", "", """select page_id, case when page_id % 3 = 0 then '/recruit/downloadrssfeed?digest=a&b=1' when page_id % 3 = 1 then '/recruit/downloadrssfeed?x' else '' end feed_path from pages""")

# --- whole runs ----------------------------------------------------------------------------------------

add("role_counts", "listings", f"""with {DEDUP} select {role()} role_category, count(*) n, count(distinct company) companies, count(*) filter ({TOOLS} <> '') with_tools
from w02 where {role()} is not null and ({SIGNALS}) group by 1""")
RUNCTE = f"""{ENRICHED}, {slugged('enriched')},
pb as (select * from slugged where quality_score >= 40), {matched('pb')},
item as (select pb.ord, m.action, m.item_id, pb.slug, quality_score, least({RUN} + interval 7 day, {POSTED} + interval 60 day) ed, seq_a, seq_b from pb join matched m on m.ord = pb.ord),
lastc as (select item_id, arg_max(ed, (seq_a, seq_b)) ed from item group by 1),
aft as (select item_id id, ed, true mg from lastc union all select id, expiration_date, pipeline_managed from published where id not in (select item_id from lastc)),
ch as (select item_id, action from item union all select id, 'unpublish' from aft where mg and ed < {RUN} union all select id, 'delete' from aft where mg and ed < {RUN} - interval 30 day)"""
add("daily_run_changes", EV, f"with {RUNCTE} select item_id, action from ch")
add("daily_run_items", EV, f"with {RUNCTE} select ord, slug, quality_score, quality_score >= 70 is_featured, ed expiration_date from item")
CNT = lambda a: f"(select count(*) from ch where action = '{a}')"
add("daily_run_funnel", EV, f"""with {RUNCTE} select (select count(*) from listings) total_ingested, (select count(*) from w02) after_dedup, (select count(*) from enriched) after_filter, (select count(*) from pb) after_quality_filter,
 {CNT('create')} created, {CNT('update')} updated, {CNT('unpublish')} expired, {CNT('delete')} deleted, (select count(*) from enriched) - (select count(*) from pb) skipped, 0 errors""")
ORACLE["ingest_available"] = ORACLE["feed_greenhouse"]

# --- a run from landed pages -------------------------------------------------------------------------

AT = lambda source: f"{C.PROVIDERS.index(source)} * 288230376151711744 + page * 1048576 + pos"
PAGED = "concat('<p>', description, '</p>')"
LANDED = f"""lp as (
  select *, min(ord) over w page, row_number() over (partition by company, ord // 100, ord % 3 order by ord) - 1 pos from listings
  window w as (partition by company, ord // 100, ord % 3)),
la as (
  select {AT('greenhouse')} as ord, title, company, location, {html(PAGED, 'A')} description, source_url, date_posted, null::double salary_min,
    null::double salary_max, null::varchar contract_type, null::varchar contract_time, 'greenhouse' source, null::varchar row_error, false salary_is_predicted, '' category from lp where ord % 3 = 0
  union all
  select {AT('workable')}, title, company, coalesce(nullif(location, ''), 'France'), {html(PAGED, 'A')}, source_url, '2024-01-05T00:00:00.000Z', null, null,
    'permanent', null, 'workable', case when ord % 12 = 1 then 'bad_date' end, false, null from lp where ord % 3 = 1
  union all
  select {AT('lever')}, title, company, location, description, source_url,
    strftime(timestamp '2024-01-01' + interval 1 second * ord::int, '%Y-%m-%dT%H:%M:%S.000Z'), salary_min, salary_max, null, null, 'lever', null, false, null from lp where ord % 3 = 2),
landed as (select * from la where row_error is null)"""
PAGERUN = LANDED + ", " + RUNCTE.replace("from listings", "from landed")
add("daily_run_from_pages", EV, f"""with {PAGERUN} select (select count(*) from landed) total_ingested, (select count(*) from w02) after_dedup, (select count(*) from enriched) after_filter, (select count(*) from pb) after_quality_filter,
 {CNT('create')} created, {CNT('update')} updated, {CNT('unpublish')} expired, {CNT('delete')} deleted, (select count(*) from enriched) - (select count(*) from pb) skipped, (select count(*) from la where row_error is not null) errors""")
add("daily_run_page_changes", EV, f"with {PAGERUN} select item_id, action from ch")
add("daily_run_failed_rows", "listings", f"with {LANDED} select ord, source, company, title, source_url, row_error from la where row_error is not null")
EARLY = "(ord // 1048576) % 2 = 0"
add("ingest_distinct", "listings", f"""with {LANDED}, early as (select * from landed where {EARLY}),
 {DEDUP.replace('from listings', 'from early').replace('w01', 'e01').replace('w02', 'e02')}, {DEDUP.replace('from listings', 'from landed')},
 known as (select {fp()} k from e02 union select {canon('source_url')} from e02)
 select ord, source, source_url, row_error, 0 batch_id from e02
 union all select ord, source, source_url, row_error, 1 from w02 where {fp()} not in (select k from known) and {canon('source_url')} not in (select k from known where k <> '')
 union all select ord, source, source_url, row_error, 0 from la where row_error is not null and {EARLY}
 union all select ord, source, source_url, row_error, 1 from la where row_error is not null""")
