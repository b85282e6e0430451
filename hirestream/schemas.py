"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, I, TS = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.TimestampType()
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RAW_PAYLOAD = _struct(
    source=S, board_token=S, company=S, page_no=I, fetched_at=TS, url=S, body=S, ord=L
)
RAW_LISTING = _struct(
    ord=L, title=S, company=S, location=S, description=S, source_url=S, date_posted=S,
    salary_min=D, salary_max=D, salary_is_predicted=B, contract_type=S, contract_time=S,
    category=S, source=S,
)
LISTING_COLUMNS = RAW_LISTING.fieldNames()
FIRM = _struct(
    firm_ord=L, name=S, aliases=T.ArrayType(S), firm_type=S, industry=S, firm_rank=I,
    specializations=T.ArrayType(S), hq=S, hq_state=S, hq_city=S, size=S, website=S, linkedin=S,
)
FIRM_CSV_HEADER = ["Account Name", "Industry", "Website", "LinkedIn", "Country", "State", "City"]
FIRM_CSV = _struct(
    ord=L, name=S, industry=S, website=S, linkedin=S, country=S, state=S, city=S
)
BOARD_CACHE = _struct(firm_key=S, provider=S, board_token=S, detected_at=TS)
SITE_DETECTION = _struct(firm_ord=L, firm_key=S, firm_name=S, det_ord=L, ats=S, url=S)
SOURCE_SEED = _struct(company_name=S, provider=S, token=S, source_url=S)
ENRICHMENT = _struct(
    company_key=S, employee_count=S, industry=S, hq=S, summary=S, founded=S, company_type=S,
    fetched_at=TS,
)
WAGES = _struct(soc=S, metro=S, p25=D, p75=D)
ROLE_TEXT = _struct(content_key=S, role_summary=S)
COMPANY_TEXT = _struct(company_key=S, description=S, generated_at=TS)
RUN_SUMMARY = _struct(
    run_ts=TS, duration_ms=L, total_ingested=L, after_dedup=L, after_filter=L,
    after_quality_filter=L, created=L, updated=L, expired=L, deleted=L, skipped=L, errors=L,
    unique_companies=L, unique_states=L, ai_calls_made=L, ai_calls_skipped=L,
)
RUN_FACT = _struct(run_ts=TS, kind=S, name=S, n=L, rank=I)
