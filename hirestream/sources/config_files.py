"""Reading keyword, alias, ranking and wage configuration from JSON files.

These files are small configuration: they become literals in the plan.  A missing
or unreadable file means an empty list, except industry signals, which fall back
to the built-in list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from hirestream import config as C

_LISTS = "map<string, array<string>>"
#: Role category -> name of its list in the file.
TITLE_LISTS = {"project-management": "projectManagement", "resource-management": "resourceManagement", "operations": "operations"}


def _load(spark: SparkSession, path: str, schema: str):
    try:
        row = (
            spark.read.text(path, wholetext=True)
            .select(F.from_json("value", schema).alias("v"))
            .first()
        )
    except AnalysisException:
        return None
    return row and row["v"]


def role_keywords(spark: SparkSession, path: str) -> tuple[dict[str, list[str]], list[str]]:
    v = _load(spark, path, f"titleKeywords {_LISTS}, descriptionKeywords array<string>")
    if not v or not v["titleKeywords"]:
        return {}, []
    t = v["titleKeywords"]
    return {k: list(t.get(n) or []) for k, n in TITLE_LISTS.items()}, list(v["descriptionKeywords"] or [])


def tool_names(spark: SparkSession, path: str) -> list[str]:
    v = _load(spark, path, _LISTS) or {}
    return list(dict.fromkeys(t for tools in v.values() for t in tools))


def industry_aliases(spark: SparkSession, path: str) -> dict[str, list[str]]:
    v = _load(spark, path, f"aliases {_LISTS}")
    return {k: list(a) for k, a in (v["aliases"] or {}).items()} if v else {}


def industry_signals(spark: SparkSession, path: str) -> dict[str, list[str]]:
    v = _load(spark, path, _LISTS)
    return {k: list(a) for k, a in v.items()} if v else C.INDUSTRY_SIGNALS


def ranking(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    v = _load(spark, path, "array<struct<rank:int, firm:string>>") or []
    return [(r["rank"], r["firm"]) for r in v]


def scan_wages(spark: SparkSession, path: str) -> DataFrame:
    """Wage rows ``(soc, metro, p25, p75)``; the national figure has an empty metro."""
    band = "struct<p25:double, median:double, p75:double>"
    text = spark.read.text(path, wholetext=True)
    rows = text.select(
        F.explode(
            F.from_json("value", f"array<struct<soc:string, title:string, national:{band}, metro:map<string,{band}>>>")
        ).alias("w")
    )
    metros = F.transform(
        F.map_entries("w.metro"), lambda e: F.struct(e.key.alias("metro"), e.value.alias("band"))
    )
    bands = F.concat(F.array(F.struct(F.lit("").alias("metro"), F.col("w.national").alias("band"))), metros)
    return rows.select("w.soc", F.inline(bands)).select("soc", "metro", "band.p25", "band.p75")


def config_table(spark: SparkSession, lists: dict[str, list[str]], name: str, item: str) -> DataFrame:
    """Keyword lists as rows ``(name, item, item_ord)`` for reporting and joins."""
    schema = T.StructType(
        [T.StructField(name, T.StringType()), T.StructField(item, T.StringType()),
         T.StructField(f"{item}_ord", T.IntegerType())]
    )
    return spark.createDataFrame([(k, w, i) for k, ws in lists.items() for i, w in enumerate(ws)], schema)
