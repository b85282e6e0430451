"""Key-value caches kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirestream.functions.keys import last_by_key


def cache_upsert(cache: DataFrame, new: DataFrame, key: str, stamp: str) -> DataFrame:
    """New entries replace old ones; among new entries of a key the latest stays."""
    fresh = last_by_key(new.select(*cache.columns), [key], stamp)
    return cache.join(fresh.select(key), key, "left_anti").select(*cache.columns).unionByName(fresh)


def cache_add_missing(cache: DataFrame, legacy: DataFrame, key: str, value: str) -> DataFrame:
    """Take over legacy entries that have a value and whose key is not filled yet."""
    filled = cache.where(F.coalesce(value, F.lit("")) != "")
    extra = legacy.where(F.coalesce(value, F.lit("")) != "").join(filled.select(key), key, "left_anti")
    kept = cache.join(extra.select(key), key, "left_anti")
    return kept.select(*cache.columns).unionByName(extra.select(*cache.columns))
