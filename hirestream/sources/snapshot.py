"""The published table in hash buckets of which a run rewrites only those it changes.

Below ``root``: ``data/version=<v>/bucket=<b>/`` has the rows of a bucket as of
version ``v``, ``manifest/version=<v>/`` one row per bucket with the version that
holds it, and ``current`` the number of the version in use.  Readers start at
``current``, so a run that fails before it moves that file leaves the old version
as it was.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.operators.publish import apply_change_set

BUCKETS = 64


def bucket_of(item_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(item_id), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path), fs


def current_version(spark: SparkSession, root: str) -> int | None:
    path, fs = _path(spark, f"{root}/current")
    return int(spark.read.text(f"{root}/current").first()["value"]) if fs.exists(path) else None


def _switch(spark: SparkSession, root: str, version: int) -> None:
    """Write the number beside ``current``, then rename it over the old one."""
    new, fs = _path(spark, f"{root}/_current-{version}")
    out = fs.create(new, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    fc = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fc.rename(new, _path(spark, f"{root}/current")[0], over)


def _manifest(spark: SparkSession, root: str, version: int) -> dict[int, int]:
    """Bucket -> version that holds it; as many rows as buckets."""
    rows = spark.read.schema("bucket int, version int").parquet(f"{root}/manifest/version={version}").collect()
    return {r.bucket: r.version for r in rows}


def _read(spark: SparkSession, root: str, held: dict[int, int]) -> DataFrame:
    """The rows of the given buckets; buckets without rows have no folder and version -1."""
    paths = [f"{root}/data/version={v}/bucket={b}" for b, v in sorted(held.items()) if v >= 0]
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the version in use, or of an earlier one whose folders are still there."""
    at = current_version(spark, root) if version is None else version
    return _read(spark, root, _manifest(spark, root, at))


def _write(rows: DataFrame, root: str, version: int, held: dict[int, int], touched: set[int], buckets: int) -> None:
    """Write the touched buckets as ``version``, then its manifest, then switch."""
    spark = rows.sparkSession
    data = f"{root}/data/version={version}"
    keyed = rows.withColumn("bucket", bucket_of(F.col("id"), buckets))
    # a bucket is written by as many tasks as adaptive execution cuts it into
    keyed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
    path, fs = _path(spark, data)
    filled = {s.getPath().getName() for s in fs.listStatus(path)}
    now = {**held, **{b: version if f"bucket={b}" in filled else -1 for b in touched}}
    manifest = spark.createDataFrame(sorted(now.items()), "bucket int, version int").coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    _switch(spark, root, version)


def create_snapshot(items: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Version 0 of all items; ``live`` is true where the items do not have it."""
    spark = items.sparkSession
    if "live" not in items.columns:
        items = items.withColumn("live", F.lit(True))
    items.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    _write(items, root, 0, {}, set(range(buckets)), buckets)


def touched_buckets(items: DataFrame, changes: DataFrame, run_ts: Column, buckets: int) -> set[int]:
    """Buckets of changed items and of those that expire or go now; reads four columns of the items."""
    cutoff = run_ts - F.expr(f"interval {C.DELETE_AFTER_DAYS} days")
    managed = F.coalesce("pipeline_managed", F.lit(False))
    due = managed & (((F.col("expiration_date") < run_ts) & F.col("live")) | (F.col("expiration_date") < cutoff))
    revived = ~F.col("live") & ~F.coalesce(managed & (F.col("expiration_date") < run_ts), F.lit(False))
    ids = changes.select(F.col("item_id").alias("id")).unionByName(items.where(due | revived).select("id"))
    found = ids.select(bucket_of(F.col("id"), buckets).alias("bucket")).distinct().collect()
    return {r.bucket for r in found}


def update_snapshot(spark: SparkSession, root: str, changes: DataFrame, run_ts: Column) -> int:
    """``apply_change_set`` on the buckets that it changes, as a new version; returns its number.

    ``changes`` has ``item_id``, ``ord``, ``seq`` and item columns; the last change of
    an item wins.  Buckets without a changed, expiring or deleted item keep their
    files.  With no such bucket nothing is written and the version stays.
    """
    version = current_version(spark, root)
    held = _manifest(spark, root, version)
    buckets = len(held)
    touched = touched_buckets(_read(spark, root, held), changes, run_ts, buckets)
    if not touched:
        return version
    items = _read(spark, root, {b: v for b, v in held.items() if b in touched})
    after = apply_change_set(items.drop("live"), changes, run_ts).select(*items.columns)
    # a number that an earlier, failed run may have used for folders; they are overwritten
    _write(after, root, version + 1, held, touched, buckets)
    return version + 1


def drop_unused(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete bucket folders that none of the last ``keep`` versions holds."""
    last = current_version(spark, root)
    kept = range(max(0, last - keep + 1), last + 1)
    used = {f"version={v}/bucket={b}" for n in kept for b, v in _manifest(spark, root, n).items()}
    path, fs = _path(spark, f"{root}/data")
    for v in fs.listStatus(path):
        for b in fs.listStatus(v.getPath()):
            name = f"{v.getPath().getName()}/{b.getPath().getName()}"
            if b.isDirectory() and name not in used and int(v.getPath().getName().split("=")[1]) <= last:
                fs.delete(b.getPath(), True)
