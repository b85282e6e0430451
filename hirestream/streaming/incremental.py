"""Incremental ingestion: pages landed since the last run to listing rows.

The jobs are batch jobs; this keeps track of which landed files have been read
and, in ``ingest_distinct``, of the postings that have come out.  Other steps that
compare rows with each other (publishing) run on the resulting table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirestream import schemas as S
from hirestream.functions.text import fingerprint
from hirestream.functions.urls import with_canonical_url
from hirestream.operators import dedup
from hirestream.session import STAGED, remove_stages, stage


def _run_available(spark: SparkSession, landing: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hand the pages that landed since the last call to ``write``, batch by batch, then stop."""
    pages = spark.readStream.schema(S.RAW_PAYLOAD).parquet(landing)
    query = (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_available(
    spark: SparkSession,
    landing: str,
    listings: str,
    checkpoint: str,
    normalizers: dict[str, Callable[[DataFrame], DataFrame]],
) -> None:
    """Normalise all pages that are new since the last call, then stop.

    ``normalizers`` maps feed names to functions from pages to listings.  Rows go
    to ``listings`` with their ``row_error``, one folder per batch; a repeated
    batch overwrites its own folder, so a failure in between leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        pages = batch.persist()  # every feed reads the batch
        feeds = [fn(pages.where(F.col("source") == name)) for name, fn in normalizers.items()]
        rows = reduce(lambda a, b: a.unionByName(b), feeds)
        rows.write.mode("overwrite").parquet(f"{listings}/batch_id={batch_id}")
        pages.unpersist()

    _run_available(spark, landing, checkpoint, write)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete ``batch_id=`` folders, ascending; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch_id=")]
    done = [p.getName() for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def posting_keys(rows: DataFrame, strip: list[str] | None = None) -> DataFrame:
    """What a posting is known by, as ``(ord, key)``: its fingerprint and, where it has one, its canonical URL.

    A key is 16 bytes, whatever the length of the URL.
    """
    kinds = F.array(
        F.concat(F.lit("f:"), fingerprint(F.col("company"), F.col("title"), F.col("location"))),
        F.when(F.col("url_key") != "", F.concat(F.lit("u:"), "url_key")),
    )
    keyed = with_canonical_url(rows, "source_url", "url_key", strip)
    return keyed.select("ord", F.explode(kinds).alias("key")).where("key is not null").select(
        "ord", F.unhex(F.md5("key")).alias("key")
    )


def unseen(rows: DataFrame, seen: DataFrame, strip: list[str] | None = None) -> DataFrame:
    """The rows of which no key is in ``seen``; only ``ord`` and keys are joined, the rows come back by ``ord``."""
    known = posting_keys(rows, strip).join(seen, "key", "left_semi").select("ord")
    return rows.join(known, "ord", "left_anti")


def ingest_distinct(
    spark: SparkSession,
    landing: str,
    listings: str,
    state: str,
    checkpoint: str,
    normalizers: dict[str, Callable[[DataFrame], DataFrame]],
    strip: list[str] | None = None,
    compact_every: int = 32,
) -> None:
    """As ``ingest_available``, but a posting comes out once, however often and in whatever batch it lands.

    Duplicates within a batch are removed as in a run (``fingerprint_dedup``, then
    ``url_dedup``); a row also goes if its fingerprint or its canonical URL came out
    with an earlier batch.  What came out stays, also if a later copy tells more, and
    openings of one fingerprint that land later than the first ones are not told
    from copies.  Rows with ``row_error`` are written as they are and leave no keys.

    ``state`` holds the keys, one folder per batch, and every ``compact_every``
    batches one folder with all keys so far, so a batch reads a bounded number of
    folders.  A batch sees the keys of earlier batches only and overwrites its own
    folders: it can be repeated after a failure at any point.
    """

    def seen_before(session: SparkSession, batch_id: int) -> DataFrame:
        bases = [n for n in _numbers(session, f"{state}/all") if n < batch_id]
        base = bases[-1] if bases else -1
        parts = [f"{state}/all/batch_id={base}"] if bases else []
        parts += [f"{state}/new/batch_id={n}" for n in _numbers(session, f"{state}/new") if base < n < batch_id]
        schema = "key binary"
        return session.read.schema(schema).parquet(*parts) if parts else session.createDataFrame([], schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, mark = batch.sparkSession, len(STAGED)
        pages = stage(batch, "landed-batch")  # every feed reads the batch
        feeds = [fn(pages.where(F.col("source") == name)) for name, fn in normalizers.items()]
        rows = stage(reduce(lambda a, b: a.unionByName(b), feeds), "parsed-batch")
        good = stage(dedup.fingerprint_dedup(rows.where("row_error is null")), "distinct-batch")
        seen = seen_before(session, batch_id)
        fresh = unseen(dedup.url_dedup(good, strip), seen, strip).select(*rows.columns)
        out = f"{listings}/batch_id={batch_id}"
        fresh.unionByName(rows.where("row_error is not null")).write.mode("overwrite").parquet(out)
        came_out = session.read.schema(rows.schema).parquet(out).where("row_error is null")
        keys = posting_keys(came_out, strip).select("key").distinct()
        keys.write.mode("overwrite").parquet(f"{state}/new/batch_id={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            seen.unionByName(keys).write.mode("overwrite").parquet(f"{state}/all/batch_id={batch_id}")
        remove_stages(session, mark)

    _run_available(spark, landing, checkpoint, write)
