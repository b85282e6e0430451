"""The published table in buckets: what a run rewrites, and what a failed one leaves."""

import pytest
from pyspark.sql import functions as F

from hirestream.operators.publish import apply_change_set
from hirestream.sources import snapshot

RUN = "2024-01-31"
LATER = "2024-03-01"


def at(day):
    return F.to_timestamp(F.lit(day))


def items(spark, n=40):
    return spark.range(n).select(
        F.concat(F.lit("it"), "id").alias("id"), F.concat(F.lit("s-"), "id").alias("slug"), F.lit(True).alias("pipeline_managed"),
        F.to_timestamp(F.lit(LATER)).alias("expiration_date"))


def change(spark, *rows):
    """(item, slug, expiry) in order"""
    made = [(i, s, e, o) for o, (i, s, e) in enumerate(rows)]
    df = spark.createDataFrame(made, "item_id string, slug string, expires string, ord long")
    return df.select("item_id", "slug", F.to_timestamp("expires").alias("expiration_date"), F.lit(True).alias("pipeline_managed"), "ord",
                     F.struct(F.col("ord").alias("a"), F.col("ord").alias("b")).alias("seq"))


def files(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("data/**/*.parquet")}


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "slug", "expiration_date", "live").collect())


def test_only_changed_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    snapshot.create_snapshot(items(spark), root, 16)
    before = files(tmp_path)
    assert len(rows(snapshot.read_snapshot(spark, root))) == 40
    change1 = change(spark, ("it3", "one", LATER), ("new:1", "two", LATER), ("it3", "three", LATER), ("it5", "old", "2024-01-20"), ("it7", "gone", "2023-11-01"))
    assert snapshot.update_snapshot(spark, root, change1, at(RUN)) == 1
    after = files(tmp_path)
    assert {p: t for p, t in after.items() if p in before} == before
    written = {p.parent.name for p in after if p not in before}
    assert 1 <= len(written) <= 4
    want = apply_change_set(items(spark), change1, at(RUN))
    assert rows(snapshot.read_snapshot(spark, root)) == rows(want)
    assert len(rows(snapshot.read_snapshot(spark, root, 0))) == 40  # the version before
    # nothing is due: no new version; a month later all of them are
    assert snapshot.update_snapshot(spark, root, change1.limit(0), at(RUN)) == 1
    assert files(tmp_path) == after
    late = at("2024-03-02")
    assert snapshot.update_snapshot(spark, root, change1.limit(0), late) == 2
    assert rows(snapshot.read_snapshot(spark, root)) == rows(apply_change_set(want.drop("live"), change1.limit(0), late))
    assert not any(r[3] for r in rows(snapshot.read_snapshot(spark, root)))
    snapshot.drop_unused(spark, root, keep=1)
    assert len(rows(snapshot.read_snapshot(spark, root))) == 39
    assert all("version=2" in str(p) for p in files(tmp_path))


@pytest.mark.parametrize("step", ["_switch", "_path"])
def test_failure_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    snapshot.create_snapshot(items(spark), root, 4)
    before = rows(snapshot.read_snapshot(spark, root))
    made = change(spark, ("it3", "one", LATER), ("new:1", "two", LATER))
    with monkeypatch.context() as m:
        real = getattr(snapshot, step)

        def fails(spark, name, *rest):
            if step == "_switch" or "data/version=1" in name:
                raise RuntimeError("lost")
            return real(spark, name, *rest)

        m.setattr(snapshot, step, fails)
        with pytest.raises(RuntimeError):
            snapshot.update_snapshot(spark, root, made, at(RUN))
    assert snapshot.current_version(spark, root) == 0
    assert rows(snapshot.read_snapshot(spark, root)) == before
    assert snapshot.update_snapshot(spark, root, made, at(RUN)) == 1
    assert rows(snapshot.read_snapshot(spark, root)) == rows(apply_change_set(items(spark), made, at(RUN)))


def test_no_items(spark, tmp_path):
    root = str(tmp_path)
    snapshot.create_snapshot(items(spark, 0), root, 4)
    assert rows(snapshot.read_snapshot(spark, root)) == []
    assert snapshot.update_snapshot(spark, root, change(spark, ("new:1", "a", LATER)), at(RUN)) == 1
    assert [r[0] for r in rows(snapshot.read_snapshot(spark, root))] == ["new:1"]
