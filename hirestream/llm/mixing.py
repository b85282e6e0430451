"""Mixing sources to target weights by capped water-filling.

Each source may be used for at most ``max_epochs`` epochs.  The water level is
found from two sums per round; the mix then takes every document for the whole
epochs of its source and a seeded part of the documents for the rest.  That part
is a prefix in the order of a seeded hash: two levels of hash buckets find where
the prefix ends, so only the rows of one small bucket per source are ever sorted.
One more document, the one whose size is nearest to what is still missing,
closes the gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream.functions.keys import numbered
from hirestream.llm.common import WORD, columns, spare, stage

SEED = "mix-1"
SALTS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def water_level(sources: DataFrame, total: float) -> float:
    """The level L with ``sum(least(cap, L * weight)) = total``; infinite if the caps don't reach ``total``.

    ``sources`` has ``weight`` and ``cap``.  The level only rises when sources
    that would pass their cap are clamped, so each round is one aggregate.
    """
    level, clamped = 0.0, None
    while True:
        over = F.col("cap") < F.lit(level) * F.col("weight")
        caps, n, weight = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)), F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if clamped == n:
            return level
        clamped = n
        if not weight:
            return float("inf")
        level = (total - caps) / weight


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: float) -> DataFrame:
    """``(source, source_size, target)`` for each source of ``sized`` (``source, size``); NULL is a source of its own."""
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", F.col("source").isNull().alias("__null"), F.coalesce("source", F.lit("")).alias("__name"))
    placed = numbered(named, [], ["__null", "__name"], "__pos")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = stage(placed.select(
        "source", "source_size", (F.lit(max_epochs) * F.col("source_size")).alias("cap"),
        F.element_at(turn, (F.pmod(F.col("__pos") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
    ), "sources")
    size = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, share * size)
    target = F.col("cap") if level == float("inf") else F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def _with_plan(rows: DataFrame, plan: DataFrame, source: Column, salt: Column) -> DataFrame:
    """Rows with the plan of their source; a hot source is spread over salts, and Spark broadcasts small plans."""
    names = [c for c in plan.columns if c != "__source"]
    copies = plan.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__plan_salt"))
    copies = copies.withColumn("__plan_name", F.coalesce("__source", F.lit(""))).withColumn(
        "__plan_null", F.col("__source").isNull()).select("__plan_salt", "__plan_name", "__plan_null", *names)
    keyed = rows.withColumns({"__salt": salt, "__name": F.coalesce(source, F.lit("")), "__null": source.isNull()})
    on = (keyed["__salt"] == copies["__plan_salt"]) & (keyed["__name"] == copies["__plan_name"]) & (
        keyed["__null"] == copies["__plan_null"])
    return keyed.join(copies, on).drop("__salt", "__name", "__null", "__plan_salt", "__plan_name", "__plan_null")


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
                seed: str = SEED, out: str = "mix", id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``out``: ``size, source_size, target, copies``.

    ``copies`` is how often the mix takes the document.  Sources, in the order of
    their code points and NULL last, have the weights in turn and share ``share``
    times all words.  A NULL text has no words; documents without words are taken
    for the whole epochs.  Rows equal in id and size are taken or left together,
    and the NULL id is an id like others.  A column named ``out`` is replaced;
    other extra columns pass through.  An empty table gives an empty table.
    Documents are taken whole: a source misses its target by at most half of its
    largest text.
    """
    doc, source, text = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    size = word_count(text)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))).cast("binary"))
    narrow = stage(docs.select(source.alias("source"), size.alias("size"), key.alias("key")), "sizes")
    narrow = narrow.withColumn("rank", F.struct("key", "size"))
    salt = lambda c: F.pmod(F.conv(F.substring(c, 31, 2), 16, 10).cast("int"), F.lit(SALTS))

    plan = source_targets(narrow, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.select(F.col("source").alias("__source"), "source_size", "target", whole.cast("int").alias("whole"))
    plan = stage(plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "targets")

    # where the prefix of the fractional epoch ends: by 3, then by 6 hex digits of the hash, then by row
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)

    def boundary(buckets: DataFrame, at: DataFrame) -> DataFrame:
        """The bucket in which each source reaches its need, and the words before that bucket."""
        sums = buckets.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)) + F.col("base"))
        hit = sums.where("before <= need and before + words > need")
        return hit.select(F.col("source").alias("__source"), "need", F.col("bucket"), F.col("before").alias("base"))

    need = plan.select("__source", "need", F.lit(0).cast("bigint").alias("base"))
    per = narrow.groupBy("source", F.substring("key", 1, 3).alias("bucket")).agg(F.sum("size").alias("words"))
    salted = F.pmod(F.xxhash64("bucket"), F.lit(SALTS)).cast("int")
    b1 = stage(boundary(_with_plan(per, need, F.col("source"), salted), need), "cut-1")
    inside = _with_plan(narrow, b1, F.col("source"), salt(F.col("key"))).where(F.substring("key", 1, 3) == F.col("bucket"))
    per2 = inside.groupBy("source", F.substring("key", 1, 6).alias("bucket"), "need", "base").agg(
        F.sum("size").alias("words"))
    b2 = stage(boundary(per2, need), "cut-2")
    last = _with_plan(narrow, b2, F.col("source"), salt(F.col("key"))).where(F.substring("key", 1, 6) == F.col("bucket"))
    units = last.groupBy("source", "rank", "need", "base").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    units = units.withColumn("upto", F.sum("words").over(upto) + F.col("base"))
    cut = units.groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("need"), F.col("rank"))).alias("inner"),
        F.max(F.when(F.col("upto") <= F.col("need"), F.col("upto"))).alias("reached"),
        F.first("base").alias("base"), F.first("need").alias("need"),
        F.min(F.substring("rank.key", 1, 6)).alias("bucket"))
    none = F.struct(F.col("bucket").alias("key"), F.lit(-1).cast("bigint").alias("size"))
    cut = cut.select(F.col("source").alias("__source"), F.coalesce("inner", none).alias("cut"),
                     (F.col("need") - F.coalesce("reached", "base")).alias("missing"))
    # sources that end exactly with a whole epoch have no cut
    cut = stage(cut, "cut-3")

    # the closing document: nearest in size to what is missing, if it brings the source nearer
    rest = _with_plan(narrow, cut, F.col("source"), salt(F.col("key"))).where(
        "rank > cut and size > 0 and size < 2 * missing")
    nearest = F.min(F.struct(F.abs(F.col("size") - F.col("missing")).alias("off"), "rank"))
    units = rest.groupBy("source", "rank").agg(F.sum("size").alias("size"), F.first("missing").alias("missing"))
    closing = units.where("size < 2 * missing").groupBy("source").agg(
        nearest.alias("c"), F.min_by(F.col("size") - F.col("missing"), F.struct(F.abs(F.col("size") - F.col("missing")), "rank")).alias("over"))
    closing = stage(closing.select(F.col("source").alias("__source"), F.col("c.rank").alias("closing"), "over"), "closing")

    # where it brings too much: the document of the prefix nearest in size to that is left out, if that is nearer still
    beyond = closing.where("over > 0")
    beyond = beyond.join(cut.select(F.col("__source").alias("s"), "cut"), beyond["__source"].eqNullSafe(F.col("s"))).drop("s", "closing")
    taken = _with_plan(narrow, beyond, F.col("source"), salt(F.col("key"))).where("rank <= cut and size > 0 and size < 2 * over")
    taken = taken.groupBy("source", "rank").agg(F.sum("size").alias("size"), F.first("over").alias("over")).where("size < 2 * over")
    out_of = F.min_by("rank", F.struct(F.abs(F.col("size") - F.col("over")), "rank")).alias("left_out")
    left_out = taken.groupBy("source").agg(out_of).select(F.col("source").alias("__source"), "left_out")
    closing = closing.drop("over")
    same = lambda o: plan["__source"].eqNullSafe(o["__source"])
    plan = plan.join(cut.alias("k"), same(cut), "left").join(closing, same(closing), "left").join(left_out, same(left_out), "left").select(
        plan["__source"], "source_size", "target", "whole", F.col("k.cut").alias("cut"), "closing", "left_out")
    plan = stage(plan, "mix-plan")

    mine = plan.select("__source", F.struct(*columns(plan, "__source")).alias("__plan"))
    # the row as one struct, so that no name of its columns meets one of these
    rows = docs.select(F.struct(*columns(docs, out)).alias("__doc"), source.alias("__from"), size.alias("__size"), key.alias("__key"))
    joined = _with_plan(rows, mine, F.col("__from"), salt(F.col("__key")))
    rank = F.struct(F.col("__key").alias("key"), F.col("__size").alias("size"))
    ahead_of_cut = (rank <= F.col("__plan.cut")) & ~rank.eqNullSafe(F.col("__plan.left_out"))
    # a text without words fills no part of an epoch
    part = (F.col("__size") > 0) & (F.coalesce(ahead_of_cut, F.lit(False)) | F.coalesce(rank == F.col("__plan.closing"), F.lit(False)))
    mix = F.struct(F.col("__size").alias("size"), F.col("__plan.source_size").alias("source_size"),
                   F.col("__plan.target").alias("target"),
                   (F.col("__plan.whole") + part.cast("int")).alias("copies"))
    return joined.select("__doc.*", mix.alias(out))


def repeated(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, without the struct ``out``."""
    times = F.sequence(F.lit(1), F.col(f"`{out}`.copies"))
    taken = mixed.where(F.col(f"`{out}`.copies") > 0)
    time = spare(mixed, "__time")[0]
    return taken.select(*columns(mixed, out), F.explode(times).alias(time)).drop(time)
