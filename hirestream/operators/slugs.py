"""Unique page slugs.

The numbering is defined as a loop over rows in order: a row takes its slug if
unused, else the first unused ``slug-2``, ``slug-3``, ...  The name ``s-<k>`` can
be used by something else than a row of ``s`` only if it is published, or wanted
itself by a row of the batch.  So a row's number is its position among the rows
of its slug plus the numbers that it finds used, and what has to be worked out in
order is the list of these contested numbers, not the rows:

* a published number is always used;
* a wanted name ``s-<k>`` is used by its own first row if fewer rows of ``s`` than
  needed to reach ``k`` come before that row, else a row of ``s`` has it and the
  rows of ``s-<k>`` start at 2.

With the used numbers sorted, a row goes behind those below it; that is its
position in one list of rows and used numbers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream.functions.keys import numbered
from hirestream.functions.text import slug_base
from hirestream.session import stage

_NUMBERED = r"^(.+)-([2-9]|[1-9][0-9]+)\z"


def with_slug_base(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "slug_base", slug_base(F.col("title"), F.col("company"), F.coalesce("location", F.lit("")))
    )


def _family(slug: Column) -> Column:
    return F.regexp_replace(slug, r"(?:-[0-9]+)+\z", "")


def _stems(names: DataFrame) -> DataFrame:
    """``(name, slug_base, k)`` of the names ``slug_base-k`` among ``names (name)``; numbers count from 2."""
    return names.select(
        "name", F.regexp_extract("name", _NUMBERED, 1).alias("slug_base"),
        F.regexp_extract("name", _NUMBERED, 2).try_cast("bigint").alias("k"),
    ).where("slug_base <> '' and k is not null")


def taken_slugs(published: DataFrame) -> DataFrame:
    """``(slug, source_url)`` of the published items whose slugs count as taken: those with a source URL, the last one of each."""
    return published.where("source_url <> ''").groupBy("source_url").agg(F.max_by("slug", "item_ord").alias("slug"))


_USED = "slug_base string, k bigint"


def _settle(events: DataFrame) -> DataFrame:
    """``(slug_base, k)``: numbers of ``slug_base`` that it finds used, 1 being the plain slug.

    ``events (family, slug_base, k, room, own)`` have one row for each wanted name
    ``slug_base-k``, with ``room``, the numbers below ``k`` that neither earlier
    rows nor published slugs have, and ``own``, whether ``slug_base`` is published.
    A family is one group: its contested names, whatever the number of rows.
    """
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        lost: set[str] = set()  # wanted names that a row of their stem has
        batch = batch.assign(size=batch["slug_base"].str.len()).sort_values(["size", "slug_base", "k"])
        stem, used = None, 0
        for base, k, room, own in zip(*(batch[c].tolist() for c in ("slug_base", "k", "room", "own"))):
            if base != stem:
                # a stem is shorter than the names that go back to it, so it is known by now whether it lost its own
                stem, used = base, int(own or base in lost)
            if used < room:
                out.append((base, k))
                used += 1
            else:
                lost.add(f"{base}-{k}")
                out.append((f"{base}-{k}", 1))
        return pd.DataFrame(out, columns=["slug_base", "k"])

    return events.groupBy("family").applyInPandas(run, _USED)


def slug_uniquify(
    df: DataFrame,
    existing: DataFrame | None = None,
    order: tuple[str, ...] = ("seq.a", "seq.b"),
    exclude_own_slug: bool = False,
) -> DataFrame:
    """Add ``slug``, unique among the rows and the ``existing`` slugs.

    ``existing`` has a column ``slug``.  By default a row's own published slug
    counts as taken, too; with ``exclude_own_slug`` (``existing`` then also has
    ``source_url``) slugs of items that this batch updates are free.
    """
    orders = [f"__o{i}" for i in range(len(order))]
    wanted = df.select("ord", "slug_base", *[F.col(c).alias(o) for c, o in zip(order, orders)])
    taken = None
    if existing is not None:
        taken = existing.where("slug <> ''")
        if exclude_own_slug:
            taken = taken.join(df.select("source_url").distinct(), "source_url", "left_anti")
        taken = taken.select("slug").distinct()

    names = stage(wanted.groupBy("slug_base").agg(F.min(F.struct(*orders)).alias("first")), "wanted-slugs")
    no_names = names.select(F.col("slug_base").alias("name")).limit(0)
    published = no_names if taken is None else taken.withColumnRenamed("slug", "name")
    # names of the batch that another slug of the batch runs into, unless they are published
    bases = names.select("slug_base")
    met = _stems(names.select(F.col("slug_base").alias("name"))).join(bases, "slug_base").join(published, "name", "left_anti")
    met = met.join(names.select(F.col("slug_base").alias("name"), "first"), "name")
    mark = lambda rows, is_row: rows.withColumn("__row", F.lit(is_row))
    places = mark(wanted, True).withColumn("__k", F.lit(None).cast("bigint")).unionByName(mark(met.select(
        "slug_base", F.lit(None).cast("bigint").alias("ord"), *[F.col(f"first.{o}").alias(o) for o in orders], F.col("k").alias("__k")), False))
    # positions of the rows; for a contested name, the rows of its stem that come before its own first one
    ranked = stage(numbered(places, ["slug_base"], orders, "__n", "__row"), "slug-numbers")
    rows = ranked.where("__row").select("ord", "slug_base", "__n")

    old = _stems(published).join(bases, "slug_base").select("slug_base", "k")
    own = published.join(names.select(F.col("slug_base").alias("name")), "name").select(F.col("name").alias("slug_base"))
    events = ranked.where("not __row").select("slug_base", F.col("__k").alias("k"), "__n")
    # windows over contested numbers only; there are far fewer of them than rows
    by_number = W.partitionBy("slug_base").orderBy("k")
    listed = events.withColumn("old", F.lit(0)).unionByName(
        old.select("slug_base", "k", F.lit(0).cast("bigint").alias("__n"), F.lit(1).alias("old")))
    below = listed.withColumn("below", F.sum("old").over(by_number)).where("old = 0")
    below = below.join(own.withColumn("own", F.lit(True)), "slug_base", "left").select(
        _family(F.col("slug_base")).alias("family"), "slug_base", "k", (F.col("k") - F.col("__n") - F.col("below")).alias("room"),
        F.coalesce("own", F.lit(False)).alias("own"))
    used = old.unionByName(own.withColumn("k", F.lit(1).cast("bigint"))).unionByName(_settle(below))
    used = stage(used.withColumn("j", F.row_number().over(by_number).cast("bigint")), "used-numbers")

    # a used number stands behind as many rows as there are free numbers below it
    some = rows.join(used.select("slug_base").distinct(), "slug_base", "left_semi")
    line = some.select("slug_base", "ord", F.col("__n").alias("at"), F.lit(0).alias("kind")).unionByName(used.select(
        "slug_base", F.lit(None).cast("bigint").alias("ord"), (F.col("k") - F.col("j")).alias("at"), F.lit(1).alias("kind")))
    shifted = numbered(line, ["slug_base"], ["at", "kind"], "number").where("kind = 0").select("ord", F.col("number").alias("__number"))
    number = F.coalesce("__number", "__n")
    named = F.when(number == 1, F.col("slug_base")).otherwise(F.concat("slug_base", F.lit("-"), number))
    slugs = rows.join(shifted, "ord", "left").select("ord", named.alias("slug"))
    return df.join(slugs, "ord")
