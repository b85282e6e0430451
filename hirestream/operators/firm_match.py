"""Matching company names to the firm master list.

A firm matches by equal normalised name or alias, or by edit similarity of the
names; of all matching firms the one earliest in the list is taken.

The similarity part is a set-similarity join without a cross product.  One edit
changes at most two of a name's pairs of neighbouring characters (grams), so two
similar names have a known least number of grams in common.  With all grams in
one order, the ones that are rarest on both sides first, two such names already
share ``SHARED`` grams among their first few (prefix filter with a longer prefix,
as in AdaptJoin, SIGMOD 2012).  Names meet under combinations of ``SHARED`` of
these grams: wording that most names have comes last in the order and makes no
candidates, however long it is.  Counts of their characters, which travel with the
keys, rule out most of the pairs that meet.

Keys that very many names of both sides have would make candidates with the square
of the names.  The names that have one are compared by walking the prefixes of both
sides together (``name_tries``), in blocks of names whose lengths allow a match.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream import config as C
from hirestream.functions.keys import computed
from hirestream.functions.text import norm_firm, norm_key
from hirestream.operators.name_tries import NameTrie, near_names
from hirestream.session import stage

#: Grams of a prefix that two similar names have in common; a key is made of as many.
SHARED = 2
#: A key is crowded if its pairs are more than so many for each name that has it.
CROWD = 8
#: Names of either side in a block.
BLOCK, FIRM_BLOCK = 1 << 15, 1 << 16
# similarity 0.85 = at most 3/20 of the longer length may differ
_NUM, _DEN = 3, 20


def edit_limit(longer: Column) -> Column:
    return F.floor(longer * _NUM / _DEN).cast("int")


def similar(a: Column, b: Column) -> Column:
    """1 - distance / longer length >= 0.85, evaluated in doubles.

    The distance is computed in a band of the edit limit; beyond it, it is -1.
    """
    longer = F.greatest(F.length(a), F.length(b))
    limit = edit_limit(longer)
    d = F.call_function("levenshtein", a, b, limit)
    close = F.abs(F.length(a) - F.length(b)) <= limit
    return (longer == 0) | (close & (d >= 0) & (1 - d / longer >= C.SIMILARITY))


def similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def exact_index(firms: DataFrame) -> DataFrame:
    """``(name, firm_ord)``: the earliest firm of every normalised name and alias."""
    keys = firms.select(
        "firm_ord", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("k")
    )
    return keys.groupBy(norm_firm(F.col("k")).alias("name")).agg(F.min("firm_ord").alias("firm_ord"))


def grams(name: Column) -> Column:
    """Hashes of the pairs of neighbouring characters, ends included; equal pairs are numbered."""
    padded = F.concat(F.lit("#"), name, F.lit("#"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.xxhash64(F.substring(padded, i, F.lit(2))))
    # numbered by their place behind the first equal one
    number = lambda held: F.transform(held, lambda g, i: F.xxhash64(g, i.cast("bigint") - F.array_position(held, g)))
    return F.get(F.transform(F.array(F.array_sort(pairs)), number), 0)


#: Characters that are counted together, up to 15 each; the rest are not counted.
_COUNTED = ("0", "1", "2", "3", "4", "5", "6", "7", "89", "ae", "iou", "tn", "sr", "lchdm", "bfgjkpqvwxyz")


def character_counts(name: Column) -> Column:
    """How often a name has the characters of each class, four bits a class."""
    out = F.lit(0).cast("bigint")
    for i, chars in enumerate(_COUNTED):
        count = F.length(name) - F.length(F.translate(name, chars, ""))
        out = out.bitwiseOR(F.shiftleft(F.least(count, F.lit(15)).cast("bigint"), 4 * i))
    return out


def least_distance(a: Column, b: Column) -> Column:
    """A lower bound of the edit distance from two ``character_counts``: an edit adds one character and takes one away at most."""
    more = less = F.lit(0)
    for i in range(len(_COUNTED)):
        d = F.shiftrightunsigned(a, 4 * i).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(b, 4 * i).bitwiseAND(F.lit(15))
        more, less = more + F.greatest(d, F.lit(0)), less - F.least(d, F.lit(0))
    return F.greatest(more, less)


def prefix_sizes(lengths: DataFrame, others: DataFrame) -> DataFrame:
    """``(len, size)``: how many first grams of a name hold ``SHARED`` of those it shares with any similar name.

    Only lengths that the other side has count; ``lengths`` and ``others`` have one row a length.
    """
    length = F.col("len")
    shortest = F.ceil(length * (_DEN - _NUM) / _DEN).cast("int")
    longest = F.floor(length * _DEN / (_DEN - _NUM)).cast("int")
    met = lengths.select("len", F.explode(F.sequence(shortest, longest)).alias("other")).join(
        others.withColumnRenamed("len", "other"), "other")
    longer = F.greatest("len", "other")
    common = longer + 1 - 2 * edit_limit(longer)
    return met.groupBy("len").agg((F.first("len") + 1 - F.min(common) + SHARED).cast("int").alias("size"))


def _prefix_keys(tokens: DataFrame, weights: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(id, len, counts, key)`` of ``tokens (id, len, counts, gram)``: combinations of grams in each prefix that occur on both sides."""
    ranked = tokens.join(weights, "gram", "left").groupBy("id", "len", "counts").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("weight", F.lit(0.0)).alias("weight"), "gram"))).alias("grams"))
    prefix = F.filter(F.slice("grams", F.lit(1), F.col("size")), lambda g: g["weight"] > 0)
    ranked = ranked.join(sizes, "len").select("id", "len", "counts", prefix.alias("p")).where(F.size("p") >= SHARED)
    behind = lambda x, i: F.transform(F.slice("p", i + 2, F.size("p")), lambda y: F.xxhash64(x["gram"], y["gram"]))
    return ranked.select("id", "len", "counts", F.explode(F.flatten(F.transform("p", behind))).alias("key"))


def _keys(names: DataFrame, firm_names: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys of both sides, ``(key, probe, la, ca)`` and ``(key, firm, lf, cf)``, and the crowded ones among them."""
    def tokens(df: DataFrame, name: str) -> DataFrame:
        # a name of up to five characters is similar to itself only
        sized = df.select(F.xxhash64(name).alias("id"), F.length(name).alias("len"), character_counts(F.col(name)).alias("counts"),
                          grams(F.col(name)).alias("g"))
        return sized.where("len > 5").select("id", "len", "counts", F.explode("g").alias("gram"))

    probes, held = tokens(names, "norm"), tokens(firm_names, "name")
    count = lambda df, by, n: df.groupBy(by).agg(F.count(F.lit(1)).cast("double").alias(n))
    weights = count(probes, "gram", "x").join(count(held, "gram", "y"), "gram").select("gram", (F.col("x") * F.col("y")).alias("weight"))
    la, lf = (df.select("len").distinct() for df in (probes, held))
    asked = _prefix_keys(probes, weights, prefix_sizes(la, lf)).select("key", F.col("id").alias("probe"), F.col("len").alias("la"), F.col("counts").alias("ca"))
    index = _prefix_keys(held, weights, prefix_sizes(lf, la)).select("key", F.col("id").alias("firm"), F.col("len").alias("lf"), F.col("counts").alias("cf"))
    asked, index = stage(asked, "asked"), stage(index, "index")  # each is read three times
    crowded = count(asked, "key", "x").join(count(index, "key", "y"), "key").where(
        F.col("x") * F.col("y") > CROWD * (F.col("x") + F.col("y"))).select("key")
    return asked, index, crowded


def _sparse_pairs(asked: DataFrame, index: DataFrame, crowded: DataFrame) -> DataFrame:
    """``(probe, firm)`` hashes of names that meet under a key that is not crowded."""
    limit = edit_limit(F.greatest("la", "lf"))
    near = (F.abs(F.col("la") - F.col("lf")) <= limit) & (least_distance(F.col("ca"), F.col("cf")) <= limit)
    return asked.join(crowded, "key", "left_anti").join(index, "key").where(near).select("probe", "firm").distinct()


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(norm, name, firm_ord)`` of names that can be similar, from a block ``(len, name, firm_ord, held)`` of both sides."""
    table = pa.Table.from_batches(list(batches))
    held = table.column("held").to_pylist()
    length = table.column("len")[0].as_py()
    names = table.column("name").to_pylist()
    probes = sorted(n for n, h in zip(names, held) if not h)
    firms = sorted((n, o) for n, o, h in zip(names, table.column("firm_ord").to_pylist(), held) if h)
    if probes and firms:
        left, right, ords = pa.array(probes), pa.array([n for n, _ in firms]), pa.array([o for _, o in firms], pa.int64())
        longest = max(length, *(len(n) for n, _ in firms))
        for a, b in near_names(NameTrie(probes), NameTrie([n for n, _ in firms]), longest * _NUM // _DEN):
            for i in range(0, len(a), 1 << 16):
                x, y = pa.array(a[i : i + (1 << 16)]), pa.array(b[i : i + (1 << 16)])
                yield pa.RecordBatch.from_arrays([left.take(x), right.take(y), ords.take(y)], ["norm", "name", "firm_ord"])


def _crowded_pairs(names: DataFrame, firm_names: DataFrame, asked: DataFrame, index: DataFrame, crowded: DataFrame) -> DataFrame:
    """``(norm, name, firm_ord)`` of names that can be similar and have a crowded key, some more than once."""
    length = F.col("len")
    holders = lambda df, who: df.join(crowded, "key", "left_semi").select(who).distinct()
    probes = names.withColumn("probe", F.xxhash64("norm")).join(holders(asked, "probe"), "probe", "left_semi").select(
        F.length("norm").alias("len"), F.col("norm").alias("name"))
    firms = firm_names.withColumn("firm", F.xxhash64("name")).join(holders(index, "firm"), "firm", "left_semi").select(
        F.length("name").alias("len"), "name", F.col("firm_ord").cast("bigint").alias("firm_ord"))
    # a firm goes to all lengths that can be similar to it
    shortest, longest = F.ceil(length * (_DEN - _NUM) / _DEN).cast("int"), F.floor(length * _DEN / (_DEN - _NUM)).cast("int")
    firms = firms.select(F.explode(F.sequence(shortest, longest)).alias("len"), "name", "firm_ord")
    blocks = lambda df, size, n: df.groupBy("len").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(n))
    sizes = blocks(probes, BLOCK, "nx").join(blocks(firms, FIRM_BLOCK, "ny"), "len")
    mine = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    both = probes.join(sizes, "len").select("len", mine("nx").alias("x"), every("ny").alias("y"), "name", F.lit(0).cast("bigint").alias("firm_ord"), F.lit(False).alias("held")).unionByName(
        firms.join(sizes, "len").select("len", every("nx").alias("x"), mine("ny").alias("y"), "name", "firm_ord", F.lit(True).alias("held")))
    tasks = 4 * names.sparkSession.sparkContext.defaultParallelism
    return both.repartition(tasks, "len", "x", "y").groupBy("len", "x", "y").applyInArrow(_walked, "norm string, name string, firm_ord long")


def candidate_pairs(names: DataFrame, firm_names: DataFrame) -> DataFrame:
    """``(probe, firm)`` hashes of names that can be similar: ``names (norm)`` against ``firm_names (name)``, distinct on both sides."""
    keys = _keys(names, firm_names)
    crowded = _crowded_pairs(names, firm_names.withColumn("firm_ord", F.lit(0)), *keys)
    return _sparse_pairs(*keys).union(crowded.select(F.xxhash64("norm"), F.xxhash64("name"))).distinct()


def company_matches(companies: DataFrame, firms: DataFrame) -> DataFrame:
    """``(company, firm_ord)`` for every distinct company; NULL when no firm matches.

    Distinct normalised names are looked up by equality, and compared with the
    firm names that share their rarest grams.  Candidate pairs are two 64-bit ids;
    they are made distinct, take their names and are compared once.  Those of
    crowded keys come with their names and are compared where they are found.
    """
    named = computed(companies.select("company"), {"norm": norm_firm(F.col("company"))})
    names = named.select("norm").distinct()
    firm_names = firms.groupBy(norm_firm(F.col("name")).alias("name")).agg(F.min("firm_ord").alias("firm_ord"))
    keys = _keys(names, firm_names)
    pairs = (
        _sparse_pairs(*keys).join(firm_names.withColumn("firm", F.xxhash64("name")), "firm")
        .join(names.withColumn("probe", F.xxhash64("norm")), "probe")
        .select("norm", "name", "firm_ord")
        .unionByName(_crowded_pairs(names, firm_names, *keys))
    )
    alike = pairs.where(similar(F.col("norm"), F.col("name"))).select("norm", "firm_ord")
    equal = names.join(exact_index(firms).withColumnRenamed("name", "norm"), "norm").select("norm", "firm_ord")
    found = alike.unionByName(equal).groupBy("norm").agg(F.min("firm_ord").alias("firm_ord"))
    return named.join(found, "norm", "left").select("company", "firm_ord")


def firm_match_exact(companies: DataFrame, firms: DataFrame) -> DataFrame:
    """``(company, firm_ord)`` by equal normalised name or alias."""
    names = exact_index(firms).withColumnRenamed("name", "norm")
    return companies.withColumn("norm", norm_firm(F.col("company"))).join(names, "norm").select(
        "company", "firm_ord"
    )


def firm_match_fuzzy(companies: DataFrame, firms: DataFrame) -> DataFrame:
    """``(company, firm_ord)``: the earliest firm by name, alias or similar name."""
    return company_matches(companies.select("company").distinct(), firms).where("firm_ord is not null")


def allow_list_semi(df: DataFrame, site_firms: DataFrame) -> DataFrame:
    """Rows whose company key is among the firms with a detected board."""
    keys = site_firms.select(F.col("firm_key").alias("__key")).where("firm_key <> ''").distinct()
    return df.withColumn("__key", norm_key(F.col("company"))).join(keys, "__key", "left_semi").drop("__key")


def firm_attributes(firms: DataFrame) -> DataFrame:
    """Firm rows under the names used on listings; keyed by ``firm_ord``."""
    return firms.select(
        "firm_ord",
        F.col("name").alias("firm_name"),
        "firm_type",
        F.col("industry").alias("firm_industry"),
        "firm_rank",
        F.col("specializations").alias("firm_specializations"),
        F.col("hq").alias("firm_hq"),
        F.col("hq_state").alias("firm_hq_state"),
        F.col("hq_city").alias("firm_hq_city"),
        F.col("size").alias("firm_size"),
        F.col("website").alias("firm_website"),
        F.col("linkedin").alias("firm_linkedin"),
    )


def company_firms(companies: DataFrame, firms: DataFrame, site_firms: DataFrame | None) -> DataFrame:
    """Firm attributes and allow-list mark per distinct company."""
    out = company_matches(companies, firms).join(firm_attributes(firms), "firm_ord", "left")
    if site_firms is None:
        return out.withColumn("allow_listed", F.lit(False))
    keys = (
        site_firms.select(F.col("firm_key").alias("__key"))
        .where("firm_key <> ''")
        .distinct()
        .withColumn("allow_listed", F.lit(True))
    )
    return (
        out.withColumn("__key", norm_key(F.col("company")))
        .join(keys, "__key", "left")
        .withColumn("allow_listed", F.coalesce("allow_listed", F.lit(False)))
        .drop("__key")
    )


def firm_gate(
    df: DataFrame,
    firms: DataFrame,
    site_firms: DataFrame | None = None,
    signals: dict[str, list[str]] = C.INDUSTRY_SIGNALS,
) -> DataFrame:
    """Keep rows of known firms, allow-listed firms, or with enough industry signals.

    Only rows of known firms carry firm attributes.  Matching runs once per
    distinct company.
    """
    companies = df.select("company").distinct()
    return apply_gate(df.join(company_firms(companies, firms, site_firms), "company", "left"), signals)


def gate_of(signals: Column) -> Column:
    """Why a row passes the gate: its firm, the allow list, or ``signals`` in its text; NULL if it does not."""
    return (
        F.when(F.col("firm_ord").isNotNull(), "firm")
        .when(F.col("allow_listed"), "allow_list")
        .when(signals, "signals")
    )


def apply_gate(df: DataFrame, signals: dict[str, list[str]] = C.INDUSTRY_SIGNALS) -> DataFrame:
    from hirestream.operators.filters import has_signals

    lowered = df.withColumn("__d", F.lower(F.coalesce("description", F.lit(""))))
    return computed(lowered, {"gate": gate_of(has_signals("__d", signals))}).where("gate is not null").drop("__d", "allow_listed")
