"""The queries of this subpackage and their SQL, for the registry."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirestream.llm.common import documents, fold, let, stage, words_of
from hirestream.llm.jaccard_join import jaccard_classes
from hirestream.llm.line_dedup import dedup_lines
from hirestream.llm.mixing import mix_sources
from hirestream.llm.oracle_rules import quality_rules_sql
from hirestream.llm.packing import pack_documents
from hirestream.llm.passage_chains import shared_passages
from hirestream.llm.periodic_runs import periodic_runs
from hirestream.llm.ppm import score_texts
from hirestream.llm.prefix_trie import ordered_digest, prefix_trie, turn_sequences
from hirestream.llm.quality_classifier import classify_quality
from hirestream.llm.quality_rules import quality_rules
from hirestream.llm.simhash_grid import simhash_classes
from hirestream.llm.suffix_dedup import remove_repeats
from hirestream.llm.topk import top_k

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target",
                        (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 4) == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classify_quality(documents(spark, sf_dir).select("doc_id", "text"), labels, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
                         "rules.n_repeat_words", "rules.base_failed", "rules.kept")


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), TOKENIZER)


@query
def op4_passage_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(documents(spark, sf_dir))


@query
def op5_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = score_texts(documents(spark, sf_dir).select("doc_id", "text"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir), k=3, percent=90)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(documents(spark, sf_dir), length=50)
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
                       F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "lines.n_lines", "lines.n_removed", F.array_join("lines.removed", ",").alias("removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: Lines with their words; the windows that start at them; the first place of each window.
ORACLE["op10_line_dedup"] = r"""
with split as (select doc_id, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10)) as ls from documents),
rows as (select doc_id, t, ls, unnest(range(len(ls))) as i from split),
lines as (
  select doc_id, i, ls[i + 1] as l, len(regexp_extract_all(ls[i + 1], '[^\x20\x09-\x0D]+')) as w
  from rows where regexp_matches(ls[i + 1], '[^\x20\x09-\x0D]')),
ahead as (
  select *, lead(l) over o as l1, lead(w) over o as w1, lead(i) over o as i1,
    lead(l, 2) over o as l2, lead(i, 2) over o as i2
  from lines window o as (partition by doc_id order by i)),
wins as (
  select doc_id, i as line, case when w >= 50 then i when w + w1 >= 50 then i1 else i2 end as last,
    case when w >= 50 then l when w + w1 >= 50 then l || chr(10) || l1 else l || chr(10) || l1 || chr(10) || l2 end as k
  from ahead),
later as (
  select doc_id, line, last from (
    select *, row_number() over (partition by k order by doc_id, line) as n from wins where k is not null) where n > 1),
gone as (
  select distinct a.doc_id, a.i from lines a join later b on a.doc_id = b.doc_id and a.i between b.line and b.last),
per as (select doc_id, count(*) as n, string_agg(i::varchar, ',' order by i) as removed, list(i) as g from gone group by doc_id),
n as (select doc_id, count(*) as n_lines from lines group by doc_id)
select s.doc_id, coalesce(n.n_lines, 0) as n_lines, coalesce(p.n, 0) as n_removed, coalesce(p.removed, '') as removed,
  sha256(case when p.n is null then s.t else coalesce(array_to_string(
    [x for x, i in s.ls if not list_contains(p.g, i - 1)], chr(10)), '') end) as kept_sha256
from split s left join per p using (doc_id) left join n using (doc_id)
"""


@query
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


ORACLE["op7_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""


#: Positions, weights and the water level of the sources; then the prefix in hash order and the closing document.
ORACLE["op1_mix_sources"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix-1:' || coalesce(doc_id::varchar, '')) as key from documents),
s as (
  select source, sum(size) as ss, row_number() over (order by source is null, source) as pos from d group by source),
w as (select *, ([3, 1, 2])[(pos - 1) % 3 + 1] as weight, 2.0::double * ss as cap from s),
o as (
  select *, (1.5::double * (select sum(ss) from s) - coalesce(sum(cap) over (
      order by cap / weight, pos rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, pos rows between current row and unbounded following) as level from w),
l as (select arg_min(level, (cap / weight, pos)) as level from o where cap >= level * weight),
t as (select source, ss, coalesce(least(cap, l.level * weight), cap) as target from w, l),
p as (select *, case when ss > 0 then floor(target / ss) else 0 end as whole, target - case when ss > 0 then floor(target / ss) else 0 end * ss as need from t),
r as (
  select d.*, p.ss, p.target, p.whole, p.need, sum(size) over (partition by d.source order by key, size) as upto
  from d join p on d.source is not distinct from p.source),
m as (select source, any_value(need) - coalesce(max(upto) filter (upto <= need), 0) as missing from r group by source),
c as (
  select r.source, arg_min((r.key, r.size), (abs(r.size - m.missing), r.key, r.size)) as closing
  from r join m on r.source is not distinct from m.source
  where r.upto > r.need and r.size > 0 and r.size < 2 * m.missing group by r.source),
b as (
  select r.source, r.size - m.missing as over from c join m on c.source is not distinct from m.source
  join r on r.source is not distinct from c.source and (r.key, r.size) = c.closing where r.size > m.missing),
x as (
  select r.source, arg_min((r.key, r.size), (abs(r.size - b.over), r.key, r.size)) as left_out
  from r join b on r.source is not distinct from b.source where r.upto <= r.need and r.size > 0 and r.size < 2 * b.over group by r.source)
select r.doc_id, r.size::bigint as size, r.ss::bigint as source_size, r.target,
  (r.size * (r.whole + case when r.upto <= r.need and not coalesce((r.key, r.size) = x.left_out, false)
    or coalesce((r.key, r.size) = c.closing, false) then 1 else 0 end))::bigint as taken
from r left join c on r.source is not distinct from c.source left join x on r.source is not distinct from x.source
"""

#: Shingle sets, pairs that share a shingle, and the closure of the links.
ORACLE["op6_jaccard_join"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 90 * (x.n + y.n - o)),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, r) as (
  select doc_id, doc_id from documents union select reach.doc_id, both_ways.b from reach join both_ways on both_ways.a = reach.r),
least_id as (select doc_id, min(r) as component_id from reach group by doc_id)
select l.doc_id, coalesce(n.n, 0) as n_shingles, l.component_id from least_id l left join n using (doc_id)
"""

ORACLE["op3_quality_rules"] = quality_rules_sql()


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth (by checksum of the id) repeats a few of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " "))

    text = F.when(h % 10 == 0, let(words_of(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeated_tail(documents(spark, sf_dir)), out="found")
    runs = F.col("found.runs")
    longest = F.array_min(F.transform(runs, lambda r: F.struct(-r["length"], r["start"], r["period"])))
    found = found.withColumn("longest", longest)
    length, start, period = -F.col("longest.col1"), F.col("longest.start"), F.col("longest.period")
    listed = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size(runs) > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size(runs).cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_borrowed_heads(sequences: DataFrame) -> DataFrame:
    """Conversations whose first turns come from the first conversation of their hundred."""
    own = stage(sequences, "turn-sequences")
    heads = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), n)
    rest = F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0)))
    return own.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("base"), "left").select(
        "conv_id", F.concat(head, rest).alias("turns"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    trie = prefix_trie(with_borrowed_heads(turn_sequences(conversations)))
    digests = ordered_digest(trie.ends, "node", "conv_id", "ends_sha256")
    return trie.nodes.join(digests, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


#: The checksum byte by byte and bit by bit; nodes are the lists of first turns; subtrees by the lists that go on.
ORACLE["op12_prefix_trie"] = """
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (
  select conv_id, list(md5(length(role)::varchar || ':' || role || text) || length(text)
    order by turn nulls first, md5(length(role)::varchar || ':' || role || text)) as turns from t group by conv_id),
h as (
  select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
      lambda x, i: xor(x >> 1, case when x % 2 = 1 then 3988292384::bigint else 0 end))), 4294967295::bigint) % 6 as h from own),
r as (
  select h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) as turns
  from h left join own b on b.conv_id = h.conv_id - h.conv_id % 100),
n as (
  select turns[1:d] as path, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(turns) = d), '')) as ends_sha256
  from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from r) group by all),
k as (select path[1:depth - 1] as path, count(*) as n from n where depth > 0 group by all),
e as (
  select n.*, coalesce(k.n, 0) as n_children,
    case when depth = 0 then 0 else (n_convs - 1) * substr(path[depth], 33)::bigint end as own
  from n left join k using (path)),
s as (
  select path[1:d] as path, sum((n_children = 0)::int) as n_leaves, sum(own) as saved
  from (select path, n_children, own, unnest(range(depth + 1)) as d from e) group by all)
select e.conv_id, e.depth, p.conv_id as parent_conv_id, e.n_convs, e.n_children, s.n_leaves::bigint as n_leaves,
  s.saved::bigint as saved_tokens, e.ends_sha256
from e join s using (path) left join n p on e.depth > 0 and p.path = e.path[1:e.depth - 1]
"""


@query
def op13_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
