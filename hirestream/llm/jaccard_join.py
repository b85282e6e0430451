"""N-gram Jaccard join: exact links between texts whose shingle sets are similar, by T-occurrence search.

1. One pass over the texts cuts the hash space into parts (one more than two
   linked sets can differ in, see ``part_count``), so linked sets agree in at
   least one whole part.  A part's content is a signature.  Where few documents
   share one, counts of elements by hash range tell which of them can be near
   enough: the counts of two sets differ by no more than the sets do.  Where many
   do, each is tied to the smallest one instead, already inside an Arrow batch, so
   no pairs of a large group are made.
2. Connected components of these ties bound where links can be.  One text of
   each class of equal sets is sent to its component.
3. Inside a component the links are found with inverted lists: the short lists of
   a set are merged over a heap, the long ones are probed by binary search
   (DivideSkip), and sets with the required overlap are retained.
4. Components above ``block`` sets are dealt out in blocks.  First every block is
   searched together with a few pivots of the component, which joins most of it.
   For the sets outside the component's largest group, the counts tell which
   others can be near enough; components of these pairs are then searched, in
   blocks again where they are large.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirestream.llm.common import WordIds, columns, components, mix64, run_starts, stage

#: Share of the list search cost in DivideSkip's choice of the number of long lists.
MU = 0.0085
BLOCK = 64
PIVOTS = 4
SORTED_MERGE = 2000
#: Hash ranges whose element counts are compared, and sets per block of that comparison.
RANGES = 64
COUNT_BLOCK = 4096
#: Sets of so many elements get sixteen times as many ranges.
FINE_FROM = 600
#: Documents of one signature that are compared by their counts; where more share it, they are tied.
FEW = 16
#: Signatures that a task holds at a time.
PART_SIGNATURES = 200_000
#: Bytes of text whose signatures are sorted in one task.
TASK_BYTES = 8 << 20
#: Up to this number of parts, a set with an empty part also gets signatures with one element left out.
SMALL_PARTS = 24
_K1 = np.uint64(0x9E3779B97F4A7C15)


def shingles(word_ids: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of the k-word shingles; fewer words count as one shingle, no words as none."""
    n = len(word_ids)
    if not n:
        return word_ids
    width = min(n, k)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = mix64(h * _K1 + word_ids[j : n - width + 1 + j])
    h.sort()
    return h[run_starts(h)]


def size_bands(largest: int, percent: int) -> np.ndarray:
    """Lower bounds of bands of set sizes: linked sets lie in the same band or in neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds, np.int64)


def part_count(upper: int, percent: int) -> int:
    """Parts for sets of at most ``upper`` elements: linked sets differ in at most one element less."""
    return 2 * upper * (100 - percent) // (100 + percent) + 1


def signatures(s: np.ndarray, bands: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the parts of a set, for pairs in which it is the larger or the smaller one.

    A part that is empty in both sets proves nothing.  Where all parts that two
    sets share could be empty ones (few parts only: with more, the differing
    elements would have to hit every single part), parts with one element left out
    are signatures as well; sets with most parts empty share one signature.
    """
    band = int(np.searchsorted(bands, len(s), "right")) - 1
    mixed = mix64(s)
    out = []
    for scheme in (band, band + 1):
        upper = int(bands[scheme + 1]) - 1 if scheme + 1 < len(bands) else int(bands[scheme]) * 100 // percent
        parts = part_count(upper, percent)
        # the part grows with the hash, so each part is a stretch of the sorted set
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = run_starts(part)
        held = part[first]
        tag = mix64(np.array([scheme * 2 + 1], np.uint64) * _K1 + held)
        sums = np.add.reduceat(mixed, first)
        out.append(mix64(tag ^ mix64(sums)))
        empty = parts - len(first)
        if empty and parts <= SMALL_PARTS + 1:
            at = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(s)]))
            near = mix64(tag + np.uint64(1))
            out += [mix64(near ^ mix64(sums)), mix64(near[at] ^ mix64(sums[at] - mixed))]
        if 2 * empty >= parts + 1:
            out.append(mix64(np.array([scheme * 2], np.uint64) * _K1))
    return np.concatenate(out)


def element_counts(s: np.ndarray) -> bytes:
    """Elements by hash range, up to 255 each; sets of many elements get many narrow ranges as well."""
    wide = np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8)
    if len(s) < FINE_FROM:
        return wide.tobytes()
    fine = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=16 * RANGES)
    return wide.tobytes() + np.minimum(fine, 255).astype(np.uint8).tobytes()


def near_enough(a: list[bytes], b: list[bytes], room: np.ndarray) -> np.ndarray:
    """Whether counts of pairs differ by no more than ``room``; the widest ranges that both have are compared."""
    out = np.zeros(len(a), bool)
    fine = np.array([len(x) > RANGES and len(y) > RANGES for x, y in zip(a, b)], bool)
    for some, part in ((np.flatnonzero(~fine), slice(0, RANGES)), (np.flatnonzero(fine), slice(RANGES, None))):
        for at in range(0, len(some), 4096):
            i = some[at : at + 4096]
            x, y = (np.frombuffer(b"".join(v[j][part] for j in i), np.uint8).reshape(len(i), -1).astype(np.int16) for v in (a, b))
            out[i] = np.abs(x - y).sum(1, dtype=np.int64) <= room[i]
    return out


def _tie_batches(batches: Iterator[pa.RecordBatch], k: int, percent: int, part: int = PART_SIGNATURES) -> Iterator[pa.RecordBatch]:
    """The rows of ``_ties``; a batch is worked off in parts of about ``part`` signatures."""
    ids, bands = WordIds(), size_bands(1 << 20, percent)

    def rows(kind, key, a, b=None, n=None, c=None, counts=None):
        m = len(a)
        null = pa.nulls(m, pa.int64())
        as64 = lambda x: null if x is None else pa.array(x.astype(np.int64, copy=False))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, kind, object), pa.string()), *map(as64, (key, a, b, n, c)),
             pa.nulls(m, pa.binary()) if counts is None else pa.array(counts, pa.binary())],
            ["kind", "key", "a", "b", "n", "c", "counts"])

    def sent(sig: list, doc_rows: list, tied: list) -> Iterator[pa.RecordBatch]:
        if doc_rows:
            doc, n, c1, c2 = (np.array(x, t) for x, t in zip(zip(*(r[:4] for r in doc_rows)), (np.int64, np.int64, np.uint64, np.uint64)))
            yield rows("d", mix64(doc.astype(np.uint64)), doc, c1, n, c2, [r[4] for r in doc_rows])
        e = [np.array(tied, np.int64).reshape(-1, 2).T]
        if sig:
            g, o, n = (np.concatenate(x) for x in zip(*sig))
            sig.clear()
            order = np.lexsort((o, g))
            g, o, n = g[order], o[order], n[order]
            new = run_starts(g)
            size = np.diff(np.r_[new, len(g)])
            many, least = np.repeat(size > FEW, size), np.repeat(o[new], size)
            send = ~many | (o == least)
            yield rows("s", g[send], o[send], many[send].astype(np.int64), n[send])
            e.append(np.stack([o[~send], least[~send]]))
        e = np.concatenate(e, 1)
        e = e[:, np.lexsort(e)]
        e = e[:, run_starts(*e)]
        if e.shape[1]:
            yield rows("e", mix64(e[0].astype(np.uint64)), e[0], e[1])

    for batch in batches:
        sig, doc_rows, first_of, tied, held = [], [], {}, [], 0
        at = np.argsort(batch.column(0).to_numpy(zero_copy_only=False), kind="stable")
        for doc, text in zip(batch.column(0).take(pa.array(at)).to_pylist(), map(batch.column(1).__getitem__, at.tolist())):
            s = shingles(ids.of(text.as_py().encode("utf-8").lower().split()), k)
            if len(s) >= bands[-1]:
                bands = size_bands(2 * len(s), percent)
            mixed = mix64(s + _K1)
            same = int(mixed.sum(dtype=np.uint64)), int(mix64(mixed).sum(dtype=np.uint64)), len(s)
            doc_rows.append((doc, len(s), *same[:2], element_counts(s)))
            if not len(s):
                continue
            first = first_of.setdefault(same, doc)
            if first != doc:  # an equal set: its first document stands for it
                tied.append((doc, first))
                continue
            g = signatures(s, bands, percent)
            sig.append((g, np.full(len(g), doc, np.int64), np.full(len(g), len(s), np.int64)))
            held += len(g)
            if held > part:
                yield from sent(sig, doc_rows, tied)
                sig, doc_rows, tied, held = [], [], [], 0
        yield from sent(sig, doc_rows, tied)


def _ties(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Rows by ``kind``.  s: signature ``key``, document ``a``, its size ``n``, and ``b`` = 1 where many share it in the batch;
    e: a tie of ``a`` to ``b``; d: document ``a``, size ``n``, set hash ``b`` and ``c``, ``counts``; there ``key`` only spreads rows."""
    schema = "kind string, key long, a long, b long, n long, c long, counts binary"

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = docs.select(F.col(f"`{id_col}`").alias("doc"), text.alias("text")).where(F.col("doc").isNotNull())
    return named.mapInArrow(lambda batches: _tie_batches(batches, k, percent), schema)


def _near_pairs(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of documents that share a signature with few others and whose counts allow a link."""
    group = F.array_sort(F.collect_set(F.struct(F.col("a").alias("doc"), "n")))
    groups = shared.groupBy("key").agg(group.alias("g")).where(F.size("g") > 1)
    pairs = groups.select(F.explode(F.flatten(F.transform("g", lambda x, i: F.transform(
        F.slice("g", i + 2, FEW * FEW), lambda y: F.struct(x["doc"].alias("a"), y["doc"].alias("b"), x["n"].alias("n"), y["n"].alias("m")))
    ))).alias("p")).select("p.*").where((100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("a") != F.col("b"))).distinct()
    held = nodes.select("doc", "counts")
    pairs = pairs.join(held.withColumnsRenamed({"doc": "a", "counts": "x"}), "a").join(
        held.withColumnsRenamed({"doc": "b", "counts": "y"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy(zero_copy_only=False) + batch.column(3).to_numpy(zero_copy_only=False)
            room = (100 - percent) * n // (100 + percent)
            near = pa.array(near_enough(batch.column(4).to_pylist(), batch.column(5).to_pylist(), room))
            yield batch.select(["a", "b"]).filter(near)

    return pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


class Lists:
    """Inverted lists over the sets of one group, the sets in ascending order of size."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = len(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        element = np.concatenate(sets)
        owner = np.repeat(np.arange(n), sizes)
        order = np.lexsort((owner, element))
        element, owner = element[order], owner[order]
        first = run_starts(element)
        self.names, self.first = element[first], np.r_[first, len(element)]
        self.owner, self.n, self.sizes = owner, n, sizes
        #: list number and owner in one ascending key, for probing many lists at once
        self.key = np.repeat(np.arange(len(first)), np.diff(self.first)) * n + owner

    def search(self, q: int, percent: int, wanted) -> Iterator[int]:
        """The sets before ``q`` in order of size that reach the overlap; ``wanted(c)`` says if a set is of interest."""
        s = self.sets[q]
        size = len(s)
        low = -(-percent * size // 100)
        begin = int(np.searchsorted(self.sizes, low))
        if begin >= q:
            return
        need = -(-percent * (size + low) // (100 + percent))  # overlap with the smallest set of interest
        lists = np.searchsorted(self.names, s)
        # each list from the first set that is large enough up to the query
        a = np.searchsorted(self.key, lists * self.n + begin)
        b = np.searchsorted(self.key, lists * self.n + q)
        order = np.argsort(b - a, kind="stable")
        lists, a, b = lists[order], a[order], b[order]
        longest = int(b[-1] - a[-1])
        if not longest:
            return
        n_long = min(need - 1, int(need / (MU * math.log2(longest) + 1)))
        short = len(lists) - n_long
        filled = [self.owner[x:y] for x, y in zip(a[:short].tolist(), b[:short].tolist()) if y > x]
        if sum(map(len, filled)) > SORTED_MERGE:  # many entries: one sort merges them faster than a heap
            merged = np.sort(np.concatenate(filled)).tolist()
        else:
            merged = heapq.merge(*(x.tolist() for x in filled))
        probes = lists[short:] * self.n
        seen, count = -1, 0
        for c in (*merged, -1):
            if c == seen:
                count += 1
                continue
            if seen >= 0 and count >= need - n_long and wanted(seen):
                m = int(self.sizes[seen])
                keys = probes + seen
                at = np.searchsorted(self.key, keys)
                at[at == len(self.key)] = 0
                overlap = count + int((self.key[at] == keys).sum())
                if 100 * overlap >= percent * (size + m - overlap):
                    yield seen
            seen, count = c, 1


class Groups:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def _search_groups(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` inside each group of ``rows (grp, doc, label, asks, text)`` that join different labels.

    Sets with ``asks`` are looked up against all of the group, whether larger or
    smaller; the others among themselves are not.  A link is left out if its ends
    are already joined by others of the group or by equal labels.
    """
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids = WordIds()
        sets = [shingles(ids.of(t.encode("utf-8").lower().split()), k) for t in pdf["text"]]
        order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: (len(sets[i]), i))
        none = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        if len(order) < 2:
            return none
        doc, asks, label = pdf["doc"].to_numpy()[order], pdf["asks"].to_numpy()[order], pdf["label"].to_numpy()[order]
        lists, groups = Lists([sets[i] for i in order]), Groups(len(order))
        left, first = len(order), {}
        for i, x in enumerate(label.tolist()):
            j = first.setdefault(x, i)
            if j != i:
                groups.join(i, j)
                left -= 1
        links = []
        for q in range(len(order)):
            if left == 1:
                break
            for c in lists.search(q, percent, lambda c: (asks[q] or asks[c]) and groups.find(c) != groups.find(q)):
                groups.join(c, q)
                left -= 1
                links.append((doc[c], doc[q]))
        return pd.DataFrame(links, columns=["a", "b"]) if links else none

    return rows.groupBy("grp", "blk").applyInPandas(run, "a long, b long")


def _spread(df: DataFrame, size: int, mine: str, others: str) -> DataFrame:
    """The number of blocks of ``size`` sets that a group of ``m`` has, and a set's own block."""
    blocks = F.ceil(F.col("m") / size)
    return df.withColumns({mine: F.pmod(F.xxhash64("doc"), blocks), others: F.sequence(F.lit(0).cast("bigint"), blocks - 1)})


def _labels(large: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(grp, doc, label)`` after the links, and the sets ``(grp, doc)`` outside the largest label of their group."""
    joined = components(links).withColumnRenamed("node", "doc")
    state = stage(large.select("grp", "doc").join(joined, "doc", "left").select(
        "grp", "doc", F.coalesce("component", "doc").alias("label")), "labels")
    largest = state.groupBy("grp", "label").count().groupBy("grp").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    return state, stage(state.join(largest, "grp").where("label <> main").select("grp", "doc"), "outside")


def _near_counts(sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Ties ``(a, b)`` of sets of different labels whose element counts allow a link, for rows ``(grp, blk, qblk, doc, label, asks, n, counts)``.

    A task returns ties that connect what all its pairs connect, at most one for each of its sets.
    """
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        def arrays(part: pd.DataFrame) -> tuple:
            part = part.sort_values("n")
            held = part["counts"].tolist()
            counts = np.frombuffer(b"".join(x[:RANGES] for x in held), np.uint8).reshape(-1, RANGES).astype(np.int16)
            return part["doc"].to_numpy(), part["label"].to_numpy(), part["n"].to_numpy(), counts, held

        held, asking = arrays(pdf[~pdf["asks"]]), arrays(pdf[pdf["asks"]])
        docs, node = np.unique(np.r_[held[0], asking[0]], return_inverse=True)
        held_node, group = node[: len(held[0])], np.arange(len(docs))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        first = np.searchsorted(held[2], -(-percent * asking[2] // 100))
        last = np.searchsorted(held[2], asking[2] * 100 // percent, "right")
        for me, label, n, counts, whole, x, y in zip(node[len(held[0]) :], *asking[1:], first.tolist(), last.tolist()):
            other = (held[1][x:y] != label) & (group[held_node[x:y]] != group[me])
            at = x + np.flatnonzero(other)
            room = (100 - percent) * (held[2][at] + n) // (100 + percent)
            near = np.abs(held[3][at] - counts).sum(1) <= room
            at, room = at[near], room[near]
            if len(whole) > RANGES:
                at = at[near_enough([held[4][i] for i in at], [whole] * len(at), room)]
            joined, one = np.unique(group[held_node[at]], return_index=True)
            a.append(docs[held_node[at[one]]])
            b.append(np.full(len(one), docs[me]))
            group[np.isin(group, joined)] = group[me]
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return sets.groupBy("grp", "blk", "qblk").applyInPandas(run, "a long, b long")


def _element_counts(rows: DataFrame, k: int) -> DataFrame:
    """``(grp, doc, n, counts)`` of ``rows (grp, doc, text)``: set size, and elements by hash range (up to 255)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            sets = [shingles(ids.of(t.encode("utf-8").lower().split()), k) for t in batch.column(2).to_pylist()]
            counts = [element_counts(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(counts, pa.binary())],
                ["grp", "doc", "n", "counts"])

    return rows.select("grp", "doc", "text").mapInArrow(run, "grp long, doc long, n long, counts binary")


def _link_large(large: DataFrame, k: int, percent: int, block: int) -> list[DataFrame]:
    """Links of large groups ``(grp, doc, m, text)``; see the fourth step above."""
    dealt = _spread(large, block, "blk", "blocks")
    by_hash = F.min(F.struct(F.xxhash64(F.col("doc"), F.lit(1)), F.col("doc")))
    pivots = large.groupBy("grp", F.pmod(F.xxhash64("doc", F.lit(2)), F.lit(PIVOTS)).alias("p")).agg(
        by_hash.alias("x")).select("grp", F.col("x.doc").alias("doc"))
    sent = dealt.join(pivots, ["grp", "doc"]).select("grp", F.explode("blocks").alias("to"), "doc", "text", "blk").where(
        "to <> blk").select("grp", F.col("to").alias("blk"), "doc", "text")
    first = dealt.select("grp", "blk", "doc", "text").unionByName(sent).select(
        "grp", "blk", "doc", F.col("doc").alias("label"), F.lit(True).alias("asks"), "text")
    links = stage(_search_groups(first, k, percent), "links")
    state, outside = _labels(large, links)
    if outside.isEmpty():
        return [links]

    # which of the others can be near enough to a set outside
    asked = large.join(outside.select("grp").distinct(), "grp", "left_semi")
    counted = _element_counts(asked, k).join(state.select("doc", "label"), "doc").join(large.select("doc", "m"), "doc")
    counted = _spread(stage(counted, "element-counts"), COUNT_BLOCK, "own", "blocks")
    cols = ["grp", "blk", "qblk", "doc", "label", "n", "counts"]
    index = counted.withColumn("blk", F.col("own")).withColumn("qblk", F.explode("blocks")).select(*cols, F.lit(False).alias("asks"))
    asking = counted.join(outside, ["grp", "doc"], "left_semi").withColumn("qblk", F.col("own")).withColumn(
        "blk", F.explode("blocks")).select(*cols, F.lit(True).alias("asks"))
    pairs = stage(_near_counts(index.unionByName(asking), k, percent), "near-counts")

    regrouped = components(pairs).withColumnsRenamed({"node": "doc", "component": "grp"})
    sizes = regrouped.groupBy("grp").agg(F.count(F.lit(1)).alias("m"))
    again = large.select("doc", "text").join(regrouped.join(sizes, "grp"), "doc").join(state.select("doc", "label"), "doc")
    again = stage(again, "regrouped")
    zero = F.lit(0).cast("bigint").alias("blk")
    few = again.where(F.col("m") <= block).select("grp", zero, "doc", "label", F.lit(True).alias("asks"), "text")
    many = _spread(again.where(F.col("m") > block), block, "own", "blocks")
    # every set outside in every block; the sets that ask are dealt out in blocks as well
    n = F.size("blocks").cast("bigint")
    held = many.withColumn("q", F.explode("blocks")).select(
        "grp", (F.col("own") * n + F.col("q")).alias("blk"), "doc", "label", F.lit(False).alias("asks"), "text")
    ask = many.join(outside.select("doc"), "doc", "left_semi").withColumn("to", F.explode("blocks")).select(
        "grp", (F.col("to") * n + F.col("own")).alias("blk"), "doc", "label", F.lit(True).alias("asks"), "text")
    return [links, _search_groups(few.unionByName(held).unionByName(ask), k, percent)]


def jaccard_classes(docs: DataFrame, k: int = 3, percent: int = 90, block: int = BLOCK, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row with an id.

    Two texts are linked when ``100 * intersection >= percent * union`` of their
    sets of distinct k-word shingles (words in lower case A-Z; fewer words: the
    whole sequence is one shingle).  NULL and blank texts have no shingles and no
    links.  ``component_id`` is the smallest id that can be reached.  Rows that
    share an id are one node with the links of each; rows without id are left out
    here.  Equal rows come back as often as they occur; extra columns are ignored.
    """
    # as many tasks as the texts need, so that none has more signatures than it can sort in memory
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    ties = _ties(docs, k, percent, id_col, text_col).repartition(tasks, "kind", "key")
    key = W.partitionBy("kind", "key")
    is_sig = F.col("kind") == "s"
    marked = ties.withColumns({
        "m": F.when(is_sig, F.min("a").over(key)).otherwise(F.col("b")),
        "size": F.when(is_sig, F.count(F.lit(1)).over(key)), "big": F.when(is_sig, F.max("b").over(key))})
    narrow = stage(marked.where("kind <> 's' or size > 1"), "ties")
    few = f"kind = 's' and size <= {FEW} and big = 0"
    nodes = narrow.where("kind = 'd'").select(
        F.col("a").alias("doc"), "n", F.col("b").alias("c1"), F.col("c").alias("c2"), "counts")
    near = _near_pairs(narrow.where(few).select("key", "a", "n"), nodes, percent)
    tied = narrow.where(f"kind = 'e' or kind = 's' and not ({few}) and a <> m").select("a", F.col("m").alias("b"))
    edges = tied.unionByName(near)
    # written out, so that the join shuffles plain tables and a large class can be split
    classes = stage(nodes.groupBy("c1", "c2", "n").agg(F.min("doc").alias("rep")), "representatives")
    labelled = stage(
        nodes.join(classes, ["c1", "c2", "n"]).select("doc", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc")).alias("rep")),
        "classes")

    # one text of each class, in the components that can hold links
    where = components(edges).withColumnsRenamed({"node": "doc", "component": "grp"})
    reps = labelled.where("doc = rep and n > 0").select("doc").distinct()
    members = reps.join(where, "doc")
    counts = members.groupBy("grp").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stage(members.join(counts, "grp").select("doc", "grp", "m"), "members")
    text = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    candidates = stage(members.join(text, "doc"), "candidates")
    small = candidates.where(F.col("m") <= block).select(
        "grp", F.lit(0).cast("bigint").alias("blk"), "doc", F.col("doc").alias("label"), F.lit(True).alias("asks"), "text")
    found = [_search_groups(small, k, percent)]
    if members.where(F.col("m") > block).limit(1).count():
        found += _link_large(candidates.where(F.col("m") > block), k, percent, block)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    linked = components(links)
    smallest_id = F.coalesce("component", "rep").alias("component_id")
    return labelled.join(linked, labelled["rep"] == linked["node"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), smallest_id)


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row of each group of linked texts: the one with the smallest id, NULL ids last.

    Each row is a document of its own here: of repeated rows, of rows that share an
    id and of rows without id one stays where their texts are linked, and all stay
    where they are not.  Texts without words are linked with nothing and stay.  An
    empty table gives an empty table; extra columns pass through.
    """
    # written out once, so that a row keeps its number
    keyed = stage(docs.select(F.struct(*columns(docs)).alias("row"), F.monotonically_increasing_id().alias("rid")), "numbered-rows")
    doc, text = (F.col("row").getField(c) for c in (id_col, text_col))
    found = jaccard_classes(keyed.select("rid", text.alias("text")), k, percent, id_col="rid", text_col="text")
    ids = keyed.select("rid", F.struct(doc.isNull(), doc, "rid").alias("place"))
    first = found.join(ids, found["doc_id"] == ids["rid"]).groupBy("component_id").agg(F.min_by("rid", "place").alias("rid"))
    return keyed.join(first.select("rid"), "rid", "left_semi").select("row.*")
