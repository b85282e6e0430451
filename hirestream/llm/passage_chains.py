"""Fuzzy passages that documents share: seeds, collinear chains, alignment.

1. Seeds are hashes of ``k`` words, the smallest of each window of neighbours.
   Each carries hashes of the runs of 2, 4 and 8 seeds that begin with it.  The
   documents of a seed or run are not paired with each other: each is tied to the
   one before it and to the first one, first among the rows of a part of a task,
   then among the parts, so the ties grow with the documents.  Holders of the same
   stretch meet by its runs, however often its lines also stand alone.
2. Ties of two documents meet; collinear chains of their seeds are found with a
   tree over the places in the source that holds the seeds within the gap limit,
   a gap costing its length in both.
3. The words around each chain are fetched for both sides and aligned: gaps
   between seeds by an edit path, the ends outwards as long as it pays.
4. Where that leaves a tied place without a passage, all holders count: documents
   that share two seeds near it meet, all with all, in blocks, with the words
   around.  Those that can have a passage there are chained and aligned as well; of
   those with the same words between the seeds, the one that goes along furthest.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import (
    WordIds, by_bucket, first_minimum, mix64, packed, packed_texts, run_starts, stage, unpacked,
)

#: Seeds of a run.
RUNS = (2, 4, 8)
_SEED = np.dtype([("h", "<u8"), ("doc", "<i8"), ("pos", "<u4"), *((f"run{n}", "<u8") for n in RUNS), *((f"len{n}", "<u2") for n in RUNS)])
_PRIME = np.uint64(0x9E3779B97F4A7C15)
PART_SEEDS = 500_000
#: Places of one pair of seeds that are compared with as many others in a task, and places that are paired at once.
PAIR_BLOCK = 2048
PLACES = 20_000


@dataclass(frozen=True)
class Chaining:
    """Sizes in words; ``gap_cost`` per word of a gap in either text."""

    k: int = 6
    window: int = 10
    min_words: int = 50
    min_identity: float = 0.8
    gap_cost: float = 0.05
    max_gap: int = 80
    flank: int = 60
    drop: int = 8


def word_seeds(ids: np.ndarray, c: Chaining) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the chosen seeds, in the order of the text."""
    n = len(ids) - c.k + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(c.k):
        h = mix64(h * _PRIME + ids[j : j + n])
    at = first_minimum(h, min(c.window, n))
    at = at[run_starts(at)]
    return h[at], at


def _seed_rows(ids: np.ndarray, doc: int, c: Chaining) -> np.ndarray:
    """Seeds with their runs: hash, and distance of the last seed from the first, 0 where the text ends before."""
    h, at = word_seeds(ids, c)
    rows = np.zeros(len(h), _SEED)
    rows["h"], rows["pos"], rows["doc"] = h, at, doc
    for n in RUNS:
        if len(at) < n:
            break
        h = mix64(h[: -n // 2] * _PRIME + h[n // 2 :])
        rows[f"run{n}"][: len(h)], rows[f"len{n}"][: len(h)] = h, at[n - 1 :] - at[: len(h)]
    return rows


_TIE = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("h", pa.int64()), ("doc", pa.int64()), ("src", pa.int64()),
                  ("pos", pa.int32()), ("spos", pa.int32()), ("len", pa.int32()), ("slen", pa.int32())])
_TIE_COLUMNS = "h long, doc long, src long, pos int, spos int, len int, slen int"


def _ties(rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ties of seeds and runs to the document before and to the first, and the rows of each one's first document.

    A tie is ``(h, doc, src, pos, spos, len, slen)``: the first seed of the run in both
    texts, and how far behind it the last one is (0 for a seed alone).  Each place in
    the document is tied, to the first place in the source; shorter runs only where
    longer ones have not led to the same place.  Further places of a seed in its
    first document are tied to themselves, so that each is listed.  What this leaves
    is settled by ``_chains_of_all``.
    """
    rows = rows[np.lexsort((rows["pos"], rows["doc"], rows["h"]))]
    first = run_starts(rows["h"])
    sizes = np.diff(np.r_[first, len(rows)])
    shared = np.repeat(rows["doc"][first] != rows["doc"][first + sizes - 1], sizes)
    leads = ~shared
    of_seed = np.flatnonzero(shared)
    chosen, out = [], []
    for n in (*RUNS[::-1], 1):
        at, keys = of_seed, [rows["h"]]
        if n > 1:
            at = at[rows[f"len{n}"][at] > 0]
            at = at[np.lexsort((rows[f"run{n}"][at], rows["h"][at]))]
            keys.append(rows[f"run{n}"])
        keys = [k[at] for k in keys]
        group, own = run_starts(*keys), run_starts(*keys, rows["doc"][at])
        head = np.repeat(group, np.diff(np.r_[group, len(at)]))
        times = np.diff(np.r_[own, len(at)])
        mine, before = np.repeat(own, times), np.repeat(np.r_[own[:1], own[:-1]], times)
        leads[at[mine == head]] = True
        for source, use in ((head, mine > head), (before, (mine > head) & (before > head))):
            d, s = at[use], at[source[use]]
            for c in chosen:
                new = c[d] != s
                d, s = d[new], s[new]
            taken = np.full(len(rows), -1)
            taken[d] = s
            chosen.append(taken)
            far = [rows[f"len{n}"][i] if n > 1 else np.zeros(len(i), np.int64) for i in (d, s)]
            out.append([rows["h"][d].view(np.int64), rows["doc"][d], rows["doc"][s], rows["pos"][d], rows["pos"][s], *far])
    again = at[(mine == head) & (np.arange(len(at)) > head)]
    doc, pos, zero = rows["doc"][again], rows["pos"][again], np.zeros(len(again), np.int64)
    out.append([rows["h"][again].view(np.int64), doc, doc, pos, pos, zero, zero])
    cols = [np.concatenate(c) for c in zip(*out)]
    return cols[:3] + [c.astype(np.int32) for c in cols[3:]], rows[leads]


def _tie_batch(t: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    spread = (mix64(t[1].astype(np.uint64) * _PRIME ^ t[3].astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(spread), pa.nulls(len(spread), pa.binary()), *map(pa.array, t)], schema=_TIE)


def _find_seeds(texts: DataFrame, c: Chaining, buckets: int) -> DataFrame:
    """Seeds as packed arrays per bucket, and the ties inside a part of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            parts, held = [], 0
            for i in range(batch.num_rows):
                words = batch.column(1)[i].as_py().encode("utf-8").lower().split()
                if len(words) >= c.min_words:
                    r = _seed_rows(ids.of(words), batch.column(0)[i].as_py(), c)
                    parts.append(r)
                    held += len(r)
                if held > PART_SEEDS or held and i == batch.num_rows - 1:
                    ties, firsts = _ties(np.concatenate(parts))
                    parts, held = [], 0
                    if len(ties[0]):
                        yield _tie_batch(ties, buckets)
                    named = list(by_bucket(firsts, buckets))
                    k = len(named)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b for b, _ in named], pa.int32()), pa.array([packed(x) for _, x in named], pa.binary()),
                         *[pa.nulls(k, pa.int64())] * 3, *[pa.nulls(k, pa.int32())] * 4], schema=_TIE)

    return texts.mapInArrow(run, f"bucket int, blob binary, {_TIE_COLUMNS}")


def _meet(seeds: DataFrame) -> DataFrame:
    """All ties: those found already, and those between the first documents of the parts."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = table.filter(table.column("blob").is_null()).select(_TIE.names[2:])
        blobs = [unpacked(b, _SEED) for b in table.column("blob").drop_null().to_pylist()]
        if not blobs:
            return found
        t, _ = _ties(np.concatenate(blobs))
        more = pa.table(t, _TIE.names[2:])
        return pa.concat_tables([found.cast(more.schema), more])

    return seeds.groupBy("bucket").applyInArrow(run, _TIE_COLUMNS)


class RangeBest:
    """Largest value, with its item, among the seeds present in a range of places; seeds can be taken out again."""

    def __init__(self, n: int):
        self.n = n
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (2 * n)
        self.held: list[deque[tuple[float, int]]] = [deque() for _ in range(n)]

    def _refresh(self, place: int) -> None:
        at, best = place + self.n, self.best
        best[at] = self.held[place][0] if self.held[place] else (float("-inf"), -1)
        at >>= 1
        while at:
            best[at] = max(best[2 * at], best[2 * at + 1])
            at >>= 1

    def put(self, place: int, value: float, item: int) -> None:
        """Items are put in, and taken out again, in rising order."""
        held = self.held[place]
        while held and held[-1][0] <= value:
            held.pop()
        held.append((value, item))
        if len(held) == 1:
            self._refresh(place)

    def take(self, place: int, item: int) -> None:
        held = self.held[place]
        if held and held[0][1] == item:
            held.popleft()
            self._refresh(place)

    def between(self, low: int, high: int) -> tuple[float, int]:
        """Among places from ``low`` up to but not including ``high``."""
        found, low, high = (float("-inf"), -1), low + self.n, high + self.n
        while low < high:
            if low & 1:
                found = max(found, self.best[low])
                low += 1
            if high & 1:
                high -= 1
                found = max(found, self.best[high])
            low, high = low >> 1, high >> 1
        return found


def _links(seeds: list[tuple[int, int]], c: Chaining) -> tuple[list[float], list[int]]:
    """Score of the best chain up to each of the sorted seeds, and the seed before it there (-1: none).

    Each seed follows the best of all seeds within ``max_gap`` before it: those that
    do not overlap it in the document are in a tree, the few that do are looked at
    one by one.
    """
    places = sorted({s for _, s in seeds})
    ranks = {s: i for i, s in enumerate(places)}
    tree, score, back, value = RangeBest(len(places)), [], [], []
    put = taken = 0
    for j, (pos, spos) in enumerate(seeds):
        while seeds[put][0] <= pos - c.k:
            tree.put(ranks[seeds[put][1]], value[put], put)
            put += 1
        while seeds[taken][0] < pos - c.max_gap and taken < put:
            tree.take(ranks[seeds[taken][1]], taken)
            taken += 1
        here, own = c.gap_cost * (pos + spos), ranks[spos]
        low, near = bisect_left(places, spos - c.max_gap), bisect_left(places, spos - c.k + 1)
        best, i = tree.between(low, near)
        best += c.k
        for r in range(max(low, near), own):  # overlaps in the source
            if tree.held[r] and tree.held[r][0][0] + spos - places[r] > best:
                best, i = tree.held[r][0][0] + spos - places[r], tree.held[r][0][1]
        for q in range(put, j):  # overlaps in the document
            p, s = seeds[q]
            if p < pos and p >= pos - c.max_gap and 0 < spos - s <= c.max_gap and value[q] + min(c.k, pos - p, spos - s) > best:
                best, i = value[q] + min(c.k, pos - p, spos - s), q
        linked = best - here > c.k
        score.append(best - here if linked else float(c.k))
        back.append(i if linked else -1)
        value.append(score[j] + here)
    return score, back


def _rising_links(pos: list[int], spos: list[int], c: Chaining) -> tuple[list[float], list[int]]:
    """``_links`` of seeds that rise in both texts, each on the diagonal of the one before or overlapping it in neither.

    Values rise with the seeds then, so the best one that does not overlap is the
    last one: no tree is needed.
    """
    score, back, value = [], [], []
    put, none, k = 0, float("-inf"), c.k
    for j, (p, s) in enumerate(zip(pos, spos)):
        while pos[put] <= p - k:
            put += 1
        here, best, i = c.gap_cost * (p + s), none, -1
        if put and pos[put - 1] >= p - c.max_gap and spos[put - 1] >= s - c.max_gap:
            best, i = value[put - 1] + k, put - 1
        for q in range(put, j):
            if p - pos[q] <= c.max_gap and value[q] + (p - pos[q]) > best:
                best, i = value[q] + (p - pos[q]), q
        if best - here > k:
            score.append(best - here)
            back.append(i)
        else:
            score.append(float(k))
            back.append(-1)
        value.append(score[j] + here)
    return score, back


def _taken_apart(seeds: list[tuple[int, int]], score: list[float], back: list[int]) -> list[list[tuple[int, int]]]:
    used, out = [False] * len(seeds), []
    for j in sorted(range(len(seeds)), key=lambda j: (-score[j], j)):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(seeds[j])
            j = back[j]
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


def chains(seeds: list[tuple[int, int]], c: Chaining) -> list[list[tuple[int, int]]]:
    """Chains of seeds ``(pos, spos)`` that rise in both texts, best first; every seed is in one chain at most.

    A seed is worth its words; the gap from one seed to the next costs ``gap_cost``
    per word in both texts, and gaps beyond ``max_gap`` are not bridged.  Seeds that overlap are
    worth the words they add.
    """
    seeds = sorted(set(seeds))
    return _taken_apart(seeds, *_links(seeds, c))


def chains_of_groups(group: np.ndarray, pos: np.ndarray, spos: np.ndarray, c: Chaining) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """``(group, chain)``: the ``chains`` of many groups of seeds at once, in any order inside a group.

    Seeds further apart than ``max_gap`` in the document never follow each other, so
    the stretches between are settled by themselves; the tree is left to those whose
    seeds do not rise one after the other.
    """
    order = np.lexsort((spos, pos, group))
    group, pos, spos = group[order], pos[order], spos[order]
    once = run_starts(group, pos, spos)
    group, pos, spos = group[once], pos[once], spos[once]
    dp, ds = np.diff(pos), np.diff(spos)
    far = (group[1:] != group[:-1]) | (dp > c.max_gap)
    rising = (dp > 0) & (ds > 0) & ((dp == ds) | (np.minimum(dp, ds) >= c.k))
    odd = np.r_[0, np.cumsum(~far & ~rising)].tolist()
    cuts = [0, *(np.flatnonzero(far) + 1).tolist(), len(pos)]
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            p, s = pos[a:b].tolist(), spos[a:b].tolist()
            seeds = list(zip(p, s))
            links = _links(seeds, c) if odd[b - 1] > odd[a] else _rising_links(p, s, c)
            for chain in _taken_apart(seeds, *links):
                yield int(group[a]), chain


def _chain_pairs(ties: DataFrame, c: Chaining, least: int) -> DataFrame:
    """``(doc, src, no, pos, spos)``: chains of ``least`` words or more, their places as arrays."""
    schema = "doc long, src long, no long, pos array<int>, spos array<int>"

    kind = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ties = batch.column(2)
            times = np.diff(ties.offsets.to_numpy())
            pos, spos, far, sfar = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in ties.flatten().flatten())
            group, more = np.repeat(np.arange(batch.num_rows), times), far > 0
            group, pos, spos = np.r_[group, group[more]], np.r_[pos, (pos + far)[more]], np.r_[spos, (spos + sfar)[more]]
            at, out = [], ([], [])
            for g, chain in chains_of_groups(group, pos, spos, c):
                if min(chain[-1][0] - chain[0][0], chain[-1][1] - chain[0][1]) + c.k >= least:
                    at.append(g)
                    for side, places in zip(out, zip(*chain)):
                        side.append(places)
            at = np.array(at, np.int64)
            first = run_starts(at)
            no = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(no, pa.int64()), *(pa.array(v, kind) for v in out)],
                ["doc", "src", "no", "pos", "spos"])

    grouped = ties.groupBy("doc", "src").agg(
        F.collect_list(F.struct("pos", "spos", "len", "slen")).alias("ties"), F.max("len").alias("far"))
    return grouped.where((F.size("ties") > 1) | (F.col("far") > 0)).select("doc", "src", "ties").mapInArrow(run, schema)


def _cut_words(asked: DataFrame) -> DataFrame:
    """``(doc, src, no, side, base, words)``: hashes of the words that chains ask of a text, for rows ``(z, asks)``."""
    schema = "doc long, src long, no long, side int, base int, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unzip = WordIds(), zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                words = ids.of(unzip.decompress(batch.column(0)[i].as_py()).lower().split())
                for a in batch.column(1)[i].as_py():
                    base = max(0, a["start"])
                    part = words[base : max(base, a["stop"])]
                    out.append((a["doc"], a["src"], a["no"], a["side"], base, part.astype("<u8").tobytes()))
            cols = list(zip(*out)) if out else [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)],
                                             ["doc", "src", "no", "side", "base", "words"])

    return asked.select("z", "asks").mapInArrow(run, schema)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short arrays."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        diagonal = row[:-1] + (b == x)
        new = row.copy()
        new[1:] = np.maximum(row[1:], diagonal)
        row = np.maximum.accumulate(new)
    return int(row[-1])


def _extend(a: np.ndarray, b: np.ndarray, drop: int) -> tuple[int, int]:
    """How far two arrays go along from their beginning, and the equal words: a word counts 1, a difference -1, up to a drop."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    total = np.cumsum(np.where(same, 1, -1))
    high = np.maximum.accumulate(np.maximum(total, 0))
    fallen = np.flatnonzero(high - total > drop)
    total = total[: fallen[0]] if len(fallen) else total
    if not len(total) or total.max() <= 0:
        return 0, 0
    best = int(total.argmax()) + 1
    return best, int(same[:best].sum())


def align(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]], c: Chaining) -> tuple[int, int, int, int, int]:
    """``(start, stop, source start, source stop, equal words)`` of the passage around a chain."""
    p, s = chain[0]
    equal, at, sat = 0, p, s
    for pos, spos in chain:
        if pos < at or spos < sat:  # overlaps what is aligned
            by = max(at - pos, sat - spos)
            if by >= c.k:
                continue
            pos, spos, size = pos + by, spos + by, c.k - by
        else:
            size = c.k
        x, y = a[at:pos], b[sat:spos]
        equal += int((x == y).sum()) if len(x) == len(y) and (x == y).sum() * 2 >= len(x) else common_words(x, y)
        at, sat, equal = pos + size, spos + size, equal + size
    ahead, same = _extend(a[at:], b[sat:], c.drop)
    behind, same_ = _extend(a[:p][::-1], b[:s][::-1], c.drop)
    return p - behind, at + ahead, s - behind, sat + ahead, equal + same + same_


def _open_places(ties: DataFrame, found: DataFrame, c: Chaining) -> DataFrame:
    """``(h, doc, pos, open)``: tied places that no passage covers (``open``), and the tied ones within twice ``min_words`` of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, spans = batch.column(1), batch.column(2)
            row, held = (np.repeat(np.arange(batch.num_rows), np.diff(x.offsets.to_numpy())) << 32 for x in (places, spans))
            pos, h = (f.to_numpy(zero_copy_only=False) for f in places.flatten().flatten())
            start, stop = (f.to_numpy(zero_copy_only=False) + held for f in spans.flatten().flatten())
            order = np.argsort(start, kind="stable")
            start, stop = np.r_[-1, start[order]], np.r_[-1, np.maximum.accumulate(stop[order])]
            key = pos + row
            open_ = stop[np.searchsorted(start, key, "right") - 1] < key + c.k
            left = np.sort(key[open_])
            at = np.flatnonzero(np.searchsorted(left, key - 2 * c.min_words) < np.searchsorted(left, key + 2 * c.min_words, "right"))
            doc = batch.column(0).take(pa.array(row[at] >> 32))
            yield pa.RecordBatch.from_arrays([pa.array(h[at]), doc, pa.array(pos[at].astype(np.int32)), pa.array(open_[at])],
                                             ["h", "doc", "pos", "open"])

    places = ties.where("doc <> src").groupBy("doc").agg(F.collect_set(F.struct("pos", "h")).alias("places"))
    spans = found.groupBy(F.col("doc_id").alias("who")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    both = places.join(spans, F.col("doc") == F.col("who"), "left")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return both.select("doc", "places", F.coalesce("spans", none).alias("spans")).mapInArrow(run, "h long, doc long, pos int, open boolean")


def _seed_pairs(places: DataFrame, c: Chaining) -> DataFrame:
    """``(key, doc, open, i, j)``: pairs of seeds within twice ``min_words``, for rows ``(doc, places)``; ``open`` if one place of the pair is.

    Where a pair follows itself within a seed, as in repeated words, the first, the last and one in ``min_words`` places stand for all.
    """
    def pairs(row: np.ndarray, pos: np.ndarray, h: np.ndarray, open_: np.ndarray) -> list[np.ndarray]:
        order = np.lexsort((~open_, h, pos, row))
        order = order[run_starts(row[order], pos[order], h[order])]
        row, pos, h, open_ = row[order], pos[order], h[order], open_[order]
        at = []
        for step in range(1, len(row)):
            i = np.flatnonzero((row[step:] == row[:-step]) & (pos[step:] - pos[:-step] <= 2 * c.min_words))
            if not len(i):
                break
            at.append((i, i + step))
        i, j = (np.concatenate(x) for x in zip(*at)) if at else (np.empty(0, np.int64),) * 2
        key = mix64(h[i] * _PRIME + h[j])
        order = np.lexsort((pos[j], pos[i], key, row[i]))
        key, i, j = key[order], i[order], j[order]
        own = run_starts(row[i], key)
        asks = np.repeat(np.maximum.reduceat(open_[i] | open_[j], own), np.diff(np.r_[own, len(i)])) if len(i) else np.empty(0, bool)
        begin = np.ones(len(i), bool)
        begin[1:] = np.diff(pos[i]) > c.k
        begin[own] = True
        first = np.flatnonzero(begin)
        part = (pos[i] - np.repeat(pos[i][first], np.diff(np.r_[first, len(i)]))) // c.min_words
        some = begin | np.r_[begin[1:], True][: len(i)] | (np.diff(part, prepend=0) != 0)
        return [key[some].view(np.int64), row[i][some], asks[some], pos[i][some], pos[j][some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(1)
            ends = places.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            pos, h, open_ = (f.to_numpy(zero_copy_only=False) for f in places.flatten().flatten())
            for part in np.split(np.arange(len(row)), ends[run_starts(ends // PLACES)][1:] - ends[0]):
                key, at, asks, i, j = pairs(row[part], pos[part].astype(np.int64), h[part].view(np.uint64), open_[part].astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(pa.array(at)), pa.array(asks), *(pa.array(x.astype(np.int32)) for x in (i, j))],
                    ["key", "doc", "open", "i", "j"])

    return places.mapInArrow(run, "key long, doc long, open boolean, i int, j int")


def _contexts(asked: DataFrame, c: Chaining) -> DataFrame:
    """Places of pairs of seeds, for rows ``(doc, z, asks)``, with the words ``around``, ``min_words`` to each side, and those they span
    (``inner``), two bytes a word.  Of places of a text that are alike in this, the first is marked, and one in ``min_words`` stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unzip, n = WordIds(), zstandard.ZstdDecompressor(), c.min_words
        for batch in batches:
            out, held = {}, set()
            for doc, z, asks in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = ids.of(unzip.decompress(z).lower().split())
                short = np.zeros(len(words) + 2 * n, np.uint16)
                short[n : n + len(words)] = np.maximum(words.astype(np.uint16), 1)
                for a in sorted(asks, key=lambda a: (a["i"], a["j"])):
                    i, j = a["i"], a["j"] + c.k
                    if j <= len(words):
                        around = short[i : i + n][::-1].tobytes() + short[j + n : j + 2 * n].tobytes()
                        alike = a["key"], doc, short[i + n : j + n].tobytes(), around
                        first = alike not in held
                        held.add(alike)
                        if first or a["open"]:
                            out.setdefault((*alike, i // n), (a["m"], a["open"], first, i, a["j"]))
            cols = [list(x) for x in zip(*((*k[:4], *v) for k, v in out.items()))] or [[]] * 9
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds)],
                                             ["key", "doc", "inner", "around", "m", "open", "first", "i", "j"])

    return asked.mapInArrow(run, "key long, doc long, inner binary, around binary, m long, open boolean, first boolean, i int, j int")


def _reach(same: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """How far rows go along, and the equal words there, as in ``_extend``."""
    total = np.cumsum(np.where(same, 1, -1), 1, dtype=np.int16)
    high = np.maximum(np.maximum.accumulate(total, 1), 0)
    total[np.maximum.accumulate(high - total > drop, 1)] = -1
    best, gain = total.argmax(1) + 1, total.max(1)
    return np.where(gain > 0, best, 0), np.where(gain > 0, (best + gain) // 2, 0)


def _shares(inner: list[bytes]) -> np.ndarray:
    """How often each of 256 classes of words occurs in the words of each row."""
    low = [np.frombuffer(x, np.uint8)[::2] for x in inner]
    row = np.repeat(np.arange(len(low)), [len(x) for x in low])
    return np.bincount(row * 256 + np.concatenate(low), minlength=256 * len(low)).reshape(-1, 256).astype(np.uint8)


def _pairs_that_meet(dealt: DataFrame, c: Chaining) -> DataFrame:
    """Ties of those that can have a passage, among the rows of one ``key`` in a group ``(grp)``: those with ``asks`` to smaller documents.

    A passage needs ``min_words`` words around the two seeds, of which ``min_identity``
    can be equal: outside the seeds those on the way along, between them at most the
    words that both have.  Where these are the same words (``alike``) the passage is
    known, and the longest one is enough.
    """
    names = [*_TIE.names[3:], "alike"]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        col = {x: table.column(x).combine_chunks().to_numpy(zero_copy_only=False) for x in ("key", "doc", "asks", "i", "j")}
        inner, around = (table.column(x).to_pylist() for x in ("inner", "around"))
        order = np.lexsort((col["doc"], col["asks"], col["key"]))
        seed, doc, asks, i, j = (x[order] for x in col.values())
        inner, n = [inner[x] for x in order.tolist()], c.min_words
        around = np.frombuffer(b"".join(around), np.uint16).reshape(len(order), -1)[order]
        first, out, of = run_starts(seed), [], {}
        kind, span = np.array([of.setdefault(x, len(of)) for x in inner], np.int64), j - i + c.k
        for a, b in zip(first.tolist(), np.r_[first[1:], len(order)].tolist()):
            middle, shares = a + int(np.searchsorted(asks[a:b], True)), None
            for x, below in zip(range(middle, b), (a + np.searchsorted(doc[a:middle], doc[middle:b])).tolist()):
                if below == a:
                    continue
                same = (around[a:below] == around[x]) & (around[x] > 0)
                (back, eq), (ahead, eq_) = _reach(same[:, :n], c.drop), _reach(same[:, n:], c.drop)
                alike, whole = kind[a:below] == kind[x], back + ahead + span[x]
                right = alike & (whole >= n) & (eq + eq_ + span[x] >= c.min_identity * whole)
                at, one = ([a + np.flatnonzero(right)[whole[right].argmax()]], 1) if right.any() else ([], 0)
                can = np.flatnonzero(~alike & (whole >= n))
                if len(can):
                    shares = _shares(inner[a:b]) if shares is None else shares
                    both = np.minimum(shares[can], shares[x - a]).sum(1, dtype=np.int64) + (eq + eq_)[can]
                    most = np.maximum(span[a + can], span[x]) + (back + ahead)[can]
                    at = np.r_[np.array(at, np.int64), a + can[both >= c.min_identity * most]]
                if len(at):
                    at, times = np.array(at, np.int64), np.ones(len(at), np.int64)
                    out.append((doc[x] * times, doc[at], i[x] * times, i[at], (j[x] - i[x]) * times, j[at] - i[at],
                                np.arange(len(at)) < one))
        cols = [np.concatenate(v) for v in zip(*out)] if out else [np.empty(0, np.int64)] * 7
        kinds = [np.int64] * 2 + [np.int32] * 4 + [bool]
        return pa.table([pa.array(v.astype(t)) for v, t in zip(cols, kinds)], names)

    return dealt.groupBy("grp").applyInArrow(run, "doc long, src long, pos int, spos int, len int, slen int, alike boolean")


def _chains_of_all(texts: DataFrame, ties: DataFrame, found: DataFrame, c: Chaining, buckets: int) -> DataFrame:
    """Chains at the open places with the smaller documents that share two seeds there.

    Seeds with the same words between them are a chain of their own, one for some
    places that follow each other in both texts.
    """
    left = stage(_open_places(ties, found, c), "open-places")
    held = ties.select("h", "doc", "pos").unionByName(ties.select("h", F.col("src").alias("doc"), F.col("spos").alias("pos")))
    held = held.join(left.select("h").distinct(), "h", "left_semi").withColumn("open", F.lit(False))
    places = held.unionByName(left).groupBy("doc").agg(
        F.collect_set(F.struct("pos", "h", "open")).alias("places"))
    pairs = stage(_seed_pairs(places, c), "seed-pairs")
    met = pairs.groupBy("key").agg(
        F.min("doc").alias("low"), F.max(F.when(F.col("open"), F.col("doc"))).alias("high"), F.count(F.lit(1)).alias("m"))
    asks = pairs.join(met.where("high > low").select("key", "m"), "key").groupBy(F.col("doc").alias("who")).agg(
        F.collect_list(F.struct("key", "m", "open", "i", "j")).alias("asks"))
    asked = packed_texts(texts).join(asks, F.col("doc") == F.col("who")).select("doc", "z", "asks")
    around = stage(_contexts(asked, c), "contexts")
    blocks = F.ceil(F.col("m") / PAIR_BLOCK)
    dealt = around.withColumn("own", F.pmod(F.xxhash64("doc", "i"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    group = lambda a, b: F.when(F.col("m") > PAIR_BLOCK, F.xxhash64("key", a, b)).otherwise(
        F.pmod("key", F.lit(buckets))).alias("grp")
    cols = ["key", "doc", "inner", "around", "i", "j"]
    index = dealt.where("first").select(group("own", "other"), *cols, F.lit(False).alias("asks"))
    asking = dealt.where("open").select(group("other", "own"), *cols, F.lit(True).alias("asks"))
    met = stage(_pairs_that_meet(index.unionByName(asking), c), "pairs-that-meet")
    near = F.floor(F.col("pos") / (c.min_words // 2 + 1))
    one = met.where("alike").groupBy("doc", "src", F.col("pos") - F.col("spos"), near).agg(
        F.min(F.struct("pos", "spos", "len", "slen")).alias("t"))
    ends = lambda a, b: F.array(f"t.{a}", (F.col(f"t.{a}") + F.col(f"t.{b}")).cast("int"))
    own = -1 - (F.col("t.pos").cast("bigint") * (4 * c.min_words) + F.col("t.len"))
    alike = one.select("doc", "src", own.alias("no"), ends("pos", "len").alias("pos"), ends("spos", "slen").alias("spos"))
    return _chain_pairs(met.where("not alike").drop("alike").distinct(), c, 0).unionByName(alike)


def _passages(texts: DataFrame, chains: DataFrame, c: Chaining) -> DataFrame:
    """The passages of ``shared_passages`` around chains ``(doc, src, no, pos, spos)``."""
    found = stage(chains, "chains")

    def ask(side: int, who: str, place: str) -> DataFrame:
        first, last = F.element_at(place, 1), F.element_at(place, -1)
        return found.select(F.col(who).alias("who"), F.struct(
            "doc", "src", "no", F.lit(side).alias("side"), (first - c.flank).alias("start"),
            (last + c.k + c.flank).alias("stop")).alias("ask"))

    asks = ask(0, "doc", "pos").unionByName(ask(1, "src", "spos"))
    asks = asks.groupBy("who").agg(F.collect_list("ask").alias("asks"))
    words = _cut_words(packed_texts(texts).join(asks, F.col("doc") == F.col("who")).select("z", "asks"))
    side = lambda i, v: F.max(F.when(F.col("side") == i, F.col(v)))
    both = words.groupBy("doc", "src", "no").agg(
        side(0, "base").alias("base"), side(0, "words").alias("words"), side(1, "base").alias("sbase"), side(1, "words").alias("swords"))
    ready = both.join(found, ["doc", "src", "no"]).select("doc", "src", "base", "words", "sbase", "swords", "pos", "spos")
    names = ["doc_id", "source_id", "start", "stop", "source_start", "source_stop", "n_words", "n_equal"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for doc, src, base, a, sbase, b, pos, spos in zip(*(batch.column(i).to_pylist() for i in range(8))):
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                chain = [(p - base, s - sbase) for p, s in zip(pos, spos)]
                chain = [(p, s) for p, s in chain if p + c.k <= len(x) and s + c.k <= len(y)]
                if not chain:
                    continue
                p, q, s, t, equal = align(x, y, chain, c)
                if q - p >= c.min_words and equal >= c.min_identity * max(q - p, t - s):
                    out.add((doc, src, p + base, q + base, s + sbase, t + sbase, q - p, equal))
            cols = list(zip(*sorted(out))) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in cols], names)

    return ready.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def shared_passages(docs: DataFrame, c: Chaining = Chaining(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of a document that a smaller one has, too, exactly or nearly.

    ``(doc_id, source_id, start, stop, source_start, source_stop, n_words, n_equal)``:
    word places, behind the last word for ``stop``; at least ``min_words`` words, of
    which ``min_identity`` are equal in order (of the longer side).  Words are
    compared in lower case A-Z.  Holders of a run of up to eight seeds (about 45
    words) are each tied to an earlier holder of it, so that copies of a passage or
    of a whole text are a tree of rows, not all pairs; which earlier holder it is can
    depend on how rows fall into batches.  A place that this leaves without a
    passage is compared with all earlier documents that share a second seed within
    twice ``min_words`` of it, whatever their number: every seed of a passage of up
    to that length that a document shares with an earlier one is in a row, to one
    that has it.  (In words that repeat themselves within a seed, one place in
    ``min_words`` stands for the others.)  Longer ones are made of such, but for
    stretches in which they differ more than ``min_identity`` allows.  That step grows with the square of
    the documents that share two seeds (a line of several seeds, say) outside
    longer passages, in blocks of ``PAIR_BLOCK``.  A place can be covered by rows to
    more than one source; each place of a passage in the document counts, the source
    shows one of its places.  NULL, empty and short texts have no passages; rows
    without id are left out; rows with equal ids are not compared with each other;
    extra columns are ignored.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = texts.where("doc is not null")
    ties = stage(_meet(_find_seeds(texts, c, buckets)), "ties")
    others = ties.where("doc <> src")
    found = stage(_passages(texts, _chain_pairs(others, c, -(-c.min_words // 3)), c), "passages")
    return found.unionByName(_passages(texts, _chains_of_all(texts, ties, found, c, buckets), c)).distinct()
