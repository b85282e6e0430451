"""Periodic run detection: the maximal repetitions of words in every text, by longest common extensions.

1. A run of period q repeats every word at a distance of at most q, so whole
   stretches of words whose last occurrence is that near hold all runs
   (``stretches``, lossless).  Most prose has none; only the stretches go on.
2. Ukkonen's suffix trees of the stretches of a document and of their reversal
   are built.  An Euler tour of the leaves keeps the depth of the lowest common
   ancestor between neighbours, and a table of range minima over it answers a
   longest common extension in constant time, in both directions.
3. Every run has a Lyndon root that is the longest Lyndon word at its place, in the
   order of the words or in the reversed one (the next smaller suffix ends it).  All
   of these candidates are extended both ways; those that repeat often enough are
   the runs.

Every document is worked on by itself, so nothing is shuffled; memory is linear
in the stretches of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirestream.llm.common import columns

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
RESULT_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(T.StructType(
        [T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))), T.StructField("collapsed", T.StringType())])


class Numbers(dict):
    """Words numbered from 1 in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def stretches(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Disjoint ranges that hold every run of ``min_length`` words and ``min_exponent`` periods whole.

    In a run of period q all words but the first q are at most q words behind
    their equals.  For q in (t / 2, t] such words form a range of a known least
    length; t goes up in powers of two.
    """
    n = len(ids)
    if n < min_length:
        return []
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    back = np.full(n, n, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    change = np.zeros(n + 1, np.int64)
    t, found = 1, False
    while True:
        least = (min_exponent - 1) * (t // 2 + 1)
        if least > n:
            break
        near = np.zeros(n + 2, np.int8)
        near[1:-1] = back <= t
        edges = np.flatnonzero(near[1:] != near[:-1])
        a, b = edges[::2], edges[1::2]
        enough = b - a >= max(least, min_length - t)
        if enough.any():
            np.add.at(change, np.maximum(a[enough] - t, 0), 1)
            np.add.at(change, b[enough], -1)
            found = True
        t *= 2
    if not found:
        return []
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = np.cumsum(change)[:n] > 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols`` (1 and up), to which the end 0 is added.

    Node 0 is the root; ``child`` maps ``node * width + first symbol`` to a node,
    whose edge is the text from ``first`` to ``last``.
    """

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        n = len(s)
        self.n, self.width = n, max(s) + 1
        first, last, link, up, leaf, child = [0], [0], [0], [0], [-1], {}
        width = self.width
        node = edge = length = left = 0
        for i, c in enumerate(s):
            left += 1
            waiting = 0  # an inner node without suffix link
            while left:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(first)
                    first.append(i), last.append(n), link.append(0), up.append(node), leaf.append(i - left + 1)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    begin = first[below]
                    size = last[below] - begin
                    if size > i + 1 - begin:
                        size = i + 1 - begin
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[begin + length] == c:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(first)
                    child[key] = split
                    first.append(begin), last.append(begin + length), link.append(0), up.append(node), leaf.append(-1)
                    first[below] = begin + length
                    up[below] = split
                    child[split * width + s[begin + length]] = below
                    child[split * width + c] = split + 1
                    first.append(i), last.append(n), link.append(0), up.append(split), leaf.append(i - left + 1)
                    if waiting:
                        link[waiting] = split
                    waiting = split
                left -= 1
                if not node and length:
                    length -= 1
                    edge = i - left + 1
                elif node:
                    node = link[node]
        self.first, self.last, self.up, self.leaf = first, last, up, leaf
        keys = np.fromiter(child, np.int64, len(child))
        self._kids = np.fromiter(child.values(), np.int64, len(child))
        self._parent, self._symbol = keys // width, keys % width

    def tour(self, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of a tour of the leaves, and the depth of the lowest common ancestor of neighbours.

        ``backwards`` reverses the order of the symbols; the end stays the smallest.
        """
        symbol = np.where(self._symbol > 0, self.width - self._symbol, 0) if backwards else self._symbol
        # the last child first: the stack turns the order round
        order = np.lexsort((-symbol, self._parent))
        kids, parent = self._kids[order], self._parent[order]
        begin = np.searchsorted(parent, np.arange(len(self.first) + 1)).tolist()
        kids = kids.tolist()
        first, last, up, leaf = self.first, self.last, self.up, self.leaf
        depth = [0] * len(first)
        stack, suffixes, shared, after = [0], [], [], False
        while stack:
            v = stack.pop()
            u = up[v]
            if after:
                shared.append(depth[u])
                after = False
            if leaf[v] >= 0:
                suffixes.append(leaf[v])
                after = True
            else:
                depth[v] = depth[u] + last[v] - first[v]
                stack += kids[begin[v] : begin[v + 1]]
        return np.array(suffixes, np.int64), np.array(shared, np.int64)


class Extension:
    """Longest common extension of two places in constant time: range minima over the tour of a tree."""

    def __init__(self, suffixes: np.ndarray, shared: np.ndarray):
        n = len(suffixes)
        self.rank = np.empty(n, np.int64)
        self.rank[suffixes] = np.arange(n)
        self.table = [shared.astype(np.int32)]
        width = 1
        while 2 * width <= len(shared):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2
        self.log = np.zeros(n + 1, np.int64)
        self.log[1:] = np.log2(np.arange(1, n + 1) + 0.25).astype(np.int64)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places ``i`` and ``j`` that differ."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = self.log[b - a]
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << k)])
        return out


def next_smaller(rank: list[int], n: int) -> list[int]:
    """For each place the next one of smaller rank, ``n`` if there is none."""
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def maximal_runs(symbols: list[int], min_length: int, min_exponent: int) -> np.ndarray:
    """``(start, length, period)`` of the runs of ``symbols`` (1 and up) with enough length and periods, by start and period."""
    n = len(symbols)
    tree = SuffixTree(symbols)
    suffixes, shared = tree.tour()
    ahead = Extension(suffixes, shared)
    other = np.empty(n + 1, np.int64)
    other[tree.tour(backwards=True)[0]] = np.arange(n + 1)
    del tree
    behind = Extension(*SuffixTree(symbols[::-1]).tour())
    i = np.tile(np.arange(n), 2)
    j = np.array(next_smaller(ahead.rank[:n].tolist(), n) + next_smaller(other[:n].tolist(), n), np.int64)
    # the place n is the end; the place -1 is the end of the reversal
    right, back = ahead(i, j), behind(n - i, n - j)
    period = j - i
    length = period + right + back
    some = (length >= min_length) & (length >= min_exponent * period)
    return np.unique(np.stack([(i - back)[some], length[some], period[some]], 1), axis=0)


def find_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """``(start, length, period)`` of the runs of a text's word numbers, by start and period."""
    pieces = stretches(ids, min_length, min_exponent)
    if not pieces:
        return np.empty((0, 3), np.int64)
    # the stretches in one sequence, with a symbol of its own behind each
    symbols, begin, place, at = [], [], [], 0
    names: dict[int, int] = {}
    for k, (a, b) in enumerate(pieces):
        symbols += [names.setdefault(x, len(names) + 1) for x in ids[a:b].tolist()]
        symbols.append(names.setdefault(-1 - k, len(names) + 1))
        begin.append(at)
        place.append(a)
        at += b - a + 1
    runs = maximal_runs(symbols, min_length, min_exponent)
    piece = np.searchsorted(np.array(begin), runs[:, 0], "right") - 1
    runs[:, 0] += (np.array(place, np.int64) - np.array(begin, np.int64))[piece]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, without those behind the first period of a run."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(change)[:-1] > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, text_col: str = "text",
                  out: str = "repeats") -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``out``: ``n_words``, ``runs`` and the ``collapsed`` text.

    Words are stretches without ASCII white space, numbered from 0.  A run is a
    stretch of consecutive words with smallest period q, of at least
    ``min_length`` words and ``min_exponent`` periods (2 or more), that can't be
    extended with that period.  ``runs`` has ``start``, ``length`` and ``period``
    by start and period.  ``collapsed`` has the words joined by one space, without
    those that any run holds after its first period.

    NULL, empty and blank texts have no words, no runs and an empty ``collapsed``.
    Texts of any length are read whole.  Repeated rows come back as often as they
    occur, each with the same result; ids play no part, so NULL and repeated ids
    don't matter.  An empty table gives an empty table.  A column named like
    ``out`` is replaced, any other column passes.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")

    def repeats(texts: pa.Array) -> pa.Array:
        n_words, sizes, flat, kept = [], [0], [], []
        for text in texts:
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            n_words.append(len(words))
            numbers = Numbers()
            runs = find_runs(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), min_length, min_exponent)
            flat.append(runs)
            sizes.append(sizes[-1] + len(runs))
            kept.append(collapsed(words, runs) if len(runs) else b" ".join(words))
        all_runs = np.concatenate(flat) if flat else np.empty((0, 3), np.int64)
        items = pa.StructArray.from_arrays([pa.array(all_runs[:, k]) for k in range(3)], fields=list(RUN))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items),
             pa.array(kept, pa.binary()).cast(pa.string())], fields=list(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), repeats(batch.column(1))], ["row", "found"])

    row = docs.select(F.struct(*columns(docs, out)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = row.mapInArrow(run, T.StructType([row.schema["row"], T.StructField("found", RESULT_TYPE)]))
    return found.select(*(F.col(f"row.`{c}`") for c in docs.columns if c != out), F.col("found").alias(out))
