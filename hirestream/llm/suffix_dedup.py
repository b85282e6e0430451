"""Suffix-array dedup of byte passages: every 50-byte string that an earlier document has as well goes.

1. In each 50-byte window the smallest hash of 16 bytes is the anchor; windows
   next to each other mostly share it and form a run.  Equal windows have equal
   anchors, so runs meet by anchor.  Runs travel as packed arrays per anchor
   bucket; equal runs (same anchor, same bytes) of a batch are merged before.
2. Per bucket, a run that an earlier document has in full is removed as it is.
   Only runs whose anchor also stands in other bytes ask for their text.
3. The windows of those runs are suffixes of their texts.  They are ordered by
   deep-shallow sorting: a multikey sort, eight bytes at a time, to a shallow
   depth, then blind tries for the groups that are still equal.  Equal windows
   end up in one leaf, and all but those of its smallest document are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import (
    by_bucket, first_minimum, mix64, packed, packed_texts, run_starts, stage, unpacked,
)

ANCHOR = 16
SHALLOW = 32
#: Runs that a task merges at a time, and windows that it sorts at a time.
PART_RUNS = 250_000
PART_WINDOWS = 200_000
#: Bytes of text for each bucket of runs, one group of a task.
BUCKET_BYTES = 8 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_PAIRS = {1 << i: mix64(np.array([i + 257], np.uint64))[0] | np.uint64(1) for i in range(5)}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Anchors and runs of a text's windows."""

    def __init__(self, length: int):
        self.length, self.width = length, length - ANCHOR + 1
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = _powers(int(_BASE), n)
            self.down = _powers(pow(int(_BASE), -1, 1 << 64), n)

    def anchor_hashes(self, x: np.ndarray) -> np.ndarray:
        # a polynomial of random values of the bytes, a factor of its own at each doubling; mixed once at the end
        h, width = _BYTE[x], 1
        while width < ANCHOR:
            longer = h[:-width] * _PAIRS[width]
            longer += h[width:]
            h, width = longer, 2 * width
        return mix64(h)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(hash, content, start, n, off)`` of each run: anchor hash, hash of its bytes, first window, windows, anchor place."""
        h = self.anchor_hashes(x)
        at = first_minimum(h, self.width)
        first = run_starts(at)
        n = np.diff(np.r_[first, len(at)])
        self._grow(len(x) + 1)
        sums = np.r_[np.uint64(0), np.cumsum(_BYTE[x] * self.up[: len(x)], dtype=np.uint64)]
        content = mix64((sums[first + n + self.length - 1] - sums[first]) * self.down[first])
        return h[at[first]], content, first.astype(np.uint32), n.astype(np.uint8), (
            at[first] - first).astype(np.uint8)


_RUN = np.dtype([("h", "<u8"), ("doc", "<i8"), ("content", "<u8"), ("start", "<u4"), ("n", "u1"), ("off", "u1")])


def _sorted_runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in the order of anchor, bytes, document; where each class of equal runs begins; each run's smallest document."""
    order = np.argsort(np.ascontiguousarray(rows["h"]))
    h = rows["h"][order]
    same = h[1:] == h[:-1]
    del h
    # most anchors stand once; only the others need more than one key
    some = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    keys = "start", "doc", "content", "n", "h"
    if 2 * len(some) > len(rows):
        del order, same, some
        order = np.lexsort(tuple(rows[k] for k in keys))
    else:
        at = order[some]
        order[some] = at[np.lexsort(tuple(rows[k][at] for k in keys))]
    rows = rows[order]
    first = run_starts(rows["h"], rows["n"], rows["content"])
    return rows, first, np.repeat(rows["doc"][first], np.diff(np.r_[first, len(rows)]))


def _spans(doc: np.ndarray, start: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    k = len(doc)
    spread = (mix64(doc.astype(np.uint64) ^ start.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(spread), pa.nulls(k, pa.binary()), pa.array(doc), pa.array(start.astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.nulls(k, pa.int32())], ["bucket", "blob", "doc", "start", "n", "off"])


_ROWS = "bucket int, blob binary, doc long, start int, n int, off int"


def _blobs(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    k = len(parts)
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary()), pa.nulls(k, pa.int64()),
         *[pa.nulls(k, pa.int32())] * 3], ["bucket", "blob", "doc", "start", "n", "off"])


def _find_runs(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Blobs of runs per bucket, and the runs (as spans) that an earlier document of the same batch has in full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for batch in batches:
            parts, held = [], 0
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                x = np.frombuffer(text.encode("utf-8"), np.uint8)
                if len(x) >= length:
                    h, content, start, n, off = runs.of(x)
                    r = np.empty(len(h), _RUN)
                    r["h"], r["content"], r["start"], r["n"], r["off"], r["doc"] = h, content, start, n, off, doc
                    parts.append(r)
                    held += len(r)
                if held > PART_RUNS or held and i == batch.num_rows - 1:
                    rows, _, smallest = _sorted_runs(np.concatenate(parts))
                    parts, held = [], 0
                    later = rows["doc"] > smallest
                    gone = rows[later]
                    if len(gone):
                        yield _spans(gone["doc"], gone["start"], gone["n"], buckets)
                    yield _blobs([(b, packed(x)) for b, x in by_bucket(rows[~later], buckets)])

    return docs.mapInArrow(run, _ROWS)


def _settle_runs(blobs: DataFrame) -> DataFrame:
    """Per bucket: spans of runs that an earlier document has in full (off -1), and runs that must show their text.

    Spans that the first pass has settled pass through.
    """
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        settled = table.filter(table.column("blob").is_null()).select(["doc", "start", "n"])
        settled = settled.append_column("off", pa.array(np.full(len(settled), -1, np.int32)))
        blobs = [unpacked(b, _RUN) for b in table.column("blob").drop_null().to_pylist()]
        if not blobs:
            return settled
        joined = np.concatenate(blobs)
        blobs.clear()
        rows, first, smallest = _sorted_runs(joined)
        del joined
        later = rows["doc"] > smallest
        by_anchor = run_starts(rows["h"])
        kinds = np.diff(np.searchsorted(first, np.r_[by_anchor, len(rows)]))
        asked = np.repeat(kinds > 1, np.diff(np.r_[by_anchor, len(rows)])) & ~later
        keep = later | asked
        r = rows[keep]
        found = pa.table({"doc": r["doc"], "start": r["start"].astype(np.int32), "n": r["n"].astype(np.int32),
                          "off": np.where(later[keep], -1, r["off"].astype(np.int32)).astype(np.int32)})
        return pa.concat_tables([settled.cast(found.schema), found])

    return blobs.groupBy("bucket").applyInArrow(run, "doc long, start int, n int, off int")


def _fields(lists: pa.ListArray) -> Iterator[list[np.ndarray]]:
    """The fields of each row's list of structs, one array a field; a NULL list is empty."""
    held = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in lists.flatten().flatten()]
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
    for a, b in zip([0, *ends], ends):
        yield [c[a:b] for c in held]


def _show_contexts(asking: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(bucket, blob, bytes)``: runs with the bytes of their windows, for rows ``(doc, z, runs)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unzip, zip_ = Runs(length), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(1)
        for batch in batches:
            parts, texts = [], []
            for doc, z, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _fields(batch.column(2))):
                text = unzip.decompress(z)
                x = np.frombuffer(text, np.uint8)
                start, n, off = asked
                inside = start + n + length - 1 <= len(x)
                start, n, off = start[inside], n[inside], off[inside]
                if not len(start):
                    continue
                r = np.empty(len(start), _RUN)
                r["h"] = _hash_at(hashes, x, start + off)
                r["doc"], r["start"], r["n"], r["off"], r["content"] = doc, start, n, off, 0
                parts.append(r)
                texts.append(_gather(x, start, n + length - 1))
            if not parts:
                continue
            rows = np.concatenate(parts)
            sizes = rows["n"].astype(np.int64) + length - 1
            ends = np.cumsum(sizes)
            data, rows["content"] = np.concatenate(texts), np.arange(len(rows))
            blobs, shown, names = [], [], []
            for b, part in by_bucket(rows, buckets):
                i = part["content"]
                shown.append(zip_.compress(_gather(data, (ends - sizes)[i], sizes[i]).tobytes()))
                blobs.append(packed(part))
                names.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary()),
                                              pa.array(shown, pa.binary())], ["bucket", "blob", "bytes"])

    return asking.select("doc", "z", "runs").mapInArrow(run, "bucket int, blob binary, bytes binary")


def _hash_at(runs: Runs, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Anchor hashes at the given places only."""
    h = _BYTE[x[at[:, None] + np.arange(ANCHOR)]]
    width = 1
    while width < ANCHOR:
        h = h[:, :-width] * _PAIRS[width] + h[:, width:]
        width *= 2
    return mix64(h[:, 0])


def _gather(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``x[start : start + size]`` one after the other."""
    ends = np.cumsum(size)
    at = np.ones(int(ends[-1]), np.int64)
    at[0] = start[0]
    at[ends[:-1]] = start[1:] - (start[:-1] + size[:-1] - 1)
    return x[np.cumsum(at)]


class BlindTrie:
    """Orders strings of equal length: inner nodes hold only the place of the first difference.

    A string goes down by its bytes at those places to some leaf; the real common
    prefix with that leaf then tells where it belongs.  Equal strings share a leaf.
    """

    def __init__(self, first: bytes, item: int):
        self.root: list = [None, first, [item]]  # leaf: None, string, items; inner: place, children

    def add(self, s: bytes, item: int) -> None:
        node = self.root
        while node[0] is not None:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        if node[1] == s:
            node[2].append(item)
            return
        differ = int.from_bytes(node[1]) ^ int.from_bytes(s)
        place = len(s) - 1 - (differ.bit_length() - 1) // 8
        other, up, node = node[1][place], None, self.root
        while node[0] is not None and node[0] < place:
            up, node = node, node[1][s[node[0]]]
        leaf = [None, s, [item]]
        if node[0] == place:
            node[1][s[place]] = leaf
            return
        inner = [place, {other: node, s[place]: leaf}]
        if up is None:
            self.root = inner
        else:
            up[1][s[up[0]]] = inner

    def leaves(self) -> Iterator[list[int]]:
        """The items of each leaf, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def deep_shallow(strings: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix within groups, and the number of each row's class of equal rows.

    The multikey sort takes eight bytes as one key and goes on only with rows that
    are not alone so far; what is still equal at depth ``shallow`` goes to blind tries.
    """
    m, width = strings.shape
    order = np.argsort(group, kind="stable")
    rank = np.empty(m, np.int64)
    first = run_starts(group[order])
    rank[order] = np.repeat(first, np.diff(np.r_[first, m]))
    active = order  # in the order of rank, from here on
    for at in range(0, min(shallow, width), 8):
        active = _shared(active, rank)
        if not len(active):
            break
        key = np.zeros((len(active), 8), np.uint8)
        piece = strings[active, at : min(at + 8, width)]
        key[:, : piece.shape[1]] = piece
        word, r = key.view(">u8").ravel().astype(np.uint64), rank[active]
        first = run_starts(r)
        sizes = np.diff(np.r_[first, len(r)])
        # groups that are equal here stay as they are
        differ = np.flatnonzero(np.repeat(np.logical_or.reduceat(word != word[np.repeat(first, sizes)], first), sizes))
        if not len(differ):
            continue
        r, word = r[differ], word[differ]
        by = np.lexsort((word, r))
        active[differ] = active[differ][by]
        base = run_starts(r)
        new = run_starts(r, word[by])
        base_of = np.repeat(base, np.diff(np.r_[base, len(by)]))
        rank[active[differ]] = r + np.repeat(new, np.diff(np.r_[new, len(by)])) - base_of
    cls = rank.copy()
    if shallow < width:
        deep = _shared(active, rank)
        first = run_starts(rank[deep])
        rest = np.ascontiguousarray(strings[deep, shallow:])
        tail, step = rest.tobytes(), rest.shape[1]
        sizes = np.diff(np.r_[first, len(deep)])
        # groups whose rows are all equal are in order as they are
        mixed = np.logical_or.reduceat((rest != rest[np.repeat(first, sizes)]).any(1), first) if len(first) else first
        cls[deep] = rank[deep]
        for a, b in zip(first[mixed].tolist(), (first + sizes)[mixed].tolist()):
            trie = BlindTrie(tail[a * step : (a + 1) * step], a)
            for i in range(a + 1, b):
                trie.add(tail[i * step : (i + 1) * step], i)
            at = int(rank[deep[a]])
            for items in trie.leaves():
                cls[deep[items]] = at
                at += len(items)
    return np.argsort(cls, kind="stable"), cls


def _shared(rows: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Those of the rows, given in the order of their rank, that share it with another."""
    r = rank[rows]
    same = r[1:] == r[:-1]
    return rows[np.r_[False, same] | np.r_[same, False]] if len(rows) else rows


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the number of each key's entry, and the size of each entry."""
    order = np.argsort(keys, kind="stable")
    first = run_starts(keys[order])
    size = np.diff(np.r_[first, len(keys)])
    back = np.empty(len(keys), np.int64)
    back[order] = np.repeat(np.arange(len(first)), size)
    return keys[order][first], back, size


def _settle_windows(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of windows that a smaller document has as well."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        unzip = zstandard.ZstdDecompressor()
        rows = np.concatenate([unpacked(b, _RUN) for b in table.column("blob").to_pylist()])
        data = np.frombuffer(b"".join(unzip.decompress(b) for b in table.column("bytes").to_pylist()), np.uint8)
        n = rows["n"].astype(np.int64)
        ends = np.cumsum(n + length - 1)
        _, anchor, _ = _counts(rows["h"])
        order = np.argsort(anchor, kind="stable")
        out = [np.empty((3, 0), np.int64)]
        # whole anchors at a time
        done = np.cumsum(n[order]) // PART_WINDOWS
        ends_anchor = np.r_[run_starts(anchor[order])[1:], len(order)]
        last = np.flatnonzero(np.diff(np.r_[done[ends_anchor - 1], done[-1] + 1]))
        cuts = ends_anchor[last]
        for a, b in zip(np.r_[0, cuts[:-1]].tolist(), cuts.tolist()):
            part = order[a:b]
            run_of = np.repeat(part, n[part])
            window = np.arange(len(run_of)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            at = (ends - n - length + 1)[run_of] + window
            # equal windows have their anchor at the same place
            group = anchor[run_of] * 64 + rows["off"].astype(np.int64)[run_of] - window
            by, cls = deep_shallow(np.lib.stride_tricks.sliding_window_view(data, length)[at], group)
            doc = rows["doc"][run_of]
            first = run_starts(cls[by])
            least = np.empty(len(by), np.int64)
            least[by] = np.repeat(np.minimum.reduceat(doc[by], first), np.diff(np.r_[first, len(by)]))
            gone = np.flatnonzero(doc > least)
            if not len(gone):
                continue
            # neighbours of one run become one span
            new = np.r_[True, (np.diff(gone) != 1) | (np.diff(run_of[gone]) != 0)]
            begin = np.flatnonzero(new)
            out.append(np.stack([doc[gone[begin]], rows["start"].astype(np.int64)[run_of[gone[begin]]] + window[gone[begin]],
                                 np.diff(np.r_[begin, len(gone)])]))
        d, s, k = np.concatenate(out, 1)
        return pa.table({"doc": d, "start": s.astype(np.int32), "n": k.astype(np.int32)})

    return contexts.groupBy("bucket").applyInArrow(run, "doc long, start int, n int")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def repeated_spans(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, start, n)``: the ``length``-byte windows from ``start`` on, ``n`` of them, that a smaller document has too."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col).where("doc is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    settled = stage(_settle_runs(_find_runs(texts, length, buckets)), "settled")
    asked = settled.where("off >= 0").groupBy("doc").agg(F.collect_list(F.struct("start", "n", "off")).alias("runs"))
    shown = _show_contexts(packed_texts(texts).join(asked, "doc"), length, buckets)
    windows = _settle_windows(shown, length)
    return settled.where("off < 0").select("doc", "start", "n").unionByName(windows)


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, kept binary, n_bytes, spans array<struct<start, stop>>)`` for every row.

    Removed is each byte covered by a ``length``-byte string of UTF-8 that also
    starts in a document with a smaller id; matches never cross documents, and
    strings are judged on the input.  NULL and empty texts have no bytes.  Equal
    texts: all but that of the smallest id are removed if they have ``length``
    bytes.  Rows with equal ids are not earlier than each other; each is cut where
    any of them is.  Rows without id neither remove nor lose anything.  Extra
    columns are ignored.
    """
    spans = repeated_spans(docs, length, id_col, text_col)
    per = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, z, (start, n) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _fields(batch.column(2))):
                text = unzip.decompress(z)
                kept, merged, at = [], [], 0
                order = np.argsort(start)
                start = start[order]
                reach = np.maximum.accumulate(np.minimum(start + n[order] + length - 1, len(text)))
                start = start[start < len(text)]
                new = np.flatnonzero(np.r_[True, start[1:] > reach[: len(start)][:-1]][: len(start)])
                for a, b in zip(start[new].tolist(), reach[np.r_[new[1:], len(start)][: len(new)] - 1].tolist()):
                    merged.append({"start": a, "stop": b})
                for m in merged:
                    kept.append(text[at : m["start"]])
                    at = m["stop"]
                kept.append(text[at:])
                out.append((doc, b"".join(kept), len(text), merged))
            d, k, n, m = zip(*out) if out else ((), (), (), ())
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(k, pa.binary()), pa.array(n, pa.int64()), pa.array(m, span)],
                ["doc_id", "kept", "n_bytes", "spans"])

    rows = packed_texts(_texts(docs, id_col, text_col)).join(per, "doc", "left").select("doc", "z", "spans")
    return rows.mapInArrow(cut, "doc_id long, kept binary, n_bytes long, spans array<struct<start: long, stop: long>>")

