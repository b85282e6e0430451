"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirestream.session import ensure_checkpoint_dir, stage

__all__ = ["GAP", "WORD", "WordIds", "by_bucket", "columns", "components", "documents", "first_minimum", "fold", "let",
           "mix64", "packed", "packed_texts", "run_starts", "spanning", "spare", "stage", "unpacked", "words_of"]

#: White space between words, and a word (fixed by the contracts of the queries).
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
GAP_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def columns(df: DataFrame, *drop: str) -> list[Column]:
    """All columns but the named ones, quoted."""
    return [F.col(f"`{c}`") for c in df.columns if c not in drop]


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores ahead as keep it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimiser inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for NULL and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)))


def fold(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts``; 0 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def run_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination begins in arrays that are sorted together."""
    n = len(sorted_keys[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def first_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (the first of equal ones) in each window of ``width`` values, up to 64.

    Minima ahead and behind in blocks as long as the window; the low six bits
    carry the place inside the block.
    """
    n = len(h) - width + 1
    blocks = -(-len(h) // width)
    keyed = np.full(blocks * width, ~np.uint64(0))
    keyed[: len(h)] = h
    keyed = (keyed.reshape(-1, width) & ~np.uint64(63)) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(keyed, 1).ravel()[width - 1 : width - 1 + n]
    behind = np.minimum.accumulate(keyed[:, ::-1], 1)[:, ::-1].ravel()[:n]
    begin = np.arange(n) // width * width
    low = np.uint64(63)
    return np.where((behind | low) <= (ahead | low), begin + (behind & low).astype(np.int64),
                    (np.arange(n) + width - 1) // width * width + (ahead & low).astype(np.int64))


def spanning(pairs: np.ndarray, n: int) -> np.ndarray:
    """Those of the pairs of numbers below ``n`` that join what is not joined before."""
    up = list(range(n))
    keep = []
    for k, (x, y) in enumerate(pairs.tolist()):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x != y:
            up[max(x, y)] = min(x, y)
            keep.append(k)
    return pairs[keep]


def packed(rows: np.ndarray) -> bytes:
    """A structured array, column after column, compressed."""
    return zstandard.ZstdCompressor(1).compress(b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names))


def unpacked(blob: bytes, dtype: np.dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    rows, at = np.empty(len(raw) // dtype.itemsize, dtype), 0
    for f in dtype.names:
        size = dtype[f].itemsize * len(rows)
        rows[f] = np.frombuffer(raw[at : at + size], dtype[f])
        at += size
    return rows


def by_bucket(rows: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shares of a structured array by the high bits of its hashes ``h``."""
    bucket = ((rows["h"] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    first = run_starts(bucket[order])
    for a, b in zip(first, np.r_[first[1:], len(order)]):
        yield int(bucket[order[a]]), rows[order[a:b]]


def packed_texts(docs: DataFrame) -> DataFrame:
    """``(doc, z)``: texts as compressed UTF-8, for the shuffles that need them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(3)
        for batch in batches:
            z = [c.compress(t.encode("utf-8")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.binary())], ["doc", "z"])

    return docs.mapInArrow(run, "doc long, z binary")


class WordIds(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __init__(self, bound: int = 300_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list as ``(node, component)``, the component being its smallest node.

    Every node takes the smallest label among itself and its neighbours, then the
    label of its label (pointer jumping), until nothing changes.  Both steps are
    joins and aggregates with map-side combine, so a node with very many
    neighbours is no task of its own; labels are checkpointed in each round.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # ties to several smaller nodes become ties among these, which many nodes have in common
    down = e.groupBy("b").agg(F.min("a").alias("a"))
    among = e.join(down.withColumnRenamed("a", "m"), "b").where("a <> m").select(F.col("a").alias("b"), F.col("m").alias("a"))
    e = down.unionByName(among).distinct().checkpoint()
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")).checkpoint()
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = step.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
        jumped = step.join(up, step["label"] == up["__n"], "left").select(
            "node", "old", F.least("label", "__l").alias("label")).checkpoint()
        changed = jumped.where("label <> old").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
