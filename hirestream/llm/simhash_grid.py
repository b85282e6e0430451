"""SimHash near-duplicates: fingerprints embedded as segment bit counts, joined on a grid, verified exactly.

1. A fingerprint has one bit for each bit position that is set in over half of the
   hashes of a text's shingles.  Equal fingerprints are one node from here on.
2. Its 64 bits are cut into segments; the bit counts of the segments are a point
   with whole coordinates.  The Manhattan distance of two points is never above the
   Hamming distance of the fingerprints.  Two points at distance 2 or less are both
   within 1 of some grid point, so every fingerprint goes to the cell of its own
   point and to the cells one step away, and pairs that can link meet in a cell.
3. Fingerprints in a cell are compared bit by bit.  A cell of more than ``CROWDED``
   fingerprints (near copies by the thousand) is not compared pair by pair: its
   members go to finer cells, one bit a segment, where distance 2 or less and a
   common cell are the same thing, and a cell can't hold more than 65 fingerprints.
4. Links lead to connected components.  A cell returns links that connect what it
   connects, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import components, run_starts, spanning, stage

SEED = 42
SEGMENT = 4
CROWDED = 32
#: Fingerprints whose cells one task lists, on average.
DEALT = 20_000
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16
#: Masks of the bit count in fields of 2, 4 and 8 bits: (shift, mask of the fields).
STEPS = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F))


def fingerprint(words: list[bytes], k: int) -> int:
    """The fingerprint of the k-word shingles, repeats included; 0 without words."""
    if not words:
        return 0
    width = min(k, len(words))
    digest = xxhash.xxh64_intdigest
    if width == 1:
        shingles = words
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    h = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1).astype("<u8", copy=False)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash(text: Column, k: int = 3) -> Column:
    """The fingerprint of a text as a signed 64-bit number; words in lower case A-Z, NULL as an empty text."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_buffer().to_pybytes().lower().split(), k) if t.is_valid else 0 for t in texts],
                        pa.int64())

    return run(text)


def bit_counts(fp: Column, segment: int) -> Column:
    """The bit counts of the segments, each in the bits of its segment."""
    out = fp
    for shift, mask in STEPS:
        if 2 * shift > segment:
            break
        low, high = out.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(out, shift).bitwiseAND(F.lit(mask))
        # fields of two bits can reach the sign, where a sum would overflow
        out = low + high if shift > 1 else low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    return out


def grid_cells(fp: Column, segment: int) -> Column:
    """The cells of a fingerprint: its own point, and the points one step away in each direction.

    Every bit count lies in 0 to ``segment``; steps beyond lead to points that no
    fingerprint needs.  With one bit a segment these are all single bit changes.
    """
    if segment == 1:
        return F.array(fp, *(fp.bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)))
    own = bit_counts(fp, segment)
    cells = [own]
    for at in range(0, 64, segment):
        count = F.shiftrightunsigned(own, at).bitwiseAND(F.lit((1 << segment) - 1))
        # the bits in which the next and the last count differ from this one
        up, down = (F.shiftleft(count.bitwiseXOR(count + step), at) for step in (1, -1))
        cells += [F.when(count < segment, own.bitwiseXOR(up)), F.when(count > 0, own.bitwiseXOR(down))]
    return F.array_compact(F.array(*cells))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_in_cells(fps: DataFrame, distance: int, segment: int) -> DataFrame:
    """``(a, b, crowded)`` for distinct fingerprints ``fps (fp)``.

    Rows with ``crowded`` name a member ``a`` of a cell with more than ``CROWDED``;
    the others are links that connect the members of a cell as all its links would.
    """
    # a row becomes tens of rows here, so small tables are dealt out first
    parts = max(1, -(-fps.count() // DEALT))
    cells = fps.repartition(parts).select("fp", F.explode(grid_cells(F.col("fp"), segment)).alias("cell"))
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cell, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        crowd = None  # a crowded cell whose end has not come yet

        def result(a, b, crowded):
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), crowded))], ["a", "b", "crowded"])

        def settle(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole cells."""
            first = run_starts(cell)
            size = np.diff(np.r_[first, len(cell)])
            many = np.repeat(size > CROWDED, size)
            if many.any():
                yield result(fp[many], fp[many], True)
            few = np.repeat((size > 1) & (size <= CROWDED), size)
            cell, fp = cell[few], fp[few]
            pairs = []
            alive = np.arange(len(cell))
            for s in range(1, CROWDED):
                alive = alive[alive + s < len(cell)]
                alive = alive[cell[alive] == cell[alive + s]]
                if not len(alive):
                    break
                near = np.bitwise_count((fp[alive] ^ fp[alive + s]).view(np.uint64)) <= distance
                pairs.append(np.stack([alive[near], alive[near] + s], 1))
            if pairs:
                pairs = spanning(np.concatenate(pairs), len(cell))
                yield result(fp[pairs[:, 0]], fp[pairs[:, 1]], False)

        for batch in batches:
            fp, cell = (batch.column(i).to_numpy() for i in range(2))
            if crowd is not None:
                same = cell == crowd
                if same.any():
                    yield result(fp[same], fp[same], True)
                    fp, cell = fp[~same], cell[~same]
                if len(cell):
                    crowd = None
            cell, fp = np.r_[held_cell, cell], np.r_[held_fp, fp]
            if not len(cell):
                continue
            last = int(np.searchsorted(cell, cell[-1]))
            yield from settle(cell[:last], fp[:last])
            held_cell, held_fp = cell[last:], fp[last:]
            if len(held_cell) > CROWDED:
                yield result(held_fp, held_fp, True)
                crowd = int(held_cell[0])
                held_cell, held_fp = held_cell[:0], held_fp[:0]
        yield from settle(held_cell, held_fp)

    return dealt.mapInArrow(run, "a long, b long, crowded boolean")


def links_by_bits(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fps (fp)`` with at most two differing bits.

    Two of them have a common cell of single bit changes exactly then; a cell has
    at most 65 members, and ties them to its smallest one.
    """
    cells = fps.select("fp", F.explode(grid_cells(F.col("fp"), 1)).alias("cell"))
    met = cells.groupBy("cell").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return met.select("a", F.explode("members").alias("b")).where("a <> b").distinct()


def simhash_classes(docs: DataFrame, k: int = 3, distance: int = 2, segment: int = SEGMENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: its fingerprint, and the smallest id that links reach.

    ``distance`` is the largest number of differing bits of a link, 0 to 2;
    ``segment`` is the number of bits of a segment: 2, 4 or 8.

    NULL, empty and blank texts have the fingerprint 0 and link like any other.
    Texts of any length are read whole.  Rows that share an id are one node with
    the links of each; rows without id get a fingerprint, link nothing and have no
    component.  Repeated rows come back as often as they occur.  An empty table
    gives an empty table; other columns are ignored.
    """
    if not 0 <= distance <= 2 or segment not in (2, 4, 8):
        raise ValueError("distance is 0 to 2, segment 2, 4 or 8")
    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), simhash(F.col(f"`{text_col}`"), k).alias("fp"))
    marks = stage(named, "fingerprints")
    with_id = marks.where("doc_id is not null")
    nodes = stage(with_id.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    links = nodes.limit(0).select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    if distance:
        found = stage(links_in_cells(nodes.select("fp"), distance, segment), "links")
        near = found.where("not crowded").select("a", "b").distinct()
        crowded = found.where("crowded").select(F.col("a").alias("fp")).distinct()
        if distance == 2:
            near = near.unionByName(links_by_bits(crowded))
        else:
            near = near.unionByName(_one_bit(crowded))
        a = nodes.withColumnsRenamed({"fp": "a", "rep": "x"})
        b = nodes.withColumnsRenamed({"fp": "b", "rep": "y"})
        links = near.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    # rows that share an id tie their fingerprints
    several = with_id.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id")
    again = with_id.join(several, "doc_id").join(nodes, "fp").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    joined = components(links.unionByName(again))
    found = nodes.join(joined, nodes["rep"] == joined["node"], "left").select(
        F.col("fp"), F.coalesce("component", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return marks.join(found, "fp", "left").select("doc_id", "fp", component)


def _one_bit(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between fingerprints of which one is a single bit change of the other."""
    changed = fps.select(F.col("fp").alias("a"), F.explode(grid_cells(F.col("fp"), 1)).alias("b")).where("a < b")
    return changed.join(fps.withColumnRenamed("fp", "b"), "b", "left_semi").select("a", "b")
