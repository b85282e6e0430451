"""Conversation prefix trie: double-array tries over shards of sorted turn sequences, merged where shards meet.

1. A turn is known by a digest of its role and text, a conversation by the digests
   of its turns in order; texts travel no further.  Equal conversations are one
   sequence with a count.
2. The sequences are range-partitioned in order, so a shard holds a stretch of the
   trie.  Only the paths of its first and its last sequence can go on in other
   shards; however many conversations share a prefix, it is spread over as many
   shards as they fill.
3. A shard numbers its turns densely and packs its trie into the arrays BASE and
   CHECK: the child of state s by turn c is the cell BASE[s] + c if CHECK there is
   s.  Every sequence is followed through the arrays, then counts, smallest members
   and sums go up along CHECK.
4. The nodes of the first and last paths are merged by their key over all shards;
   sums over their subtrees are taken by pointer doubling, in as many rounds as the
   depth has binary digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import stage
from hirestream.session import ensure_checkpoint_dir

DIGEST = 16
#: Turns of distinct sequences in a shard, on average.
SHARD_TURNS = 200_000
#: Cells that are tried for a node with several children before it goes to the end of the arrays.
TRIES = 256
#: Ids in a piece of an ordered list that is digested piece by piece.
PIECE = 4096

SEQUENCES = "conv_id long, turns array<struct<id: binary, chars: long>>"
NODES = ("shard long, node binary, parent binary, turn binary, depth long, conv_id long, n_convs long, chars long, "
         "n_children long, n_leaves long, saved long, parent_conv long, edge boolean")


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of ``(conv_id, turn, role, text)``: one row a conversation, its turns in order.

    A turn has an ``id``, the digest of its role and text, and the length of its
    text in code points.  NULL roles and texts count as empty.  Turns go by number,
    NULL first; equal numbers go by digest, and repeated rows are repeated turns.
    Rows without ``conv_id`` belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").cast("bigint").alias("turn"), digest.alias("id"),
                 F.length(text).cast("bigint").alias("chars")).alias("t"))
    held = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return held.select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def path_key(turns: Column) -> Column:
    """The key of the node at which a sequence ends: digests chained from the root, whose key is empty."""
    return F.aggregate(turns, F.lit(b""), lambda key, t: F.unhex(F.md5(F.concat(key, t["id"]))))


class DoubleArray:
    """A trie of sorted distinct sequences of numbers, packed into BASE and CHECK.

    States are cells; 0 is the root.  ``states`` lists them breadth first, and
    ``names`` maps a turn number to the dense code under which it is packed:
    codes count from 1 in order of use, so brothers lie close together.
    """

    def __init__(self, rows: list[list[int]], n_names: int):
        self.base, self.check = [0], [-2]
        self.names = [0] * n_names
        self.states, self.used = [0], 1
        self._free = 1
        ranges = [(0, len(rows))]
        depth = 0
        level = [0]
        while level:
            below, below_ranges = [], []
            for state, (a, b) in zip(level, ranges):
                # rows that end here come first; the others fall into stretches of one child each
                starts, turns, last = [], [], -1
                for r in range(a, b):
                    row = rows[r]
                    if len(row) > depth and row[depth] != last:
                        last = row[depth]
                        starts.append(r)
                        turns.append(last)
                if not starts:
                    continue
                cells = self._place(state, turns)
                starts.append(b)
                below += cells
                below_ranges += zip(starts, starts[1:])
            self.states += below
            level, ranges = below, below_ranges
            depth += 1

    def _place(self, state: int, turns: list[int]) -> list[int]:
        codes = []
        for t in turns:
            code = self.names[t]
            if not code:
                code = self.names[t] = self.used
                self.used += 1
            codes.append(code)
        check, low = self.check, min(codes)
        size = len(check)
        cell = self._free
        while cell < size and check[cell] != -1:
            cell += 1
        self._free = cell
        if len(codes) > 1:
            for _ in range(TRIES):
                base = cell - low
                if all(base + c >= size or check[base + c] == -1 for c in codes):
                    break
                cell += 1
                while cell < size and check[cell] != -1:
                    cell += 1
            else:
                cell = size
        base = cell - low
        top = base + max(codes)
        if top >= size:
            check += [-1] * (top + 1 - size)
            self.base += [0] * (top + 1 - size)
        self.base[state] = base
        cells = [base + c for c in codes]
        for c in cells:
            check[c] = state
        return cells

    def follow(self, row: list[int]) -> Iterator[int]:
        """The states of a sequence after the root; ends where the trie has no such child."""
        state = 0
        for t in row:
            cell = self.base[state] + self.names[t]
            if not self.names[t] or not 0 <= cell < len(self.check) or self.check[cell] != state:
                return
            state = cell
            yield state


def _shard_nodes(paths: list[bytes], counts: list[int], least: list[int], chars: list[np.ndarray]) -> dict[str, list]:
    """The nodes of a shard's sorted distinct sequences, with counts, sums and keys; see ``NODES``."""
    sizes = np.array([len(p) // DIGEST for p in paths], np.int64)
    words = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    flat, ends = number.tolist(), np.cumsum(sizes).tolist()
    rows = [flat[e - n : e] for e, n in zip(ends, sizes.tolist())]
    digests = [words[i].tobytes() for i in order[new]] if len(order) else []
    length = np.zeros(len(digests), np.int64)
    if len(flat):
        length[number] = np.concatenate(chars)
    length = length.tolist()

    trie = DoubleArray(rows, len(digests))
    base, check, states = trie.base, trie.check, trie.states
    turn_of = [0] * (trie.used + 1)
    for turn, code in enumerate(trie.names):
        turn_of[code] = turn
    members, smallest = dict.fromkeys(states, 0), {}
    edge = {0}
    for r, row in enumerate(rows):
        state = 0
        for state in trie.follow(row):
            if r in (0, len(rows) - 1):
                edge.add(state)
        members[state] += counts[r]
        smallest[state] = min(least[r], smallest.get(state, least[r]))
    children, leaves, saved = (dict.fromkeys(states, 0) for _ in range(3))
    depth, key, turn = {0: 0}, {0: b""}, {0: None}
    for s in states[1:]:
        up = check[s]
        t = turn_of[s - base[up]]
        depth[s], turn[s], key[s] = depth[up] + 1, t, hashlib.md5(key[up] + digests[t]).digest()
    for s in reversed(states):  # children before their parents
        if s not in edge:
            leaves[s] += not children[s]
            saved[s] += (members[s] - 1) * length[turn[s]]
        if not s:
            break
        up = check[s]
        members[up] += members[s]
        smallest[up] = min(smallest[s], smallest.get(up, smallest[s]))
        if s not in edge:
            children[up] += 1
            leaves[up] += leaves[s]
            saved[up] += saved[s]
    up_of = lambda s: check[s] if s else None
    inner = [up_of(s) is not None and up_of(s) not in edge for s in states]
    return {
        "node": [key[s] for s in states], "parent": [key[up_of(s)] if s else None for s in states],
        "turn": [digests[turn[s]] if s else None for s in states], "depth": [depth[s] for s in states],
        "conv_id": [smallest[s] for s in states], "n_convs": [members[s] for s in states],
        "chars": [length[turn[s]] if s else 0 for s in states], "n_children": [children[s] for s in states],
        "n_leaves": [leaves[s] for s in states], "saved": [saved[s] for s in states],
        "parent_conv": [smallest[check[s]] if i else None for s, i in zip(states, inner)], "edge": [s in edge for s in states],
    }


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths, counts, least, chars = [], [], [], []
    for batch in batches:
        paths += batch.column(0).to_pylist()
        counts += batch.column(1).to_pylist()
        least += batch.column(2).to_pylist()
        chars += [np.array(x, np.int64) for x in batch.column(3).to_pylist()]
    if not paths:
        return
    nodes = _shard_nodes(paths, counts, least, chars)
    kinds = {"node": pa.binary(), "parent": pa.binary(), "turn": pa.binary(), "edge": pa.bool_()}
    nodes = {"shard": [TaskContext.get().partitionId()] * len(nodes["node"]), **nodes}
    table = pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in nodes.items()})
    yield from table.to_batches(10_000)


def _merged(edges: DataFrame) -> DataFrame:
    """The nodes on edge paths over all shards, with the sums over their subtrees."""
    ensure_checkpoint_dir(edges.sparkSession)
    nodes = edges.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("turn").alias("turn"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("chars").alias("chars"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    nodes = nodes.checkpoint()
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("more")).select(
        F.col("parent").alias("up"), "more")
    nodes = nodes.join(kids, nodes["node"] == kids["up"], "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).withColumn(
        "n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")).drop("up", "more").checkpoint()
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    sums = nodes.select("node", F.col("parent").alias("over"), "n_leaves", "saved")
    for _ in range(int(deepest).bit_length()):
        # a sum reaches twice as far down as before, and its owner points twice as far up
        given = sums.where("over is not null").groupBy("over").agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        given = given.withColumnRenamed("over", "to")
        further = sums.select(F.col("node").alias("at"), F.col("over").alias("next"))
        sums = sums.join(given, sums["node"] == given["to"], "left").join(further, sums["over"] == further["at"], "left").select(
            "node", F.col("next").alias("over"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")).checkpoint()
    nodes = nodes.drop("n_leaves", "saved").join(sums.drop("over"), "node")
    ups = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv"))
    return nodes.join(ups, nodes["parent"] == ups["up"], "left").drop("up").checkpoint()


class Trie(NamedTuple):
    """``nodes``: ``node, parent, turn, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``; ``ends``: ``node, conv_id``."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> Trie:
    """The prefix trie of ``sequences (conv_id, turns)`` (see ``turn_sequences``).

    A node is a distinct sequence of first turns; its members are the sequences
    that start with it.  ``nodes`` has a key and the parent's key (NULL for the
    root, whose own key is empty), the digest of the last turn, the depth, the
    smallest member ``conv_id`` and that of the parent, the number of members
    ``n_convs``, of children and of childless nodes in the subtree (a childless
    node is its own), and ``saved_tokens``: over the subtree, members but one
    times code points of the last turn's text.  ``ends`` has the node at which each
    sequence ends.

    Equal sequences are members each; one without turns ends at the root.  A
    repeated ``conv_id`` counts as often as it occurs.  An empty table has no nodes.
    A conversation is one row of 24 bytes a turn, however long its texts are.
    """
    ends = stage(sequences.select(
        path_key(F.col("turns")).alias("node"), F.col("conv_id").cast("bigint").alias("conv_id"),
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("path"),
        F.col("turns.chars").alias("chars")), "sequences")
    distinct = stage(ends.groupBy("node").agg(
        F.first("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
        F.first("chars").alias("chars")), "distinct-sequences")
    total = distinct.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_turns))
    dealt = distinct.select("path", "n", "least", "chars").repartitionByRange(shards, "path").sortWithinPartitions("path")
    found = stage(dealt.mapInArrow(_shards, NODES), "trie-shards")

    merged = stage(_merged(found.where("edge").drop("edge", "shard", "parent_conv")), "trie-edges")
    # the parent of an inner node is in its shard; where it lies on an edge path its smallest member comes from the merge
    known = found.where("edge").select("shard", "node").join(merged.select("node", F.col("conv_id").alias("up_conv")), "node")
    known = known.select(F.col("shard").alias("up_shard"), F.col("node").alias("up"), "up_conv")
    inner = found.where("not edge")
    near = inner.where("parent_conv is null").join(
        known, (F.col("shard") == F.col("up_shard")) & (F.col("parent") == F.col("up"))).withColumn("parent_conv", F.col("up_conv"))
    cols = ["node", "parent", "turn", "depth", "conv_id", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", F.col("saved").alias("saved_tokens")]
    nodes = merged.select(*cols).unionByName(inner.where("parent_conv is not null").select(*cols)).unionByName(near.select(*cols))
    return Trie(nodes, ends.select("node", "conv_id"))


def ordered_digest(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``(key, out)``: SHA-256 in hex of a key's numbers in decimal, ascending, joined by commas.

    The rows are range-partitioned by key and number, so a key with very many
    numbers fills several tasks; each packs its share into pieces.  The pieces of a
    key are digested in order, one piece in memory at a time.
    """
    placed = rows.select(F.col(key).alias("k"), F.col(value).cast("bigint").alias("v"))
    ordered = placed.repartitionByRange("k", "v").sortWithinPartitions("k", "v")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(1)
        for batch in batches:
            keys, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out_rows, a = [], 0
            for b in range(1, len(keys) + 1):
                if b == len(keys) or keys[b] != keys[a] or b - a == PIECE:
                    text = ",".join(map(str, values[a:b])).encode()
                    out_rows.append((keys[a], values[a], c.compress(text) if b - a > 8 else text, b - a > 8))
                    a = b
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out_rows), (pa.binary(), pa.int64(), pa.binary(), pa.bool_()))]
                if out_rows else [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.binary(), pa.bool_())],
                ["k", "first", "piece", "packed"])

    pieces = ordered.mapInArrow(pack, "k binary, first long, piece binary, packed boolean")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, at, state = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            done = []
            for k, piece, packed in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                piece = d.decompress(piece) if packed else piece
                if k == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = k, hashlib.sha256()
                state.update(piece)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.string()))], ["k", "d"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["k", "d"])

    dealt = pieces.repartition("k").sortWithinPartitions("k", "first")
    return dealt.mapInArrow(digest, "k binary, d string").select(F.col("k").alias(key), F.col("d").alias(out))
