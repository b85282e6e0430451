"""Periodic runs, prefix tries and SimHash classes against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hirestream.llm import prefix_trie as trie_module
from hirestream.llm import simhash_grid
from hirestream.llm.common import spanning
from hirestream.llm.periodic_runs import Extension, SuffixTree, find_runs, maximal_runs, periodic_runs, stretches
from hirestream.llm.prefix_trie import DoubleArray, ordered_digest, prefix_trie, turn_sequences
from hirestream.llm.queries import QUERIES, with_borrowed_heads
from hirestream.llm.simhash_grid import bit_counts, fingerprint, grid_cells, links_by_bits, simhash_classes
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def odd_sequence(rng: random.Random) -> list[int]:
    n, kinds = rng.randint(0, 60), rng.choice([1, 2, 3, 6])
    x = [rng.randrange(1, kinds + 1) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 5:
            a, p = rng.randrange(n), rng.randint(1, 6)
            for i in range(a + p, min(n, a + p * rng.randint(2, 7))):
                x[i] = x[i - p]
    return x


def test_suffix_tree_and_extensions():
    rng = random.Random(3)
    for _ in range(300):
        x = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        n, tree = len(x), SuffixTree(x)
        suffixes, shared = tree.tour()
        ahead = Extension(suffixes, shared)
        assert suffixes.tolist() == sorted(range(n + 1), key=lambda i: x[i:])
        assert tree.tour(backwards=True)[0].tolist() == sorted(range(n + 1), key=lambda i: [-c for c in x[i:]])
        i, j = (np.array(v) for v in zip(*[(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]))
        want = [next((k for k in range(n) if x[a + k : a + k + 1] != x[b + k : b + k + 1] or max(a, b) + k >= n), n)
                for a, b in zip(i.tolist(), j.tolist())]
        assert ahead(i, j).tolist() == want


def test_runs_equal_all_periods_compared():
    rng = random.Random(1)
    for _ in range(1500):
        x = odd_sequence(rng)
        for least, exponent in ((6, 4), (1, 2), (5, 3)):
            want = plain.runs(x, least, exponent)
            assert [tuple(r) for r in find_runs(np.array(x, np.int64), least, exponent).tolist()] == want
            if x:
                assert sorted(map(tuple, maximal_runs(x, least, exponent).tolist())) == sorted(want)
            pieces = stretches(np.array(x, np.int64), least, exponent)
            assert all(any(a <= s and s + n <= b for a, b in pieces) for s, n, _ in want)


def test_periodic_runs_of_odd_rows(spark):
    rows = [(1, "a b a b a b a b", 0), (1, "a b a b a b a b", 0), (2, None, 1), (3, "", 2), (4, " \n\t", 3), (None, "x " * 9, 4),
            (5, "one", 5), (6, "A a A a a a a a a", 6), (7, "w" * 50_000, 7), (8, "l m n o p " * 3_000 + "q", 8), (9, "é é é é é é\x1cé", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int").withColumns({"runs": F.lit("x"), "repeats": F.lit(1)})
    got = periodic_runs(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "a.b", "runs", "repeats"}
    for r in got:
        words = plain.words(r.text)
        want = plain.runs(words, 6, 4)
        assert [tuple(x) for x in r.repeats.runs] == want and r.repeats.n_words == len(words)
        assert r.repeats.collapsed.encode() == plain.collapse(words, want) and r.runs == "x"
    empty = periodic_runs(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "a.b", "runs", "repeats"]
    with pytest.raises(ValueError):
        periodic_runs(docs, min_exponent=1)


def test_op11_against_plain_words(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc, text in docs:
        w = plain.words(text)
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain.runs(w, 6, 4)
        r = got[doc]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain.collapse(w, runs)).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_double_array_holds_its_sequences_only():
    rng = random.Random(4)
    for kinds in (1, 3, 40, 500):
        rows = sorted({tuple(rng.randrange(kinds) for _ in range(rng.randint(0, 6))) for _ in range(300)})
        trie = DoubleArray([list(r) for r in rows], kinds)
        prefixes = {r[:d] for r in rows for d in range(len(r) + 1)}
        assert len(trie.states) == len(prefixes) == len(set(trie.states))
        at = {p: [0, *trie.follow(list(p))] for p in prefixes}
        assert all(len(s) == len(p) + 1 for p, s in at.items()) and len({s[-1] for s in at.values()}) == len(prefixes)
        for p in prefixes:
            for t in range(kinds):
                assert len([*trie.follow([*p, t])]) == len(p) + ((*p, t) in prefixes)


def nodes_of(rows) -> dict:
    """Plain trie: path -> the columns of the query, for (conv_id, [(role, text)])."""
    out = {}
    for c, turns in rows:
        for d in range(len(turns) + 1):
            out.setdefault(tuple(turns[:d]), []).append((c, len(turns)))
    kids = {p: [q for q in out if len(q) == len(p) + 1 and q[: len(p)] == p] for p in out}
    below = {p: [q for q in out if q[: len(p)] == p] for p in out}
    own = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in out.items()}
    return {
        (min(c for c, _ in m), len(p)): (
            min(c for c, _ in out[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in below[p]),
            sum(own[q] for q in below[p]),
            hashlib.sha256(",".join(map(str, sorted(c for c, n in m if n == len(p)))).encode()).hexdigest())
        for p, m in out.items()}


def trie_rows(trie) -> dict:
    ends = ordered_digest(trie.ends, "node", "conv_id", "e")
    got = trie.nodes.join(ends, "node", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.e or empty) for r in got}


def plain_sequences(rows) -> list:
    held: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()
    return [(c, [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1], digest(*x[2:])))]) for c, v in held.items()]


@pytest.mark.parametrize("shard_turns", [200_000, 40])
def test_trie_equals_plain_nodes(spark, shard_turns, monkeypatch):
    monkeypatch.setattr(trie_module, "PIECE", 5)
    rng = random.Random(8)
    rows = [(None, 1, "user", "lost"), (900, None, None, None), (900, 1, "é", "ünï"), (900, 1, "é", "ünï"), (901, 5, "user", ""),
            (902, 1, "a", "bc"), (903, 1, "ab", "c"), (904, None, "", "")]
    for c in range(150):
        length = rng.choice([1, 2, 3, 8, 30])
        rows += [(c, t, "user" if t % 2 else "bot", str(rng.randrange(2)) * 5 if t else "hello there") for t in range(length)]
    rows += [(c, t, "user", "same") for c in range(500, 560) for t in range(4)]  # a group of equal conversations
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("node", F.lit(1))
    trie = prefix_trie(turn_sequences(table), shard_turns)
    want = nodes_of(plain_sequences(rows))
    got = trie_rows(trie)
    assert got == want and trie.nodes.count() == len(want)


def test_trie_of_no_and_of_turnless_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(turn_sequences(none)).nodes.count() == 0
    assert prefix_trie(turn_sequences(spark.createDataFrame([(None, 1, "a", "b")], none.schema))).nodes.count() == 0
    short = spark.createDataFrame([(7, 0, "a", "b"), (8, 0, "a", "c"), (100, 0, "x", "y"), (101, 0, "x", "y")], none.schema)
    got = trie_rows(prefix_trie(with_borrowed_heads(turn_sequences(short))))
    rows = {7: [("a", "b")], 8: [("a", "c")], 100: [("x", "y")], 101: [("x", "y")]}
    want = []
    for c, own in rows.items():
        h = zlib.crc32(str(c).encode()) % 6
        want.append((c, rows.get(c - c % 100, [])[:h] + own[h:]))
    assert got == nodes_of(want)


def near_texts(rng: random.Random) -> list:
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(400)]
    rows = []
    for i in range(150):  # near copies, many of them two bits or less apart
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i + 50, " ".join(t)))
    rows += [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 40])))) for i in range(40)]
    return rows


@pytest.mark.parametrize("segment, crowded, distance", [(4, 32, 2), (2, 3, 2), (8, 4, 1)])
def test_simhash_classes_equal_all_pairs(spark, segment, crowded, distance, monkeypatch):
    rows = near_texts(random.Random(6)) + [(300, None), (301, ""), (302, " \n"), (303, "One two"), (304, "one TWO"), (305, "İ é"),
                                           (306, "a b c " * 5_000), (None, "one two"), (60, "again under one id"), (304, "one two")]
    monkeypatch.setattr(simhash_grid, "CROWDED", crowded)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int").repartition(4)
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash_classes(docs, distance=distance, segment=segment).collect()),
                 key=repr)
    marks = [(d, plain.simhash(t)) for d, t in rows]
    up: dict = {}
    nodes = sorted({(d, f) for d, f in marks if d is not None})
    up = {x: x for x in nodes}
    for i, x in enumerate(nodes):
        for y in nodes[:i]:
            if x[0] == y[0] or (x[1] ^ y[1]).bit_count() <= distance:
                a, b = plain.find(up, x), plain.find(up, y)
                up[max(a, b)] = min(a, b)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    want = sorted(((d, signed(f), plain.find(up, (d, f))[0] if d is not None else None) for d, f in marks), key=repr)
    assert got == want
    assert simhash_classes(docs.limit(0)).count() == 0


def test_fingerprint_is_the_hash_of_spark(spark):
    rng = random.Random(2)
    words = [bytes(rng.choice(b"abcxyz") for _ in range(rng.randint(1, 9))) for _ in range(70)]
    assert fingerprint(words, 3) % (1 << 64) == plain.simhash(b" ".join(words).decode())
    one = spark.createDataFrame([("a bc def",)], "s string").select(F.xxhash64("s")).first()[0]
    assert one % (1 << 64) == xxhash.xxh64_intdigest(b"a bc def", 42) == fingerprint([b"a", b"bc", b"def"], 3) % (1 << 64)


def test_points_of_the_grid(spark):
    rng = random.Random(9)
    values = [0, -1, 1, -(1 << 63), (1 << 63) - 1, *(rng.getrandbits(64) - (1 << 63) for _ in range(200))]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for segment in (2, 4, 8):
        got = df.select("fp", bit_counts(F.col("fp"), segment).alias("p"), grid_cells(F.col("fp"), segment).alias("c")).collect()
        split = lambda x: [(x % (1 << 64)) >> at & ((1 << segment) - 1) for at in range(0, 64, segment)]
        for r in got:
            point = [v.bit_count() for v in split(r.fp)]
            assert split(r.p) == point
            around = {tuple(point)} | {tuple(v + s * (i == j) for j, v in enumerate(point)) for i in range(len(point)) for s in (1, -1)}
            assert sorted(map(tuple, map(split, r.c))) == sorted(v for v in around if 0 <= min(v) and max(v) <= segment)


def test_links_of_crowds_are_linear(spark):
    rng = random.Random(5)
    fps = {sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(600)}
    links = links_by_bits(spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")).collect()
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in links) and len(links) <= 65 * len(fps)
    pairs = np.array([(i, j) for i in range(9) for j in range(i)], np.int64)
    assert len(spanning(pairs, 9)) == 8
