"""Packing, search and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hirestream.llm.packing import pack_documents, pack_pieces, sequences, sum_of_squares
from hirestream.llm.topk import top_k
from tests.llm import plain

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n ", "Plain words, and more.", "don't WON'T we've", "İΣ ς ½ ² a b\x1cc", "é é",
       "<|endoftext|> x<|startoftext|>y", "1234 #*$", "日本語 text", "a" * 9000, "word " * 9000]


def test_pieces_are_the_tokenizers(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(3, ODD[3]), (None, "no id")], "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = pack_documents(docs, TOKENIZER, 512).collect()
    t = Tokenizer.from_file(TOKENIZER)
    want = []
    for d, x in [*enumerate(ODD), (3, ODD[3]), (None, "no id")]:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 512)):
            part = ids[a : a + 512]
            want.append((d, p, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    _gapless(rows, 512)


def _gapless(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_sum_of_squares_takes_the_best_place():
    rng = np.random.default_rng(1)
    sizes, capacity = rng.integers(1, 21, 300), 20
    bins, offsets, gaps = sum_of_squares(sizes, capacity)
    open_: list[int] = []
    for s, b, o in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def squares(gs):
            counts = np.bincount([g for g in gs if 0 < g < capacity] or [0], minlength=capacity)
            return int((counts[1:] ** 2).sum())
        choices = [squares(open_[:i] + [g - s] + open_[i + 1 :]) for i, g in enumerate(open_) if g >= s] + [squares([*open_, capacity - s])]
        if b == len(open_):
            open_.append(capacity)
        assert o == capacity - open_[b]
        open_[b] -= s
        assert squares(open_) == min(choices)
    assert open_ == gaps.tolist()


def test_packing_in_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 900, 4000))]
    pieces = spark.createDataFrame(rows, "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long")
    got = pack_pieces(pieces, 4096, group_bins=64).collect()
    assert sorted(r.doc_id for r in got) == list(range(4000))
    n = _gapless(got, 4096)
    assert n <= -(-sum(r[4] for r in rows) // 4096) + 3
    assert pack_pieces(pieces.where("false")).count() == 0


def test_sequences(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i} " * (i + 1)) for i in range(30)], "doc_id long, text string")
    packed = pack_documents(docs, TOKENIZER, 64)
    whole = {r.sequence_id: r.ids for r in sequences(docs, packed, TOKENIZER, 64).collect()}
    for r in packed.collect():
        part = whole[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32


def _best(vectors, k):
    v = {i: [int(np.floor(1024 * float(x))) for x in xs] for i, xs in vectors
         if i is not None and xs is not None and all(x is not None and np.isfinite(x) for x in xs)}
    out = set()
    for q in (i for i in v if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q and len(x) == len(v[q]))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def test_top_k(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.normal(0, 1, 6).round(1).tolist()) for i in range(160)]
    vectors += [(200, vectors[20][1]), (201, vectors[20][1]), (202, None), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6),
                (205, [float("inf")] * 6), (210, [1.0, 2.0]), (220, []), (None, [1.0] * 6), (221, [3e4] * 6), (230, [-2e4] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4).withColumn("rank", F.lit(1))
    got = {tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, k=5, query_block=7).collect()}
    assert got == _best(vectors, 5)
    few = df.where("vec_id in (0, 1, 2)")
    assert {tuple(r) for r in top_k(few, F.col("vec_id") % 10 == 0).collect()} == _best(vectors[:3], 10)
    assert top_k(df.where("false"), F.lit(True)).count() == 0
    named = df.withColumnsRenamed({"vec_id": "id"})
    assert {tuple(r) for r in top_k(named, F.col("id") % 10 == 0, k=5, id_col="id").collect()} == got
    equal = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in top_k(equal, F.col("vec_id") == 0, k=3).collect()} == {(0, 1, 1, 2 << 20), (0, 2, 2, 2 << 20), (0, 3, 3, 2 << 20)}


def test_pipeline_against_plain_steps(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = dict(P.STAGES)
    kept = steps["quality rules"](spark, docs, sf).cache()
    assert kept.columns == docs.columns
    assert not any(plain.rule_counts(r.text)["base_failed"] for r in kept.collect())

    cut = steps["line dedup"](spark, kept, sf).cache()
    want = plain.dedup_lines([(r.doc_id, r.text) for r in kept.collect()], 3, 50)
    want = {d: text for (d, _), (n, gone, text) in want.items() if not n or len(gone) < n}
    assert {r.doc_id: r.text for r in cut.collect()} == want and cut.columns == docs.columns

    one = steps["near duplicates"](spark, cut, sf).cache()
    classes = plain.jaccard_classes(list(want.items()), 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, (_, c) in classes.items() if c == d)

    mixed = steps["mixing"](spark, one, sf).cache()
    sizes: dict = {}
    for r in one.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.words(r.text))
    targets = plain.water_targets(sizes, (3, 1, 2), 1.5, 2.0)
    taken: dict = {}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(plain.words(r.text))
    # whole documents only: a source misses its target by at most half of its largest text
    half = {s: max(len(plain.words(r.text)) for r in one.collect() if r.source == s) / 2 for s in targets}
    assert all(abs(taken.get(s, 0) - t) <= max(half[s], 0.02 * t + 30) for s, t in targets.items()) and mixed.columns == docs.columns

    packed = P.run(spark, sf).collect()
    t = Tokenizer.from_file(TOKENIZER)
    lengths = {}
    for r in mixed.collect():
        lengths.setdefault(r.doc_id, []).append(len(t.encode(r.text, add_special_tokens=False).ids) + 1)
    got: dict = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {d: sum(n) for d, n in lengths.items()}
    assert _gapless(packed, 4096) <= -(-sum(got.values()) // 4096) + 2


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
