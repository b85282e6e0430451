"""Operators on documents against plain versions, with odd rows among them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirestream.llm import passage_chains
from hirestream.llm.jaccard_join import drop_near_duplicates, jaccard_classes
from hirestream.llm.line_dedup import dedup_lines
from hirestream.llm.mixing import mix_sources, repeated
from hirestream.llm.passage_chains import Chaining, chains, chains_of_groups, shared_passages
from hirestream.llm.ppm import ORDER, gram_keys, score_texts
from hirestream.llm.quality_classifier import classify_quality
from hirestream.llm.quality_rules import quality_rules
from hirestream.llm.suffix_dedup import _RUN, BlindTrie, Runs, _sorted_runs, deep_shallow, remove_repeats
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, words string, __x int, row long, mix int"


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ti", "on", "er", "the", "and", "ly", "in", "of", "re", "sh", "ou", "é", "ün"]
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ".", ","]))
        if rng.random() < 0.1:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(w if rng.random() > share else "x" + w for w in text.split(" "))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage, line = prose(rng, 70), "All rights are kept by the ones who wrote this line of text."
    out = {}
    for i in range(1, 60):
        t = prose(rng, rng.choice([3, 25, 60, 200]))
        if i % 3 == 0:
            t += "\n" + passage
        if i % 2 == 0:
            t = line + "\n" + t
        out[i] = t
    base = prose(rng, 300)
    for i in range(60, 90):  # near copies, each in its own way
        out[i] = edited(rng, base, 0.02 if i % 5 else 0.08)
    out |= {90: out[5], 91: out[5], 92: base, 93: None, 94: "", 95: " \n\t ", 96: "Word", 97: "word", 98: "two words",
            99: "a b c d e f g h " * 30, 100: prose(rng, 20_000), 101: "x" * 300, 102: "of of of of of of of of of of of of " * 9,
            103: "İΣ <|endoftext|> don't 12 ½ a b\x1cc"}
    return list(out.items())


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, "en", ["b", "a", None, "Z"][d % 4] if d % 3 else "hot", len(t or ""), 1, "w", 2, 3, 4) for d, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(5, "doc_id").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("k,percent,block", [(3, 90, 64), (5, 80, 3)])
def test_jaccard(docs, rows, k, percent, block):
    got = {r[0]: (r[1], r[2]) for r in jaccard_classes(docs, k, percent, block=block).collect()}
    assert got == plain.jaccard_classes(rows, k, percent)


def test_windows_sort_only_what_differs(monkeypatch):
    """op9: rows of groups that are equal at a depth are not sorted there; lists of structs are read without a dict a row."""
    import pyarrow as pa

    from hirestream.llm import suffix_dedup

    sorts = []
    monkeypatch.setattr(suffix_dedup.np, "lexsort", lambda keys, real=np.lexsort: sorts.append(len(keys[0])) or real(keys))
    strings = np.frombuffer(b"a" * 40 * 6 + b"b" * 40 + b"c" * 40, np.uint8).reshape(8, 40)
    order, cls = deep_shallow(strings, np.array([0, 0, 1, 1, 2, 2, 3, 3]))
    assert cls.tolist() == [0, 0, 2, 2, 4, 4, 6, 7] and order.tolist() == list(range(8)) and sorts == [2]
    lists = pa.array([[{"start": 1, "n": 2}, {"start": 5, "n": 1}], None, [], [{"start": 9, "n": 3}]],
                     pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))
    assert [[f.tolist() for f in r] for r in suffix_dedup._fields(lists.slice(0, 4))] == [[[1, 5], [2, 1]], [[], []], [[], []], [[9], [3]]]
    assert [[f.tolist() for f in r] for r in suffix_dedup._fields(lists.slice(2, 2))] == [[[], []], [[9], [3]]]


def test_jaccard_signatures_go_in_parts(rows):
    """pipeline: a task holds and sends few signatures at a time, however many rows its batch has; the links stay."""
    import pyarrow as pa

    from hirestream.llm.jaccard_join import _tie_batches

    named = [(r[0], r[1] or "") for r in rows if r[0] is not None] if not isinstance(rows, dict) else [
        (i, t or "") for i, t in rows.items() if i is not None]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in named], pa.int64()), pa.array([t for _, t in named], pa.string())], ["doc", "text"])
    whole, parts = (list(_tie_batches(iter([batch]), 3, 90, part)) for part in (1 << 40, 500))
    seen = lambda found: {(k, a) for b in found for k, a in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if k == "d"}
    assert seen(whole) == seen(parts)
    of = lambda found: [b.num_rows for b in found if b.num_rows and b.column(0)[0].as_py() == "s"]
    longest = max(sum(b.num_rows for b in _tie_batches(iter([batch.slice(i, 1)]), 3, 90) if b.column(0)[0].as_py() == "s") for i in range(len(named)))
    assert len(of(whole)) == 1 and len(of(parts)) > 1 and max(of(parts)) <= 500 + longest < sum(of(parts))


def test_jaccard_keeps_one(docs, rows):
    classes = plain.jaccard_classes(rows, 5, 80)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in classes.items() if c == d)


def test_byte_repeats(docs, rows):
    cut = remove_repeats(docs, 50)
    got = {r[0]: tuple(r)[1:] for r in cut.select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()}
    assert got == plain.remove_repeats(rows, 50)


def test_deep_shallow_orders_like_sorting():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.integers(97, 99, (400, 50)).astype(np.uint8)
    x[:, :40] = x[rng.integers(0, 4, 400)][:, :40]  # long common prefixes
    x[100:200] = x[:100]
    order, cls = deep_shallow(x, np.zeros(400, np.int64))
    strings = [r.tobytes() for r in x]
    assert [strings[i] for i in order] == sorted(strings)
    assert all((cls[i] == cls[j]) == (strings[i] == strings[j]) for i in range(0, 400, 7) for j in range(400))


def test_blind_trie():
    items = [b"abcd", b"abce", b"abcd", b"aaaa", b"zbcd", b"abzd", b"\0bzd"]
    trie = BlindTrie(items[0], 0)
    for i, s in enumerate(items[1:], 1):
        trie.add(s, i)
    assert [sorted(x) for x in trie.leaves()] == [[6], [3], [0, 2], [1], [5], [4]]


def test_lines(docs, rows):
    got = {(r.doc_id, r.n): (r.a, r.b, r.text) for r in dedup_lines(docs.withColumn("n", F.col("text")), out="mix").select(
        "doc_id", "n", "text", F.col("mix.n_lines").alias("a"), F.col("mix.removed").alias("b")).collect()}
    assert got == plain.dedup_lines(rows, 3, 50)


def test_rules(docs, rows):
    judged = quality_rules(docs, out="words")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("InMemory")[0]
    got = {r.doc_id: r.words for r in judged.collect()}
    for d, t in rows:
        want = plain.rule_counts(t)
        assert {f: got[d][f] for f in want} == want, d
        assert not (want["base_failed"] and got[d].kept)
    assert got[7].kept is (not plain.rule_counts(dict(rows)[7])["base_failed"])


def test_rules_tell_junk(spark):
    good = ("The river runs through the old town and turns to the north at the bridge. In the morning the light comes over the "
            "hills, and the people of the market bring out bread, fruit and flowers for the day. It is said that a ship was "
            "built on this bank long before the road was made. Children play on the stones, and it is warm in the sun. "
            "Nobody knows who first planted the trees that stand along the water, but every spring they turn green.")
    junk = [good.upper().replace(" ", "!! "), good.replace(" ", " *** "), good.replace(" ", " | ")]
    df = spark.createDataFrame(list(enumerate([good, *junk])), "doc_id long, text string")
    assert [r.rules.kept for r in quality_rules(df).orderBy("doc_id").collect()] == [True, False, False, False]


def test_mix(docs, rows):
    mixed = mix_sources(docs, out="size")
    got = mixed.select("doc_id", "source", "size.*").collect()
    sizes: dict = {}
    for r in got:
        assert r["size"] == len(plain.words(dict(rows)[r.doc_id]))
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    targets = plain.water_targets(sizes, (3, 1, 2), 1.5, 2.0)
    for s, size in sizes.items():
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {size}
        assert all(abs(r.target - targets[s]) < 1e-6 for r in mine)
        # whole documents only: a text that outweighs its source leaves up to half of it open
        room = max(0.02 * targets[s] + 30, max(r["size"] for r in mine) / 2)
        assert abs(sum(r["size"] * r.copies for r in mine) - targets[s]) <= room
    assert max(r.copies for r in got) <= 2
    again = {r.doc_id: r["size"].copies for r in mix_sources(docs.repartition(3), out="size").collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert repeated(mixed, "size").count() == sum(r.copies for r in got)


def test_shared_passages(docs, rows):
    found = shared_passages(docs).collect()
    got = {r.doc_id for r in found}
    holders = [d for d, t in rows if d < 60 and d % 3 == 0]
    assert set(holders[1:]) <= got and holders[0] not in got
    assert {d for d in range(61, 90) if d % 5} <= got
    assert not {d for d in range(1, 60) if d % 3} & got, "clean documents"
    texts = dict(rows)
    for r in found:
        assert r.source_id < r.doc_id and r.n_words == r.stop - r.start >= 50
        a = [w.lower() for w in plain.words(texts[r.doc_id])][r.start : r.stop]
        b = [w.lower() for w in plain.words(texts[r.source_id])][r.source_start : r.source_stop]
        assert r.n_equal <= min(len(a), len(b)) and r.n_equal >= 0.8 * max(len(a), len(b))


def test_chains_score_like_all_predecessors():
    rng = random.Random(2)
    c = Chaining(max_gap=10**6)
    for _ in range(40):
        seeds = sorted({(rng.randrange(80), rng.randrange(80)) for _ in range(25)})
        best = {}
        for p, s in seeds:
            ahead = [(best[q] - c.gap_cost * (p - q[0] + s - q[1]) + min(c.k, p - q[0], s - q[1]), q) for q in best if q[0] < p and q[1] < s]
            best[(p, s)] = max([c.k] + [v for v, _ in ahead])
        for chain in chains(seeds, c):
            assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chain, chain[1:]))
    line = [(i, i + 7) for i in range(0, 60, 5)]
    assert chains(line + [(3, 70)], c)[0] == line


def best_scores(seeds, c):
    """Scores by all predecessors within the gap limit."""
    best = {}
    for p, s in sorted(set(seeds)):
        ahead = [best[q] - c.gap_cost * (p - q[0] + s - q[1]) + min(c.k, p - q[0], s - q[1]) for q in best
                 if 0 < p - q[0] <= c.max_gap and 0 < s - q[1] <= c.max_gap]
        best[(p, s)] = max([c.k] + ahead)
    return best


def test_chains_within_the_gap_limit_score_like_all_predecessors():
    rng = random.Random(7)
    for c in (Chaining(), Chaining(max_gap=12), Chaining(max_gap=3)):
        for _ in range(60):
            seeds = [(rng.randrange(200), rng.randrange(200)) for _ in range(rng.randint(1, 80))]
            best, found = best_scores(seeds, c), chains(seeds, c)
            for chain in found:
                assert all(0 < b[0] - a[0] <= c.max_gap and 0 < b[1] - a[1] <= c.max_gap for a, b in zip(chain, chain[1:]))
            top = max(best.values())
            assert (top > c.k) == bool(found)
            if found:
                gained = c.k
                for a, b in zip(found[0], found[0][1:]):
                    gained += min(c.k, b[0] - a[0], b[1] - a[1]) - c.gap_cost * (b[0] - a[0] + b[1] - a[1])
                assert gained == pytest.approx(top)


def test_chains_of_groups_are_those_of_each_group():
    rng = random.Random(23)
    for c in (Chaining(), Chaining(max_gap=12)):
        for _ in range(60):
            groups = []
            for _ in range(3):
                seeds, p, s = [], rng.randrange(50), rng.randrange(50)
                for _ in range(rng.randint(0, 40)):
                    step = rng.choice([6, 60, 79, 80, 81]) if rng.random() < 0.2 else rng.randint(1, 9)
                    p, s = p + step, s + step + (rng.randint(0, 9) * 6 if rng.random() < 0.1 else 0)
                    seeds += [(p, s)] * rng.choice([1, 1, 2])
                    if rng.random() < 0.02:
                        seeds.append((rng.randrange(200), rng.randrange(200)))
                groups.append(seeds)
            rows = [(g, p, s) for g, seeds in enumerate(groups) for p, s in seeds]
            rng.shuffle(rows)
            got = chains_of_groups(*np.array(rows, np.int64).reshape(-1, 3).T, c)
            assert sorted(got) == sorted((g, chain) for g, seeds in enumerate(groups) if seeds for chain in chains(seeds, c))


def test_chains_of_copies_need_no_tree(monkeypatch):
    monkeypatch.setattr(passage_chains, "RangeBest", None)
    seeds = np.arange(0, 3000, 5)
    found = list(chains_of_groups(np.repeat([0, 1], 600), np.r_[seeds, seeds], np.r_[seeds + 7, seeds], Chaining()))
    assert [(g, len(chain)) for g, chain in found] == [(0, 600), (1, 600)]


@pytest.mark.parametrize("first,apart,second", [(200, 100, 100), (1000, 100, 500), (100, 300, 80)])
def test_chains_of_two_passages(first, apart, second):
    one = [(i, 7 + i) for i in range(0, first, 5)]
    two = [(first + apart + i, first + 2 * apart + i) for i in range(0, second, 5)]
    assert sorted(chains(one + two, Chaining())) == [one, two]


def test_shared_passages_two_in_one_pair(spark):
    rng = random.Random(13)
    one, two = prose(rng, 200), prose(rng, 100)
    texts = [(1, f"{one} {prose(rng, 100)} {two}"), (2, f"{prose(rng, 9)} {one} {prose(rng, 110)} {two}")]
    found = shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.start, r.source_start, r.n_words) for r in found) == [(9, 0, 200), (319, 300, 100)]


def test_many_runs_of_one_anchor_keep_their_bytes_apart():
    x = np.random.default_rng(3).integers(0, 256, 6_000_000, np.uint8)
    h, content, start, n, off = Runs(50).of(x)
    rows = np.zeros(len(h), _RUN)
    rows["content"], rows["start"], rows["doc"], rows["n"] = content, start, np.arange(len(h)), 1  # as under one hot anchor
    _, first, smallest = _sorted_runs(rows)
    assert len({x[a : a + k + 49].tobytes() for a, k in zip(start.tolist(), n.tolist())}) == len(rows)
    assert len(first) == len(rows)


@pytest.mark.parametrize("parts", [1, 6])
def test_shared_passages_of_lines_that_also_stand_alone(spark, parts):
    rng = random.Random(17)
    texts, passages = [], []

    def text(middle):
        ahead, behind = prose(rng, rng.randint(20, 60)), prose(rng, rng.randint(40, 60))
        texts.append((len(texts), f"{ahead} {middle} {behind}"))
        return len(texts) - 1, len(ahead.split())

    for words, n_lines in [(40, 2)] * 6 + [(28, 2)] * 6 + [(28, 3)] * 6:
        lines = [" ".join(prose(rng, words).split()) for _ in range(n_lines)]
        places = {}
        for _ in range(4):
            for line in lines:
                text(line)
            d, at = text(" ".join(lines))
            places[d] = at
        passages.append((places, words * n_lines))
    got = {}
    for r in shared_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)).collect():
        got.setdefault((r.doc_id, r.start, r.n_words), set()).add(r.source_id)
    for places, n in passages:
        for d in sorted(places)[1:]:
            assert got.get((d, places[d], n), set()) & {x for x in places if x < d}


def test_shared_passages_at_two_places_of_a_text(spark):
    rng = random.Random(19)
    passage = prose(rng, 80)
    texts = [(1, passage), (2, f"{prose(rng, 30)} {passage} {prose(rng, 200)} {passage}")]
    found = shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.start, r.source_start, r.n_words) for r in found) == [(30, 0, 80), (310, 0, 80)]


@pytest.mark.parametrize("parts", [1, 6])
def test_shared_passages_whose_runs_all_stand_in_others(spark, parts):
    """Neither the first holder of a run nor the one before holds enough of the passage; the one that does is found."""
    rng = random.Random(29)
    texts, want = [], set()

    def text(middle):
        texts.append((len(texts), f"{prose(rng, 40)} {middle} {prose(rng, 40)}"))
        return len(texts) - 1

    for _ in range(8):
        passage = prose(rng, 60).split()
        pieces = [" ".join(passage[a : a + 48]) for a in range(0, 13, 2)]
        for piece in pieces:
            text(piece)
        source = text(" ".join(passage))
        for piece in pieces:
            text(piece)
        want.add((text(" ".join(passage)), source))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)
    found = shared_passages(docs).where("start = 40 and source_start = 40 and n_words = 60").collect()
    assert {(r.doc_id, r.source_id) for r in found} == want


@pytest.mark.parametrize("line", ["la", "la le lo", "one two three four five six seven eight nine"])
def test_shared_passages_of_a_line_that_comes_again(spark, line):
    rng = random.Random(31)
    many = " ".join([line] * 90)
    cut = lambda n: " ".join(many.split()[:n])
    texts = [(1, f"{prose(rng, 60)} {cut(70)} {prose(rng, 60)}"), (2, f"{prose(rng, 30)} {cut(80)} {prose(rng, 200)} {cut(70)}")]
    covered = set()
    for r in shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        assert (r.doc_id, r.source_id) == (2, 1) and r.n_words >= 50 and r.n_equal >= 0.8 * r.n_words
        covered |= set(range(r.start, r.stop))
    assert covered >= {*range(39, 101), *range(319, 371)}  # within a window of the ends


@pytest.mark.parametrize("max_nodes", [300, 20_000, 1 << 20])
def test_scores(docs, rows, max_nodes):
    """The same scores, whatever part of the trie is sent."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    got = {r.doc_id: r for r in score_texts(docs, ~held, max_nodes=max_nodes, hot_words=20).collect()}
    whole = plain.ppm(rows, lambda d: plain.fold(d, 5) == 1, ORDER)
    for d, (n, known, train, base) in plain.unigram(rows, lambda d: plain.fold(d, 5) == 1).items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert abs(r.score - whole[d]) < 1e-8 * max(1, abs(whole[d]))


def test_trie_is_a_distribution(spark):
    from hirestream.llm.ppm import BITS, SYMBOLS, _sum_sorted, rare_costs, train_trie

    keys, n = _sum_sorted(gram_keys([b"the anon of the thing", b"the other anon", b"an onion"] * 3)[0])
    grams = spark.createDataFrame(list(zip(keys.astype(np.int64).tolist(), n.tolist())), "key long, n long")
    for max_nodes in (20, 1 << 20):
        trie, levels, contexts = train_trie(grams, max_nodes=max_nodes)
        assert sum(map(len, trie.pair_keys)) <= max_nodes
        for text in (b"the", b"qqq", b"an on"):
            context = gram_keys([text])[0][-1] >> np.uint64(BITS)
            keys = (context << np.uint64(BITS)) | np.arange(SYMBOLS, dtype=np.uint64)
            cost, open_ = trie.prepare().costs(keys)
            asked = spark.createDataFrame([(int(x),) for x in keys[open_]], "key long")
            rest = [r.cost for r in rare_costs(asked, levels, contexts, trie.uniform).collect()]
            assert open_.any() == (max_nodes == 20) and len(rest) == open_.sum()
            assert abs((10 ** cost[~open_]).sum() + sum(10**c for c in rest) - 1) < 1e-9


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    got = classify_quality(docs, labels, ~held).where(held).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)


def test_odd_tables(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1), (5, 1), (6, 0), (None, None)], "doc_id long, quality int")
    odd = docs.unionByName(docs.where("doc_id in (5, 60)")).unionByName(
        docs.where("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    n = odd.count()
    always = F.lit(True)
    assert quality_rules(empty).count() == 0 and quality_rules(odd).count() == n
    assert mix_sources(empty).count() == 0 and mix_sources(odd).count() == n
    assert dedup_lines(empty).count() == 0 and dedup_lines(odd).count() == n
    assert jaccard_classes(empty).count() == 0 and jaccard_classes(odd).count() == n - 1
    assert remove_repeats(empty).count() == 0 and remove_repeats(odd).count() == n
    assert shared_passages(empty).count() == 0 and shared_passages(odd).count() > 0
    assert score_texts(empty, always).count() == 0 and score_texts(odd, always).count() == n
    assert score_texts(odd, F.lit(False)).select(F.max("base_score")).first()[0] == 0.0
    assert classify_quality(empty, labels, always).count() == 0
    scored = classify_quality(odd, labels, always).collect()
    assert len(scored) == n and all(0 <= r.score <= 1 for r in scored)
    assert len(classify_quality(odd, labels.where("false"), always).collect()) == n


def test_columns_that_clash(spark, docs):
    names = ["__doc", "__row", "__runs", "__cut", "__name", "__salt", "__null", "__plan_name", "__size", "__key", "__gone", "__time", "rid"]
    odd = docs.where("doc_id < 40").withColumns({c: F.col("doc_id") for c in names})
    n = odd.count()
    for got in (dedup_lines(odd), mix_sources(odd), drop_near_duplicates(odd), repeated(mix_sources(odd))):
        assert set(odd.columns) - {"mix"} <= set(got.columns) and all(r["__row"] == r["doc_id"] == r["rid"] for r in got.collect())
    assert dedup_lines(odd).count() == mix_sources(odd).count() == n


def test_signatures_are_sorted_in_as_many_tasks_as_the_texts_need(spark, docs, monkeypatch):
    """Else a large table's tasks spill what they sort, however small the number of shuffle partitions is."""
    from hirestream.llm import jaccard_join
    from hirestream.session import STAGED

    want = sorted(jaccard_classes(docs).collect())
    monkeypatch.setattr(jaccard_join, "TASK_BYTES", 10_000, raising=False)
    since = len(STAGED)
    assert sorted(jaccard_classes(docs).collect()) == want
    ties = next(p for p in STAGED[since:] if "/ties-" in p)
    assert len(spark.read.parquet(ties).inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_one_row_of_repeated_rows_stays(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(7, a), (7, a), (9, a), (None, a), (None, b), (None, b), (3, c), (3, b + " end"), (4, None), (4, None), (5, ""), (5, "")]
    got = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted(
        [(7, a), (3, c), (3, b + " end"), (4, ""), (4, ""), (5, ""), (5, "")])
