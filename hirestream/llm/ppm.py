"""Language-model scoring by prediction by partial matching (PPM).

Counts of a symbol after each of its contexts, up to ``ORDER`` bytes long, are
summed over all training texts and stay in tables.  The trie of contexts sent to
the tasks holds the most frequent nodes up to a fixed number, each with the exact
figures of the whole training part.  A position that this trie cannot settle (a
symbol or context that may only be too rare for it) meets its counts in joins, so
the scores do not depend on the size of what is sent.  A symbol is looked up in its longest context;
where it is missing, the escape probability (number of different symbols against
all occurrences) is paid and the next shorter context is tried without the symbols
of the longer one (symbol exclusion), down to all symbols being equally likely.
What a symbol costs depends only on its contexts, so it is computed with array
look-ups for millions of bytes at a time.

A unigram model of words is the base score.  Its most frequent words are known to
the tasks, a fixed number; all other words meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import mix64, run_starts, stage

ORDER = 5
BITS = 9
#: Start of text in contexts, end of text as a symbol.
EDGE = 256
SYMBOLS = 257
MAX_NODES = 1 << 20
HOT_WORDS = 1 << 16
CHUNK_BYTES = 1 << 20
FLUSH = 2 << 20
#: Texts a task works on at a time.
SLICE = 512


def lower(text: str) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return text.encode("utf-8").lower()


def gram_keys(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, symbol) of every position, end of text included, and where each text begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    edge = np.full(1, EDGE, np.uint16)
    pad = np.full(order, EDGE, np.uint16)
    parts: list[np.ndarray] = []
    for t in texts:
        parts += [pad, np.frombuffer(t, np.uint8).astype(np.uint16), edge]
    x = np.concatenate(parts).astype(np.uint64)
    n = len(x) - order
    key = np.zeros(n, np.uint64)
    for j in range(order + 1):
        key = (key << np.uint64(BITS)) | x[j : j + n]
    # positions whose symbol is padding of the next text go
    lengths = sizes + 1
    first = np.cumsum(lengths + order) - (lengths + order)
    keep = np.zeros(n + order, np.int8)
    keep[first] += 1
    ends = first + lengths
    keep[ends] -= 1
    return key[np.cumsum(keep[:n]).astype(bool)], np.cumsum(lengths) - lengths


def _sum_sorted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        first = run_starts(keys)
        return keys[first], np.diff(np.r_[first, len(keys)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = run_starts(keys)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_hash(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def training_counts(docs: DataFrame, order: int) -> DataFrame:
    """``(kind, key, n)`` over rows ``(text)``: grams (g), words by hash (w) and texts (t), added up per part of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, words, texts_seen = [], 0, Counter(), 0

        def rows(kind: str, k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.repeat(kind, len(k)), pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))],
                ["kind", "key", "n"])

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            return _sum_sorted(*(np.concatenate([p[i] for p in parts]) for i in range(2)))

        def flush_words() -> pa.RecordBatch:
            k = np.fromiter(map(word_hash, words), np.int64, len(words))
            n = np.fromiter(words.values(), np.int64, len(words))
            words.clear()
            return rows("w", k, n)

        for batch in _slices(batches):
            texts = [lower(t) for t in batch.column(0).to_pylist()]
            texts_seen += len(texts)
            for t in texts:
                words.update(t.split())
                if len(words) > FLUSH // 8:
                    yield flush_words()
            for a, b in _chunks(texts):
                held.append(_sum_sorted(gram_keys(texts[a:b], order)[0]))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield rows("g", *held.pop())
                        size = 0
        if held:
            yield rows("g", *merged(held))
        yield flush_words()
        yield rows("t", np.zeros(1), np.full(1, texts_seen))

    return docs.select("text").mapInArrow(run, "kind string, key long, n long")


class Index:
    """Numbers of the given distinct keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2 - 1).bit_length()) if len(keys) else 4
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.at = np.full(size, ~np.uint64(0)), np.full(size, -1, np.int32)
        self.mask = size - 1
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.at[slot] < 0
            # of those that want one free slot, the last written stays
            self.at[slot[free]] = left[free]
            won = self.at[slot] == left
            self.keys[slot[won]] = keys[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = self.at[slot]
        open_ = np.flatnonzero((held != keys) & (out >= 0))
        out[(held != keys)] = -1
        while len(open_):
            slot_ = (slot[open_] + 1) & self.mask
            slot[open_] = slot_
            number = self.at[slot_]
            hit = (self.keys[slot_] == keys[open_]) & (number >= 0)
            out[open_[hit]] = number[hit]
            open_ = open_[~hit & (number >= 0)]
        return out


@dataclass
class Trie:
    """Costs (log10) of symbols in contexts, by order; see ``train_trie``."""

    order: int
    pair_keys: list[np.ndarray]  # context and symbol
    pair_log: list[np.ndarray]  # log of the symbol's count
    context_keys: list[np.ndarray]
    total_log: list[np.ndarray]  # log of the denominator in this context
    escape: list[np.ndarray]  # log probability of leaving this context
    below_log: list[np.ndarray]  # denominator in the next shorter context without this one's symbols
    below_escape: list[np.ndarray]  # leaving that one as well
    settled: list[np.ndarray]  # whether all symbols of the context are here
    whole: bool  # whether every node of the training part is here
    uniform: float

    def prepare(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    def __init__(self, t: Trie):
        self.t = t
        self.pairs = [Index(k) for k in t.pair_keys]
        self.contexts = [Index(k) for k in t.context_keys]
        k = t.order
        # the usual case needs one look-up: the symbol is known in its longest context
        full = np.zeros(0) if not len(t.pair_keys[k]) else t.pair_log[k] - t.total_log[k][
            self.contexts[k].find(t.pair_keys[k] >> np.uint64(BITS))]
        self.full = full

    def costs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each packed (context, symbol), and where the trie cannot settle it (0 there)."""
        t, k = self.t, self.t.order
        out, open_ = np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = self.pairs[k].find(keys)
        known = at >= 0
        out[known] = self.full[at[known]] if len(self.full) else 0.0
        left = np.flatnonzero(~known)
        child = np.full(len(left), -1, np.int64)  # number of the longer context in which the symbol was missing
        for j in range(k, -1, -1):
            if not len(left):
                break
            mask = np.uint64((1 << (BITS * (j + 1))) - 1)
            key = keys[left] & mask
            pair = self.pairs[j].find(key)
            context = self.contexts[j].find(key >> np.uint64(BITS))
            fresh, hit = child < 0, pair >= 0
            if not t.whole:
                # a missing symbol or context may be one that is too rare to be here
                sure = hit.copy()
                sure[context >= 0] |= t.settled[j][context[context >= 0]]
                open_[left[~sure]] = True
                left, child, pair, context, fresh, hit = (v[sure] for v in (left, child, pair, context, fresh, hit))
            cost = np.zeros(len(left))
            a = fresh & hit
            cost[a] = t.pair_log[j][pair[a]] - t.total_log[j][context[a]]
            a = fresh & ~hit & (context >= 0)
            cost[a] = t.escape[j][context[a]]
            if j < k:
                a = ~fresh & hit
                cost[a] = t.pair_log[j][pair[a]] - t.below_log[j + 1][child[a]]
                a = ~fresh & ~hit
                cost[a] = t.below_escape[j + 1][child[a]]
            out[left] += cost
            left, child = left[~hit], context[~hit]
        out[left] += t.uniform
        out[open_] = 0.0
        return out, open_

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Sums by text of what the trie settles; and per text the other positions as distinct keys with their numbers."""
        out, rest = np.empty(len(texts)), []
        for a, b in _chunks(texts):
            keys, first = gram_keys(texts[a:b], self.t.order)
            cost, open_ = self.costs(keys)
            out[a:b] = np.add.reduceat(cost, first)
            if open_.any():
                places = np.flatnonzero(open_)
                of = np.searchsorted(first, places, "right") - 1
                cuts = run_starts(of)
                for x, y in zip(cuts, np.r_[cuts[1:], len(of)]):
                    rest.append((a + int(of[x]), *_sum_sorted(keys[places[x:y]])))
        return out, rest


def count_limit(sizes: dict[int, int], bound: int) -> float:
    """The smallest count, in eighths of a doubling, that at most ``bound`` rows reach; ``sizes``: rows by step."""
    held = 0
    for s in sorted(sizes, reverse=True):
        if held + sizes[s] > bound:
            return 2 ** ((s + 1) / 8)
        held += sizes[s]
    return 1.0


def count_steps(rows: DataFrame, n: str) -> dict[int, int]:
    """Rows by eighths of a doubling of their count: a few hundred, whatever the corpus."""
    return dict(rows.groupBy(F.floor(F.log2(n) * 8).cast("int").alias("s")).count().collect())


def _low(key: str, symbols: int) -> Column:
    """The last symbols of a packed key."""
    return F.col(key).bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def context_tables(levels: list[DataFrame]) -> list[DataFrame]:
    """Per order ``(key, total, symbols, least, most, total_log, escape, below_log, below_escape)`` of all contexts.

    Escape by method C: with q symbols seen in T occurrences, a symbol has
    n / (T + q) and the escape q / (T + q).  In the next shorter context the symbols
    of this one are left out; all of them occur there, too.
    """
    tables: list[DataFrame] = []
    for j, level in enumerate(levels):
        pairs = level
        if j:
            shorter = levels[j - 1].select(F.col("key").alias("__k"), F.col("n").alias("n_below"))
            pairs = level.join(shorter, _low("key", j) == F.col("__k"))
        sums = [F.sum("n").alias("total"), F.count(F.lit(1)).alias("symbols"), F.min("n").alias("least"), F.max("n").alias("most")]
        if j:
            sums.append(F.sum("n_below").alias("excluded"))
        found = pairs.groupBy(F.shiftright("key", BITS).alias("key")).agg(*sums)
        below_log = below_escape = F.lit(0.0)
        if j:
            up = tables[-1].select(F.col("key").alias("__k"), (F.col("total") + F.col("symbols")).alias("all_up"),
                                   F.col("symbols").alias("symbols_up"))
            found = found.join(up, _low("key", j - 1) == F.col("__k"))
            rest = F.col("all_up") - F.col("excluded") - F.col("symbols")
            below_log = F.when(rest > 0, F.log10(rest)).otherwise(0.0)
            more = F.col("symbols_up") - F.col("symbols")
            below_escape = F.when(rest <= 0, 0.0).when(more > 0, F.log10(more) - F.log10(rest)).otherwise(-300.0)
        all_ = F.log10(F.col("total") + F.col("symbols"))
        tables.append(stage(found.select(
            "key", "total", "symbols", "least", "most", all_.alias("total_log"), (F.log10("symbols") - all_).alias("escape"),
            below_log.alias("below_log"), below_escape.alias("below_escape")), f"contexts-{j}"))
    return tables


def train_trie(grams: DataFrame, order: int = ORDER, max_nodes: int = MAX_NODES) -> tuple[Trie, list[DataFrame], list[DataFrame]]:
    """The trie from summed grams ``(key, n)``, and the tables of all pairs and contexts, shortest order first.

    At most ``max_nodes`` (context, symbol) nodes come to the driver, kept by their
    count in the whole training part, with one limit for all orders.
    """
    levels = [grams]
    for j in range(order - 1, -1, -1):
        levels.append(stage(levels[-1].groupBy(_low("key", j + 1).alias("key")).agg(F.sum("n").alias("n")), f"order-{j}"))
    levels.reverse()
    contexts = context_tables(levels)
    sizes: Counter[int] = Counter()
    for level in levels:
        sizes.update(count_steps(level, "n"))
    limit = count_limit(sizes, max_nodes)
    t = Trie(order, [], [], [], [], [], [], [], [], limit <= 1, 0.0)
    for level, table in zip(levels, contexts):
        p = level.where(F.col("n") >= (limit - 1e-9)).toArrow()
        t.pair_keys.append(p["key"].to_numpy().astype(np.uint64))
        t.pair_log.append(np.log10(p["n"].to_numpy().astype(np.float64)))
        c = table.where(F.col("most") >= (limit - 1e-9)).select(
            "key", "total_log", "escape", "below_log", "below_escape", (F.col("least") >= (limit - 1e-9)).alias("settled")).toArrow()
        t.context_keys.append(c["key"].to_numpy().astype(np.uint64))
        for name in ("total_log", "escape", "below_log", "below_escape", "settled"):
            getattr(t, name).append(c[name].to_numpy())
    top = contexts[0].select("symbols").first()
    t.uniform = -float(np.log10(max(1, SYMBOLS - (top[0] if top else 0))))
    return t, levels, contexts


def rare_costs(keys: DataFrame, levels: list[DataFrame], contexts: list[DataFrame], uniform: float) -> DataFrame:
    """``(key, cost)`` of distinct packed keys from the tables of all pairs and contexts.

    A symbol seen in an order is seen in all shorter ones, and so is a context.  So
    the longest order of either says what is paid: the escape of the longest
    context, the escapes below it down to the symbol, and the symbol itself.
    """
    order = len(levels) - 1
    wide = keys.select("key")
    for j, (level, table) in enumerate(zip(levels, contexts)):
        pair = level.select(F.col("key").alias("__p"), F.log10("n").alias(f"n{j}"))
        context = table.select(F.col("key").alias("__c"), F.struct("total_log", "escape", "below_log", "below_escape").alias(f"c{j}"))
        wide = wide.join(pair, _low("key", j + 1) == F.col("__p"), "left").drop("__p")
        wide = wide.join(context, F.shiftright(_low("key", j + 1), BITS) == F.col("__c"), "left").drop("__c")
    cost = F.lit(uniform)
    for j in range(order + 1):
        # paid from order j downwards: first where a longer context was left, then where this one is the longest
        left = F.lit(0.0) if j == order else F.when(F.col(f"n{j}").isNotNull(), F.col(f"n{j}") - F.col(f"c{j + 1}.below_log")).otherwise(
            F.col(f"c{j + 1}.below_escape") + F.col("from_left"))
        fresh = F.when(F.col(f"n{j}").isNotNull(), F.col(f"n{j}") - F.col(f"c{j}.total_log")).when(
            F.col(f"c{j}").isNotNull(), F.col(f"c{j}.escape") + F.col("from_left")).otherwise(F.col("from_fresh"))
        if j == 0:
            wide = wide.withColumns({"from_left": cost, "from_fresh": cost})
        wide = wide.withColumns({"from_left": left, "from_fresh": fresh})
    return wide.select("key", F.col("from_fresh").alias("cost"))


def _scored(docs: DataFrame, trie: Trie, hot: dict[int, int], ends: int, tokens: int, distinct: int) -> DataFrame:
    """Rows of documents (with what trie and hot words give), of their other words and of their other grams: ``(rid, kind, h, n, doc)``."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((trie, hot))
    schema = "rid long, kind string, h long, n long, doc struct<doc_id: long, tokens: long, known: long, base: double, score: double>"
    doc_type = pa.struct([("doc_id", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
                          ("score", pa.float64())])
    under = float(np.log10(tokens + 0.5 * (distinct + 1)))

    def rows(kind: str, rid: pa.Array, h: pa.Array, n: pa.Array | None, doc: pa.Array | None = None) -> pa.RecordBatch:
        k = len(rid)
        return pa.RecordBatch.from_arrays(
            [rid, pa.repeat(kind, k), h, pa.nulls(k, pa.int64()) if n is None else n,
             pa.nulls(k, doc_type) if doc is None else doc], ["rid", "kind", "h", "n", "doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, counts = sent.value
        scorer = trie.prepare()
        hot_log = {h: (float(np.log10(c + 0.5)) - under) for h, c in counts.items()}
        end_log = float(np.log10(ends + 0.5)) - under
        hashes: dict[bytes, int] = {}
        for batch in _slices(batches):
            texts = [lower(t) for t in batch.column(2).to_pylist()]
            scores, rest = scorer.score(texts)
            rids = batch.column(0).to_pylist()
            docs_, tail_rid, tail_h, tail_n = [], [], [], []
            for rid, doc, text, s in zip(rids, batch.column(1).to_pylist(), texts, scores.tolist()):
                words = text.split()
                known, base = int(ends > 0), end_log
                for w, c in Counter(words).items():
                    h = hashes.get(w)
                    if h is None:
                        if len(hashes) > 100_000:
                            hashes.clear()
                        h = hashes[w] = word_hash(w)
                    v = hot_log.get(h)
                    if v is None:
                        tail_rid.append(rid)
                        tail_h.append(h)
                        tail_n.append(c)
                    else:
                        known += c
                        base += c * v
                docs_.append({"doc_id": doc, "tokens": len(words) + 1, "known": known, "base": base, "score": s})
            own = mix64(np.array(rids, np.int64).astype(np.uint64)).astype(np.int64)
            yield rows("d", pa.array(rids, pa.int64()), pa.array(own), None, pa.array(docs_, doc_type))
            yield rows("w", pa.array(tail_rid, pa.int64()), pa.array(tail_h, pa.int64()), pa.array(tail_n, pa.int64()))
            if rest:
                of = np.concatenate([np.full(len(keys), rids[i], np.int64) for i, keys, _ in rest])
                keys, n = (np.concatenate([r[j] for r in rest]).astype(np.int64) for j in (1, 2))
                yield rows("g", pa.array(of), pa.array(keys), pa.array(n))

    return docs.select("rid", "doc_id", "text").mapInArrow(run, schema)


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, max_nodes: int = MAX_NODES, hot_words: int = HOT_WORDS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    ``learn`` is a condition on ``doc_id``; both models learn from those rows only.
    ``score`` is the log10 probability of the text, A-Z in lower case, with its end;
    tokens of ``base_score`` are the words and one end.  NULL texts are empty and
    cost their end alone; without training rows all symbols are equally likely and
    the base score is 0.  Repeated rows are trained on and scored as often as they
    occur; a NULL id is scored.  Extra columns are ignored.  ``max_nodes`` and
    ``hot_words`` bound what is sent to the tasks and do not change the scores:
    what is not sent is joined.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text)
    raw = training_counts(rows.where(learn), order)
    summed = stage(raw.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    trie, levels, contexts = train_trie(summed.where("kind = 'g'").select("key", "n"), order, max_nodes)
    words = stage(summed.where("kind = 'w'").select(F.col("key").alias("h"), F.col("n").alias("c")), "words")
    ends = summed.where("kind = 't'").agg(F.sum("n")).first()[0] or 0
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = total + ends, distinct + int(ends > 0)
    top = words.where(F.col("c") >= count_limit(count_steps(words, "c"), hot_words) - 1e-9).toArrow()
    hot = dict(zip(top["h"].to_pylist(), top["c"].to_pylist()))
    scored = _scored(rows.withColumn("rid", F.monotonically_increasing_id()), trie, hot, ends, tokens, distinct)
    under = F.log10(F.lit(tokens + 0.5 * (distinct + 1)))
    none = F.lit(None).cast("double")
    if not trie.whole:
        scored = stage(scored, "scored")
        # each key is resolved once, then met by all texts that hold it
        grams = scored.where("kind = 'g'")
        costs = stage(rare_costs(grams.select(F.col("h").alias("key")).distinct(), levels, contexts, trie.uniform), "rare-costs")
        rare = grams.join(costs.withColumnRenamed("key", "h"), "h").select("rid", "doc", none.alias("cost"),
                                                                           F.lit(None).cast("long").alias("known"),
                                                                           (F.col("n") * F.col("cost")).alias("rare"))
    # a row of a word can only match a word; the rows of documents carry hashes of their own
    joined = scored.where("kind <> 'g'").join(words, "h", "left")
    cost = F.when(F.col("n").isNotNull(), F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - under))
    known = F.when(F.col("n").isNotNull() & F.col("c").isNotNull(), F.col("n"))
    joined = joined.select("rid", "doc", cost.alias("cost"), known.alias("known"), none.alias("rare"))
    if not trie.whole:
        joined = joined.unionByName(rare)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    out = joined.groupBy("rid").agg(F.max("doc").alias("doc"), zero("cost"), zero("known"), zero("rare"))
    return out.select("doc.doc_id", F.col("doc.tokens").alias("n_tokens"), (F.col("doc.known") + F.col("known")).alias("n_known"),
                      F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("doc.base") + F.col("cost")).alias("base_score"),
                      (F.col("doc.score") + F.col("rare")).alias("score"))
