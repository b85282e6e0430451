"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import xxhash


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def find(up: dict, x):
    while up[x] != x:
        x = up[x]
    return x


def jaccard_classes(rows, k: int, percent: int) -> dict:
    """id -> (set size, smallest reachable id), all pairs compared."""
    def shingles(t):
        w = [x.lower() for x in words(t)]
        if not w:
            return frozenset()
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))

    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    up = {d: d for d, _ in sets}
    for i, (d, s) in enumerate(sets):
        for e, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = find(up, d), find(up, e)
                up[max(a, b)] = min(a, b)
    return {d: (len(s), find(up, d)) for d, s in sets}


def remove_repeats(rows, length: int) -> dict:
    seen: dict[bytes, int] = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = min(d, seen.get(b[i : i + length], d))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def dedup_lines(rows, run_lines: int, run_words: int) -> dict:
    """(id, text) -> (lines with a word, removed line numbers, text)."""
    first: dict = {}
    windows = []
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [(i, x) for i, x in enumerate((t or "").split("\n")) if words(x)]
        for a in range(len(lines)):
            n = 0
            for b in range(a, min(a + run_lines, len(lines))):
                n += len(words(lines[b][1]))
                if n >= run_words or b - a + 1 == run_lines:
                    key = tuple(x for _, x in lines[a : b + 1])
                    place = ((d is None, d or 0), a)
                    windows.append((key, place, (d, t), [i for i, _ in lines[a : b + 1]]))
                    first[key] = min(place, first.get(key, place))
                    break
    gone = collections.defaultdict(set)
    for key, place, row, at in windows:
        if place > first[key]:
            gone[row] |= set(at)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        g = gone[(d, t)]
        text = t if not g else "\n".join(x for i, x in enumerate(lines) if i not in g)
        out[(d, t)] = (sum(bool(words(x)) for x in lines), sorted(g), text)
    return out


def rule_counts(text: str | None) -> dict:
    t = text or ""
    w = words(t)
    grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if words(x)]
    n = len(w)
    return {
        "n_words": n, "word_chars": sum(len(x.decode()) for x in w), "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def water_targets(sizes: dict, weights, share: float, epochs: float) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, out = share * sum(sizes.values()), set(names), {}
    while rest:
        level = left / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > epochs * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in rest}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        rest -= over
    return out


def unigram(rows, held_out) -> dict:
    counts: collections.Counter = collections.Counter()
    tokens = {d: [x.lower() for x in words(t)] + [None] for d, t in rows}
    for d, t in tokens.items():
        if not held_out(d):
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    cost = lambda x: math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1)))
    return {d: (len(t), sum(counts[x] > 0 for x in t), n, sum(map(cost, t))) for d, t in tokens.items()}


def ppm(rows, held_out, order: int) -> dict:
    """Log10 probability of each text: contexts as tuples, escape by method C, symbols of the longer context excluded."""
    spelled = lambda text: [256] * order + list((text or "").encode("utf-8").lower()) + [256]
    counts: dict = {}
    for d, text in rows:
        if not held_out(d):
            x = spelled(text)
            for i in range(order, len(x)):
                for j in range(order + 1):
                    c = counts.setdefault(tuple(x[i - j : i]), {})
                    c[x[i]] = c.get(x[i], 0) + 1
    out = {}
    for d, text in rows:
        x, total = spelled(text), 0.0
        for i in range(order, len(x)):
            gone: set = set()
            for j in range(order, -1, -1):
                seen = counts.get(tuple(x[i - j : i]))
                if seen is None:
                    continue
                left = {s: n for s, n in seen.items() if s not in gone}
                if not left:
                    continue
                under = sum(left.values()) + len(left)
                if x[i] in left:
                    total += math.log10(left[x[i]] / under)
                    break
                total += math.log10(len(left) / under)
                gone |= set(left)
            else:
                total -= math.log10(max(1, 257 - len(gone)))
        out[d] = total
    return out


def fold(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def runs(x, least: int, exponent: int) -> list:
    """(start, length, period) of the maximal stretches with smallest period q and enough words, every period tried."""
    n, out = len(x), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, exponent * q):
                w = x[i : i + size]
                if all(any(w[k] != w[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, found) -> bytes:
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def simhash(text: str | None) -> int:
    w = [x.lower() for x in words(text)]
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
