"""Names within an edit limit of each other, found along the prefixes of both sides.

The prefixes of two sets of names are trees.  They are walked together, one
character of the first side at a time, with all pairs of prefixes whose edit
distance is within the limit; what a prefix has cost is paid once for all names
that begin with it, and names that differ too much part ways early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Pairs of prefixes that are taken a character further at once.
STATES = 1 << 20


class NameTrie:
    """Prefixes of sorted distinct names, numbered by length and order; the children of one follow each other."""

    def __init__(self, names: list[str]):
        lens = np.array([len(x) for x in names])
        wide = int(lens.max())
        codes = np.array(names, f"U{wide}").view(np.uint32).reshape(len(names), wide)
        same = codes[1:] == codes[:-1]
        common = np.where(same.all(1), wide, same.argmin(1))
        common = np.r_[0, np.minimum(common, np.minimum(lens[1:], lens[:-1]))]
        at, total = np.zeros(len(names), np.int64), 1
        char, row, size, ends, parent = [[0]], [[0]], [[len(names)]], [[lens[0] == 0]], []
        for depth in range(1, wide + 1):
            rows = np.flatnonzero(lens >= depth)
            new = common[rows] < depth
            first = np.flatnonzero(new)
            heads = rows[first]
            char.append(codes[heads, depth - 1])
            row.append(heads)
            size.append(np.diff(np.r_[first, len(rows)]))
            ends.append(lens[heads] == depth)
            parent.append(at[heads])
            at[rows] = total + np.cumsum(new) - 1
            total += len(first)
        self.char, self.row, self.size, self.ends = (np.concatenate(x) for x in (char, row, size, ends))
        up = np.concatenate([np.zeros(0, np.int64), *parent])
        self.kids = np.bincount(up, minlength=total)
        self.first = np.cumsum(self.kids) - self.kids + 1

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of all nodes, and the place of each one's parent among them."""
        times = self.kids[nodes]
        of = np.repeat(np.arange(len(nodes)), times)
        return of, np.arange(len(of)) + np.repeat(self.first[nodes] - np.cumsum(times) + times, times)


def near_names(left: NameTrie, right: NameTrie, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both sides that can be within ``limit`` edits: all that are, some that are not, some more than once."""
    bits, width = max(1, limit.bit_length()), len(right.char)

    def least(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = u.min() if len(u) else 0  # of one length: few numbers
        key = np.sort(((u - base) * width + v) << bits | d)
        pair = key >> bits
        new = np.ones(len(key), bool)
        new[1:] = pair[1:] != pair[:-1]
        return pair[new] // width + base, pair[new] % width, (key & ((1 << bits) - 1))[new]

    stack = [(np.zeros(1, np.int64),) * 3]
    while stack:
        u, v, d = delta = stack.pop()
        for _ in range(limit):  # characters of the right side only
            can = delta[2] < limit
            of, kid = right.children(delta[1][can])
            if not len(kid):
                break
            delta = delta[0][can][of], kid, delta[2][can][of] + 1
            u, v, d = least(*map(np.concatenate, zip((u, v, d), delta)))
        alone = (left.size[u] == 1) & (right.size[v] == 1)
        found = alone | (left.ends[u] & right.ends[v])
        if found.any():
            pairs = np.unique(left.row[u[found]] * len(right.row) + right.row[v[found]])
            yield pairs // len(right.row), pairs % len(right.row)
        u, v, d = u[~alone], v[~alone], d[~alone]
        begin = np.flatnonzero(np.diff(u, prepend=-1))
        cuts = begin[np.flatnonzero(np.diff(begin // STATES, prepend=-1))]
        for a, b in zip(cuts, np.r_[cuts[1:], len(u)]):
            of, kid = left.children(u[a:b])
            v1, d1 = v[a:b][of], d[a:b][of]
            of, other = right.children(v1)
            d2 = d1[of] + (right.char[other] != left.char[kid][of])
            u1, v1, d1 = np.r_[kid, kid[of]], np.r_[v1, other], np.r_[d1 + 1, d2]
            near = d1 <= limit
            if near.any():
                stack.append(least(u1[near], v1[near], d1[near]))
