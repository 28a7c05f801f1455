"""Suffix arrays by induced sorting, on whole numpy batches, and permuted longest-common-prefix values.

Suffixes are of type S (smaller than their right neighbour) or L; the leftmost S suffixes are placed first, all L
suffixes are induced from them bucket by bucket upward, then all S suffixes downward.  A bucket's suffixes induce
their left neighbours as one batch; those that fall into the same bucket form its next batch, so the order is that
of the scan one by one.  The first pass sorts the substrings between leftmost S suffixes, which are named; if names
repeat, the names' suffixes are sorted recursively; the second pass induces the rest.
"""

from __future__ import annotations

import numpy as np

#: Beyond this many symbols per suffix a bucket holds next to nothing; such (reduced) texts are sorted by doubling.
SPARSE = 64


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last (the unique least symbol) is."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    # an equal pair has the type of the next unequal one
    nxt = np.where(step != 0, np.arange(n - 1), n - 1)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    out = np.ones(n, dtype=bool)
    inner = nxt < n - 1
    out[:-1][inner] = step[nxt[inner]] > 0
    return out


def _place(sa: np.ndarray, at: np.ndarray, chars: np.ndarray, rows: np.ndarray, step: int) -> None:
    """Append rows to their buckets (heads upward, tails downward), in order."""
    if not len(rows):
        return
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.nonzero(np.append(True, c[1:] != c[:-1]))[0]
    size = np.diff(np.append(first, len(c)))
    within = np.arange(len(c)) - np.repeat(first, size)
    sa[at[c] + step * within] = rows[order]
    at[c[first]] += step * size


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The order of all suffixes (or substrings) induced from the given order of the leftmost S ones."""
    n, k = len(text), len(bounds) - 1
    sa = np.full(n, -1, dtype=np.int64)
    heads, tails = bounds[:-1].copy(), bounds[1:] - 1
    chars = text[lms]
    placed = [lms[0:0]] * k
    order = np.argsort(chars, kind="stable")
    cut = np.searchsorted(chars[order], np.arange(k + 1))
    for c in np.nonzero(np.diff(cut))[0]:
        placed[c] = lms[order[cut[c] : cut[c + 1]]]

    def left(batch: np.ndarray, s: bool) -> tuple[np.ndarray, np.ndarray]:
        before = batch[batch > 0] - 1
        before = before[is_s[before] == s]
        return before, text[before]

    for c in range(k):
        done = bounds[c]
        while done < heads[c]:  # the bucket's L suffixes, batch after batch
            batch = sa[done : heads[c]]
            done = heads[c]
            rows, to = left(batch, False)
            _place(sa, heads, to, rows, 1)
        if len(placed[c]):
            rows, to = left(placed[c], False)
            _place(sa, heads, to, rows, 1)
    for c in range(k - 1, -1, -1):
        done = bounds[c + 1] - 1
        while done > tails[c]:  # the bucket's S suffixes, from the right
            batch = sa[tails[c] + 1 : done + 1][::-1]
            done = tails[c]
            rows, to = left(batch, True)
            _place(sa, tails, to, rows, -1)
        if heads[c] > bounds[c]:
            rows, to = left(sa[bounds[c] : heads[c]][::-1], True)
            _place(sa, tails, to, rows, -1)
        if c == 0:  # the end mark, that no suffix induces
            sa[bounds[0]] = n - 1
    return sa


def _doubling(text: np.ndarray) -> np.ndarray:
    n = len(text)
    rank, step = text.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text of small integers that ends in a 0 found nowhere else."""
    n, k = len(text), int(text.max()) + 1
    if n < 3:
        return np.arange(n)[::-1].astype(np.int64)
    if k * SPARSE > n:
        return _doubling(text)
    is_s = _types(text)
    lms = np.nonzero(is_s[1:] & ~is_s[:-1])[0] + 1
    bounds = np.append(0, np.cumsum(np.bincount(text, minlength=k)))
    if len(lms) > 1:
        mark = np.zeros(n, dtype=bool)
        mark[lms] = True
        sa = _induce(text, is_s, lms, bounds)
        by = sa[mark[sa]]
        names = np.cumsum(np.append(0, ~_same(text, lms, by)))
        name_at = np.empty(n, np.int64)
        name_at[by] = names
        reduced = name_at[lms]
        order = np.argsort(reduced) if names[-1] == len(lms) - 1 else suffix_array(reduced)
        lms = lms[order]
    return _induce(text, is_s, lms, bounds)


def _same(text: np.ndarray, lms: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Whether each substring between leftmost S suffixes equals the one before it in order."""
    length = np.empty(len(text), np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = by[:-1], by[1:]
    same = (length[a] == length[b]) & (a != len(text) - 1) & (b != len(text) - 1)
    live = np.nonzero(same)[0]
    at = 0
    while len(live):
        equal = text[a[live] + at] == text[b[live] + at]
        same[live[~equal]] = False
        live = live[equal]
        at += 1
        live = live[length[a[live]] > at]
    return same


def permuted_lcp(text: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int) -> np.ndarray:
    """For each position, the common prefix of its suffix and the one before it in order, exact below ``cap`` less
    the stretch since the last of ``starts``.

    A position whose left neighbour equals that of its predecessor has one less than the position before it, so
    letters are compared only at the others (and at ``starts``).
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    reducible = np.zeros(n, dtype=bool)
    inner = np.nonzero((before > 0) & (np.arange(n) > 0))[0]
    reducible[inner] = text[inner - 1] == text[before[inner] - 1]
    reducible[starts] = False
    roots = np.nonzero(~reducible)[0]
    value = np.zeros(n, np.int64)
    live = roots[before[roots] >= 0]
    at = 0
    padded = np.append(text, np.full(cap + 1, -1, text.dtype))
    while len(live) and at < cap:
        live = live[padded[live + at] == padded[before[live] + at]]
        at += 1
        value[live] = at
    last = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    return np.maximum(value[last] - (np.arange(n) - last), 0)
