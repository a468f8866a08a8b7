"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

``suffix_array`` classifies the suffixes (S or L), sorts the leftmost-smaller
(LMS) substrings by one induction, names them, recurses on the names where
they repeat, and induces the whole array from the sorted LMS suffixes.  Over
a small alphabet an induction handles a bucket's pending suffixes together;
over the large alphabets of the recursion it goes suffix by suffix.
"""

from __future__ import annotations

import numpy as np


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is S-type (smaller than the next one); the last, unique smallest symbol is S."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        change = np.where(s[:-1] != s[1:], np.arange(n - 1), n)
        nearest = np.minimum.accumulate(change[::-1])[::-1]  # first change at or after each place
        out[:-1] = s[nearest] < s[nearest + 1]
    return out


def _grouped(at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at in stable key order, their keys, rank within the key)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    starts = np.flatnonzero(first)
    return at[order], keys, np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))


def _induce_buckets(s: np.ndarray, stype: np.ndarray, lms: np.ndarray, heads: np.ndarray,
                    tails: np.ndarray) -> np.ndarray:
    """The induction, all pending suffixes of a bucket at a time."""
    sa = np.full(len(s), -1, np.int64)
    placed, keys, rank = _grouped(lms[::-1], s[lms[::-1]])
    sa[tails[keys] - rank] = placed
    size = np.bincount(keys, minlength=len(heads))
    front, back = heads.copy(), tails.copy()

    def pending(at: np.ndarray, want_s: bool) -> np.ndarray:
        at = at[at > 0] - 1
        return at[stype[at] == want_s]

    def put(at: np.ndarray, up: bool) -> None:
        placed, keys, rank = _grouped(at, s[at])
        last = np.flatnonzero(np.concatenate([keys[1:] != keys[:-1], [True]]))
        if up:
            sa[front[keys] + rank] = placed
            front[keys[last]] += rank[last] + 1
        else:
            sa[back[keys] - rank] = placed
            back[keys[last]] -= rank[last] + 1

    symbols = np.unique(s).tolist()
    for c in symbols:
        done = heads[c]
        while done < front[c]:
            at, done = sa[done:front[c]], front[c]
            at = pending(at, False)
            if len(at):
                put(at, True)
        if size[c]:
            at = pending(sa[tails[c] - size[c] + 1:tails[c] + 1], False)
            if len(at):
                put(at, True)
    # the LMS suffixes were only seeds: the S pass writes all S suffixes anew
    large = front.copy()
    for c in reversed(symbols):
        done = tails[c]
        while done > back[c]:
            at, done = sa[back[c] + 1:done + 1][::-1], back[c]
            at = pending(at, True)
            if len(at):
                put(at, False)
        at = pending(sa[heads[c]:large[c]][::-1], True)
        if len(at):
            put(at, False)
    sa[0] = len(s) - 1
    return sa


def _induce_each(s: np.ndarray, stype: np.ndarray, lms: np.ndarray, heads: np.ndarray,
                 tails: np.ndarray) -> np.ndarray:
    """The induction, suffix by suffix."""
    n, text, small = len(s), s.tolist(), stype.tolist()
    sa = [-1] * n
    end = tails.tolist()
    for p in lms[::-1].tolist():
        sa[end[text[p]]] = p
        end[text[p]] -= 1
    at = heads.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not small[j]:
            c = text[j]
            sa[at[c]] = j
            at[c] += 1
    end = tails.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = text[j]
            sa[end[c]] = j
            end[c] -= 1
    return np.array(sa, np.int64)


def _names(s: np.ndarray, ordered: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Name of each sorted LMS substring: equal ones share a name."""
    a, b = ordered[:-1], ordered[1:]
    length = following[a] - a
    same = length == following[b] - b
    live, k = np.flatnonzero(same), 0
    while len(live):
        differ = s[a[live] + k] != s[b[live] + k]
        same[live[differ]] = False
        live = live[~differ]
        live = live[length[live] > k]
        k += 1
    return np.concatenate([[0], np.cumsum(~same)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative symbols; the last must be the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    stype = classify(s)
    lms = np.flatnonzero(stype & ~np.concatenate([[True], stype[:-1]]))
    counts = np.bincount(s)
    tails = np.cumsum(counts) - 1
    heads = tails - counts + 1
    induce = _induce_buckets if len(counts) * 64 < n else _induce_each
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        first = induce(s, stype, lms, heads, tails)
        ordered = first[is_lms[first]]
        following = np.zeros(n, np.int64)
        following[lms] = np.append(lms[1:], n - 1)
        names = _names(s, ordered, following)
        name_at = np.zeros(n, np.int64)
        name_at[ordered] = names
        reduced = name_at[lms]
        if names[-1] + 1 < len(lms):
            lms = lms[suffix_array(reduced)]
        else:
            lms = lms[np.argsort(reduced)]
    return induce(s, stype, lms, heads, tails)


def permuted_lcp(text: bytes, sa: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """For each position, the common prefix with the suffix just before it in the array.

    Only irreducible positions (and ``starts``, where texts were joined) are
    compared, eight bytes at a time and up to ``most``; at any other
    position the value is one less than at the position before.
    """
    n = len(sa)
    before = np.zeros(n, np.int64)
    before[sa[1:]] = sa[:-1]
    raw = np.frombuffer(text + bytes(16 + most), np.uint8)
    own = np.zeros(n, bool)
    own[1:] = (before[1:] == 0) | (raw[:n - 1] != raw[before[1:] - 1])
    own[0] = own[sa[0]] = True
    own[starts] = True
    irreducible = np.flatnonzero(own)
    value = np.zeros(len(irreducible), np.int64)
    live = np.flatnonzero(irreducible != sa[0])
    lanes = np.arange(8)
    while len(live):
        a, b = irreducible[live] + value[live], before[irreducible[live]] + value[live]
        inside = np.minimum(n - 1 - a, n - 1 - b)
        same = (raw[a[:, None] + lanes] == raw[b[:, None] + lanes]) & (lanes < inside[:, None])
        step = np.where(same.all(1), 8, same.argmin(1))
        value[live] += step
        live = live[(step == 8) & (value[live] < most)]
    which = np.cumsum(own) - 1
    return np.maximum(value[which] - (np.arange(n) - irreducible[which]), 0)
