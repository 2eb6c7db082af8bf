"""Suffix arrays by induced sorting, and permuted common prefixes, with NumPy.

Suffixes are classified as smaller (S) or larger (L) than their successor.  Leftmost S suffixes (LMS) are
sorted by their substrings, which are named in order; the names form a string of at most half the
length, whose suffixes are sorted in turn; all others are induced from them in one pass from the left
and one from the right.  A pass goes bucket by bucket, and moves all suffixes of a bucket that are known
at that time in one step.  Strings of names have more buckets than such steps would pay for: their
suffixes are ordered by doubling the sorted depth, only within groups that are still tied.

Common prefixes with the preceding suffix are computed in text order: where the characters before the
two suffixes are equal, the prefix is the one before less one; only the others are compared.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True for S-type positions; the last position, a unique smallest symbol, is S."""
    n = len(t)
    differ = np.flatnonzero(t[:-1] != t[1:])
    up = t[differ] < t[differ + 1]
    s = np.ones(n, bool)
    s[:-1] = up[np.searchsorted(differ, np.arange(n - 1))]
    return s


def _move(sa: np.ndarray, ptr: np.ndarray, j: np.ndarray, ch: np.ndarray, step: int) -> None:
    """Put the suffixes j, in this order, into the buckets of their characters, at ptr upwards or below it."""
    order = np.argsort(ch, kind="stable")
    c, j = ch[order], j[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    used = c[first]
    if step > 0:
        sa[ptr[c] + rank] = j
        ptr[used] += size
    else:
        sa[ptr[c] - 1 - rank] = j
        ptr[used] -= size


def _induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All suffixes from LMS suffixes that are in order by first character (and as far as they are sorted)."""
    n = len(t)
    sa = np.full(n, -1, np.int64)
    tail = np.cumsum(size)
    head = tail - size
    ptr = head.copy()
    at = np.searchsorted(t[lms], np.arange(len(size) + 1))
    used = np.flatnonzero(size)

    def back(some: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        j = some[some > 0] - 1
        j = j[s[j] == kind]
        return j, t[j]

    for c in used.tolist():
        done = head[c]
        while done < ptr[c]:
            some, done = sa[done:ptr[c]], ptr[c]
            j, ch = back(some, False)
            if len(j):
                _move(sa, ptr, j, ch, 1)
        if at[c + 1] > at[c]:
            j, ch = back(lms[at[c]:at[c + 1]], False)
            if len(j):
                _move(sa, ptr, j, ch, 1)
    end = ptr                                               # L suffixes of bucket c: head[c] to end[c]
    ptr = tail.copy()
    sa[0] = n - 1
    for c in used[::-1].tolist():
        done = tail[c]
        while done > ptr[c]:
            some, done = sa[ptr[c]:done][::-1], ptr[c]
            j, ch = back(some, True)
            if len(j):
                _move(sa, ptr, j, ch, -1)
        if end[c] > head[c]:
            j, ch = back(sa[head[c]:end[c]][::-1], True)
            if len(j):
                _move(sa, ptr, j, ch, -1)
    sa[0] = n - 1
    return sa


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each LMS substring of ``ordered`` differs from the one before it."""
    place = np.empty(len(t), np.int64)
    place[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms), 0) + 1
    size = length[place[ordered]]
    new = np.ones(len(ordered), bool)
    pair = np.flatnonzero(size[1:] == size[:-1]) + 1
    o = 0
    while len(pair):
        same = t[ordered[pair] + o] == t[ordered[pair - 1] + o]
        pair = pair[same]
        o += 1
        over = size[pair] <= o
        new[pair[over]] = False
        pair = pair[~over]
    return new


def _double(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    key = names[order]
    place = np.arange(n)                                    # where the suffixes still to be ordered stand
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    k = 1
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[place]] = place[np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))]
        tied = ~first
        tied[:-1] |= ~first[1:]
        place = place[tied]
        if not len(place):
            return order
        i = order[place]
        key = rank[i] * (n + 1) + rank[np.minimum(i + k, n)] + 1
        by = np.argsort(key, kind="stable")
        order[place], key = i[by], key[by]
        k *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of ``text`` (small non-negative integers) in lexicographic order; a suffix
    that is a prefix of another comes first."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    t = np.append(text.astype(np.uint16 if text.max() < 65535 else np.int64) + 1, 0).astype(
        np.uint16 if text.max() < 65535 else np.int64)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    size = np.bincount(t)
    sa = _induce(t, s, lms[np.argsort(t[lms], kind="stable")], size)
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    new = _names(t, lms, ordered)
    name = np.empty(n + 1, np.int64)
    name[ordered] = np.cumsum(new) - 1
    if not new.all():
        ordered = lms[_double(name[lms])]
    return _induce(t, s, ordered, size)[1:]


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the array (0 for the first)."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    t = np.concatenate([text.astype(np.uint32) + 1, np.zeros(4, np.uint32)])
    t[n + 1:] = 0
    two = np.ndarray(n + 2, "<u8", t.tobytes(), 0, (4,)).copy()          # two symbols from each position on
    i = np.arange(n)
    reduced = np.zeros(n, bool)
    ok = (i > 0) & (before > 0)
    reduced[ok] = t[i[ok] - 1] == t[before[ok] - 1]
    reduced &= before >= 0
    plcp = np.zeros(n, np.int64)
    a = np.flatnonzero(~reduced & (before >= 0))
    b, at, long = before[a], a, np.zeros(len(a), np.int64)
    while len(at):
        end = np.maximum(a, b) + long
        x = two[np.minimum(a + long, n)] ^ two[np.minimum(b + long, n)]
        go = (x == 0) & (end + 2 <= n)
        stop = ~go
        one = stop & ((x & np.uint64(0xFFFFFFFF)) == 0) & (end < n)
        plcp[at[stop]] = long[stop] + one[stop]
        a, b, at, long = a[go], b[go], at[go], long[go] + 2
    whole = np.maximum.accumulate(np.where(reduced, -1, i))              # last position that was compared
    follow = np.flatnonzero(reduced)
    plcp[follow] = np.maximum(plcp[whole[follow]] - (follow - whole[follow]), 0)
    return plcp[sa]
