"""Suffix arrays by induced sorting, written for whole numpy arrays at a time."""

from __future__ import annotations

import numpy as np

#: Largest alphabet whose buckets are walked one by one; ranks of larger ones are doubled.
ALPHABET = 1024


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol is the unique smallest."""
    n = len(text)
    rises = np.zeros(n, dtype=bool)
    rises[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, dtype=bool)
    differs[:-1] = text[:-1] != text[1:]
    # Within a run of equal symbols the type is that of the run's last suffix.
    at = np.where(differs, np.arange(n), n)
    decides = np.minimum.accumulate(at[::-1])[::-1]
    small = rises[decides]
    small[-1] = True
    return small


def leftmost_smaller(small: np.ndarray) -> np.ndarray:
    """Positions of smaller-type suffixes whose left neighbour is of the larger type."""
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def _ranks_within(chars: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol, each one's place within its symbol, and counts."""
    order = np.argsort(chars, kind="stable")
    counts = np.bincount(chars, minlength=symbols)
    first = np.cumsum(counts) - counts
    return order, np.arange(len(chars)) - first[chars[order]], counts


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array that the given order of leftmost-smaller suffixes induces.

    Buckets are walked upwards for the larger type, then downwards for the smaller
    one. A bucket's suffixes are taken in waves: those there when it is reached,
    those that they put into the same bucket, and so on; the left neighbours of a
    wave go to their buckets together.
    """
    n = len(text)
    size = np.bincount(text, minlength=symbols)
    end = np.cumsum(size)
    head = end - size
    larger = np.bincount(text[~small], minlength=symbols)
    out = np.full(n, -1, dtype=np.int64)
    chars = text[seeds]
    order, place, counts = _ranks_within(chars, symbols)
    seed_start = np.cumsum(counts) - counts
    by_bucket = seeds[order]

    def left_of(wave: np.ndarray, kind: bool) -> np.ndarray:
        left = wave[wave > 0] - 1
        return left[small[left] == kind]

    fill = head.copy()
    for c in np.flatnonzero(size):
        done = head[c]
        while done < fill[c]:
            wave = out[done : fill[c]]
            done = fill[c]
            _append(out, fill, text, left_of(wave, False), symbols, 1)
        own = by_bucket[seed_start[c] : seed_start[c] + counts[c]]
        if len(own):
            _append(out, fill, text, left_of(own, False), symbols, 1)
    fill = end.copy()
    for c in np.flatnonzero(size)[::-1]:
        done = end[c]
        if c == text[-1]:  # the last suffix has no right neighbour to induce it
            out[end[c] - 1] = n - 1
            fill[c] -= 1
        while done > fill[c]:
            wave = out[fill[c] : done][::-1]
            done = fill[c]
            _append(out, fill, text, left_of(wave, True), symbols, -1)
        own = out[head[c] : head[c] + larger[c]][::-1]
        if len(own):
            _append(out, fill, text, left_of(own, True), symbols, -1)
    return out


def _append(out: np.ndarray, fill: np.ndarray, text: np.ndarray, found: np.ndarray, symbols: int, way: int) -> None:
    """Puts suffixes into their buckets in the order given, upwards or downwards."""
    if not len(found):
        return
    chars = text[found]
    order, place, counts = _ranks_within(chars, symbols)
    at = fill[chars[order]]
    out[at + place if way > 0 else at - 1 - place] = found[order]
    fill += way * counts


def names_of(text: np.ndarray, small: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings, equal for equal ones, in sorted order."""
    sites = np.sort(ordered)
    nxt = np.empty(len(text), dtype=np.int64)
    nxt[sites] = np.r_[sites[1:], len(text) - 1]
    length = nxt[ordered] - ordered
    same = np.r_[False, length[1:] == length[:-1]]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        a, b = ordered[left], ordered[left - 1]
        equal = (text[a + k] == text[b + k]) & (small[a + k] == small[b + k])
        same[left[~equal]] = False
        left = left[equal & (length[left] > k)]
        k += 1
    return np.cumsum(~same) - 1


def doubled_order(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of many symbols, by doubling ranks of unsettled ones."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    step = 1
    rank = names.astype(np.int64).copy()
    sorted_names = names[order]
    first = np.r_[True, sorted_names[1:] != sorted_names[:-1]]
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = group
    while True:
        last = np.r_[first[1:], True]
        open_ = np.flatnonzero(~(first & last))
        if not len(open_):
            return order
        members = order[open_]
        after = members + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[members]))
        members, second = members[by], second[by]
        order[open_] = members
        own = rank[members]
        new = np.r_[True, (own[1:] != own[:-1]) | (second[1:] != second[:-1])]
        first[open_] = new
        start = np.maximum.accumulate(np.where(new, open_, 0))
        rank[members] = start
        step *= 2


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``text``, whose last symbol is smaller than all others and unique."""
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = suffix_types(text)
    seeds = leftmost_smaller(small)
    if len(seeds) > 1:
        rough = induce(text, small, seeds, symbols)
        is_seed = np.zeros(n, dtype=bool)
        is_seed[seeds] = True
        ordered = rough[is_seed[rough]]
        names = names_of(text, small, ordered)
        if names[-1] + 1 < len(ordered):
            by_site = np.empty(n, dtype=np.int64)
            by_site[ordered] = names
            reduced = by_site[seeds]
            count = int(names[-1]) + 1
            ordered = seeds[suffix_array(reduced, count) if count <= ALPHABET else doubled_order(reduced)]
        seeds = ordered
    return induce(text, small, seeds, symbols)


def common_prefixes(body: np.ndarray, at: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths, up to ``most``, of the suffixes ``at`` and ``before`` (pairs).

    ``body`` is padded by at least ``most`` + 8 bytes. Eight bytes are compared at a
    time; lengths are whole words but for ``most`` itself, which need not be one.
    """
    words = np.ndarray((len(body) - 7,), dtype="<u8", buffer=np.ascontiguousarray(body), strides=(1,))
    out = np.zeros(len(at), dtype=np.int64)
    left = np.arange(len(at))
    for k in [*range(0, most - 7, 8), *([most - 8] if most % 8 and most > 8 else [])]:
        left = left[words[at[left] + k] == words[before[left] + k]]
        if not len(left):
            break
        out[left] = k + 8
    return out


def permuted_common_prefixes(body: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in sorted ``order``: the positions in text order and, for each, the
    length (up to ``most``) that it shares with its neighbours in the order."""
    shared = common_prefixes(body, order[1:], order[:-1], most)
    best = np.maximum(np.r_[0, shared], np.r_[shared, 0])
    by_text = np.argsort(order, kind="stable")
    return order[by_text], best[by_text]
