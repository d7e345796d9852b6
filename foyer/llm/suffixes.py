"""Suffix arrays of byte blocks by induced sorting, and permuted common prefixes, in numpy.

Induction runs bucket by bucket: what a bucket holds induces its predecessors in one step, in order,
and what falls into the same bucket is the next step, so steps per bucket are at most the longest
run of its byte. Values 0 and 1 are for the end and for separators; bytes of UTF-8 text stay
below 0xF8 and are shifted by 2.
"""

from __future__ import annotations

import numpy as np

from foyer.llm.bytewords import Prefix

SEPARATOR, SHIFT, SIGMA = 1, 2, 256


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the end counts as smaller."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    at = np.where(differs, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    smaller = np.append(text[1:] > text[:-1], True)
    return smaller[at]


def _scatter(array, places, chars, values, step):
    """Put values at the front (step 1) or the back (-1) of their buckets' free part, in order."""
    order = np.argsort(chars, kind="stable")
    counts = np.bincount(chars, minlength=SIGMA)
    rank = np.arange(len(chars)) - np.repeat(np.cumsum(counts) - counts, counts)
    array[places[chars[order]] + step * rank] = values[order]
    places += step * counts


def _induce(text, small, starts, lms):
    """The suffixes in order, given those of ``lms`` in order."""
    n = len(text)
    array = np.full(n, -1, np.int32)
    ends = np.append(starts[1:], n)
    # The leftmost smaller ones, at the ends of their buckets.
    chars = text[lms]
    counts = np.bincount(chars, minlength=SIGMA)
    array[np.arange(len(lms)) + np.repeat(ends - np.cumsum(counts), counts)] = lms
    front = starts.copy()
    for c in np.flatnonzero(ends > starts):
        done = starts[c]
        while done < front[c]:
            now = array[done : front[c]]
            done = front[c]
            _spread(array, text, small, front, now, False)
        _spread(array, text, small, front, array[ends[c] - counts[c] : ends[c]], False)
    back = ends - 1
    for c in np.flatnonzero(ends > starts)[::-1]:
        done = ends[c] - 1
        while done > back[c]:
            now = array[back[c] + 1 : done + 1][::-1]
            done = back[c]
            _spread(array, text, small, back, now, True)
        _spread(array, text, small, back, array[starts[c] : front[c]][::-1], True)
    return array


def _spread(array, text, small, places, now, smaller):
    before = now[now > 0] - 1
    before = before[small[before] == smaller]
    if len(before):
        _scatter(array, places, text[before], before, -1 if smaller else 1)


def _reduced_order(names: np.ndarray) -> np.ndarray:
    """Suffixes of the reduced string in order: ranks by doubling, among those still tied."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 1
    while True:
        tied = ~(first & np.append(first[1:], True))
        places = np.flatnonzero(tied)
        if not len(places):
            break
        which = order[places]
        ahead = np.where(which + step < n, rank[np.minimum(which + step, n - 1)] + 1, 0)
        again = np.lexsort((ahead, rank[which]))
        which, ahead = which[again], ahead[again]
        own = rank[which]
        order[places] = which
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])])
        first[places] = fresh
        rank[which] = np.maximum.accumulate(np.where(fresh, places, 0))
        step *= 2
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of a uint8 block that ends in its only 0."""
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    counts = np.bincount(text, minlength=SIGMA)
    starts = np.cumsum(counts) - counts
    by_char = lms[np.argsort(text[lms], kind="stable")]
    array = _induce(text, small, starts, by_char)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    ranked = array[is_lms[array]]
    # Names: equal substrings, up to and with the next leftmost smaller place, share one.
    after = np.empty(len(text), np.int32)
    after[lms] = np.append(lms[1:], lms[-1])
    ends = np.minimum(after[ranked] + 1, len(text))
    hashes = Prefix(text).hashes(ranked, ends)
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    names = np.empty(len(text), np.int64)
    names[ranked] = np.cumsum(new) - 1
    if not new.all():
        ranked = lms[_reduced_order(names[lms])]
    return _induce(text, small, starts, ranked)


def common_prefixes(text: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place: the place before it in suffix order (-1: none), and their common prefix length.

    Only where the bytes before differ is a prefix compared; elsewhere it is one less than at the
    place before.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[array[0]] = -1
    before[array[1:]] = array[:-1]
    at = np.arange(n)
    own = (before <= 0) | (at == 0)
    own[1:] |= text[:-1] != text[before[1:] - 1]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(), (n + 8, 8), (1, 1))
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    place = np.flatnonzero(own & (before >= 0))
    other = before[place]
    length = np.zeros(n, np.int64)
    so_far = 0
    while len(place):
        x = eight[np.minimum(place + so_far, n)] ^ eight[np.minimum(other + so_far, n)]
        equal = x == 0
        ended = ~equal
        low = x[ended] & (~x[ended] + np.uint64(1))
        length[place[ended]] = so_far + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        place, other = place[equal], other[equal]
        so_far += 8
        if so_far > n:
            length[place] = n - np.maximum(place, other)
            break
    # From the last compared place on, one less with each step.
    reach = np.where(own, length + at, -1)
    source = np.maximum.accumulate(np.where(own, at, 0))
    return before, np.maximum(reach[source] - at, 0)
