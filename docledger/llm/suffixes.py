"""Suffix arrays by induced sorting and permuted common prefixes, in whole-array steps.

A text is bytes that hold SEPARATOR after every piece, and nowhere else (UTF-8 never holds it). A suffix is of type S if it
is smaller than the next one, else L; the leftmost S suffixes of each run, LMS, sort all others. Their substrings
are sorted by inducing, equal ones share a name, and the string of names, whose alphabet is about as long as itself,
is ordered by doubling its prefixes, each step a sort of those that are not told apart yet. Inducing takes the buckets of the 256 bytes in turn; a bucket's
suffixes are placed at once, and once more for each repetition of its byte.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last one is larger than the empty one after it."""
    small = np.zeros(len(text), bool)
    change = np.flatnonzero(text[:-1] != text[1:])
    if len(change):
        stop = np.repeat(change, np.diff(change, prepend=-1))
        small[: change[-1] + 1] = text[stop] < text[stop + 1]
    return small


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array, or the order of LMS substrings, from LMS suffixes in some order within their buckets."""
    n = len(text)
    count = np.bincount(text, minlength=256)
    by_byte = text[lms]
    order = np.argsort(by_byte, kind="stable")
    lms, at = lms[order], np.searchsorted(by_byte[order], np.arange(257))
    # from the left: L suffixes
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:  # what the empty suffix induces
        larger[text[n - 1]].append(np.array([n - 1]))

    def pass_on(block: np.ndarray, want: bool, byte: int, into: list[list[np.ndarray]]) -> np.ndarray | None:
        before = block[block > 0] - 1
        before = before[small[before] == want]
        if not len(before):
            return None
        kinds = text[before]
        same = kinds == byte
        again = before[same] if same.any() else None
        if again is not None:
            before, kinds = before[~same], kinds[~same]
        if len(before):
            order = np.argsort(kinds, kind="stable")
            kinds, before = kinds[order], before[order]
            cut = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
            for part, byte_of in zip(np.split(before, cut), kinds[np.r_[0, cut]], strict=True):
                into[byte_of].append(part)
        return again

    for byte in np.flatnonzero(count):
        # what comes from smaller bytes first, round by round with its own repetitions, then the LMS suffixes
        block = np.concatenate(larger[byte]) if larger[byte] else None
        done = []
        while block is not None and len(block):
            done.append(block)
            block = pass_on(block, False, byte, larger)
        larger[byte] = done
        mine = lms[at[byte] : at[byte + 1]]
        if len(mine):
            pass_on(mine, False, byte, larger)
    # from the right: S suffixes, the largest first
    smaller: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for byte in np.flatnonzero(count)[::-1]:
        block = np.concatenate(smaller[byte]) if smaller[byte] else None
        done = []
        while block is not None and len(block):
            done.append(block)
            block = pass_on(block, True, byte, smaller)
        left = np.concatenate(larger[byte])[::-1] if larger[byte] else None
        if left is not None:
            pass_on(left, True, byte, smaller)
            done.append(left)
        out += done
    return np.concatenate(out)[::-1] if out else np.zeros(0, np.int64)


def _names(text: np.ndarray, small: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """A name for each LMS suffix, in text order: equal names for equal substrings, in their order. order: LMS suffixes sorted by substring."""
    rank = np.searchsorted(lms, order)
    # a substring ends with the next LMS suffix's first byte; the last one ends with the text and equals no other
    length = np.append(lms[1:] - lms[:-1] + 1, -1)[rank]
    differs = np.ones(len(order), bool)
    pair = np.flatnonzero(length[1:] == length[:-1])
    a, b, size = order[pair], order[pair + 1], length[pair]
    step, alive = 0, np.arange(len(pair))
    same = np.zeros(len(pair), bool)
    while len(alive):
        x, y = a[alive] + step, b[alive] + step
        equal = (text[x] == text[y]) & (small[x] == small[y])
        alive, x = alive[equal], None
        end = size[alive] == step + 1
        same[alive[end]] = True
        alive = alive[~end]
        step += 1
    differs[pair[same] + 1] = False
    names = np.empty(len(order), np.int64)
    names[rank] = np.cumsum(differs) - 1
    return names


def _ordered(names: np.ndarray) -> np.ndarray:
    """Suffixes of the names in their order. A rank is the place of the first suffix that agrees so far; only suffixes whose rank others share are sorted again, each time by twice as many names."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # what follows the last one is smaller than all
    step = 1
    while True:
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        open_ = np.flatnonzero(~(first & np.r_[first[1:], True]))  # places in order whose suffix shares its rank
        if not len(open_):
            return order
        mine = order[open_]
        group, after = rank[mine], rank[np.minimum(mine + step, n)]
        sort = np.lexsort((after, group))
        mine, group, after = mine[sort], group[sort], after[sort]
        order[open_] = mine
        first[open_] = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        step *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of bytes in their order."""
    small = types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) < 2:
        return _induce(text, small, lms)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    rough = _induce(text, small, lms)
    names = _names(text, small, lms, rough[is_lms[rough]])
    return _induce(text, small, lms[_ordered(names)])


def common(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each place, how many bytes its suffix shares with the one before it in array, up to a separator.

    Only places whose byte before differs from the one before their partner are compared; from any other place's
    predecessor the prefix is one byte shorter.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    partner = np.full(n, -1, np.int64)
    partner[array[1:]] = array[:-1]
    ends = np.flatnonzero(text == SEPARATOR)
    nearest = np.searchsorted(ends, np.arange(n))
    room = np.append(ends, n)[nearest] - np.arange(n)
    first = partner < 0
    place = np.arange(n)
    before = np.where((place > 0) & (partner > 0), text[place - 1] == text[np.maximum(partner, 1) - 1], False)
    reducible = before & (text[place - 1] != SEPARATOR) & ~first
    at = np.flatnonzero(~reducible & ~first)
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    words = np.ndarray((n + 1,), "<u8", padded.tobytes(), strides=(1,))
    length = np.zeros(n, np.int64)
    shared, alive = np.zeros(len(at), np.int64), np.arange(len(at))
    limit = np.minimum(room[at], room[partner[at]])
    step = 0
    while len(alive):
        x = words[at[alive] + step] ^ words[partner[at[alive]] + step]
        low = x & (~x + np.uint64(1))  # the lowest differing bit
        bits = np.bitwise_count(low - np.uint64(1)).astype(np.int64)
        full = x == 0
        shared[alive] = np.minimum(step + np.where(full, 8, bits // 8), limit[alive])
        alive = alive[full & (limit[alive] > step + 8)]
        step += 8
    length[at] = shared
    # along a run of reducible places the prefix and the place add up to the same
    total = length + place
    start = np.maximum.accumulate(np.where(reducible, -1, place))
    return np.maximum(0, total[start] - place)


def repeated(text: np.ndarray, size: int) -> np.ndarray:
    """Whether the size bytes from each place stand elsewhere too; False where a separator is among them."""
    array = suffix_array(text)
    length = common(text, array)
    out = length >= size
    out[array[:-1]] |= length[array[1:]] >= size
    return out
