"""Suffix arrays by induced sorting, with numpy in place of the scan's inner loop.

The scans of induced sorting walk over buckets of suffixes with equal first byte. All suffixes that a bucket
places in other buckets, and those that it places in itself run by run, are found at once, so a scan is a few
array operations for each pair of bytes, linear in the text, whatever its length. The leftmost-smaller substrings
get names; the string of names is sorted by recursion, in which an alphabet of any size is sorted column by column.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S), the last included."""
    n = len(text)
    out = np.ones(n, bool)
    if n > 1:
        at = np.where(text[:-1] != text[1:], np.arange(n - 1), n - 1)
        where = np.minimum.accumulate(at[::-1])[::-1]  # the next place whose byte differs from the one behind it
        out[:-1] = (where < n - 1) & (text[np.minimum(where, n - 2)] < text[np.minimum(where, n - 2) + 1])
    return out


def _deal(into: list[list[np.ndarray]], text: np.ndarray, source: np.ndarray, low: int, high: int) -> None:
    """Put the predecessors of ``source``, in its order, into the lists of their bytes within [low, high)."""
    before = source[source > 0] - 1
    letter = text[before]
    keep = (letter >= low) & (letter < high)
    before, letter = before[keep], letter[keep]
    if not len(before):
        return
    order = np.argsort(letter, kind="stable")
    before, letter = before[order], letter[order]
    edge = np.flatnonzero(np.r_[True, letter[1:] != letter[:-1]])
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(letter)], strict=True):
        into[letter[a]].append(before[a:b])


def _own(text: np.ndarray, parts: list[np.ndarray], c: int) -> np.ndarray:
    """``parts`` and what they induce within the bucket of byte ``c`` itself."""
    waves = [np.concatenate(parts)] if parts else []
    while waves and len(wave := waves[-1]):
        before = wave[wave > 0] - 1
        waves.append(before[text[before] == c])
    return np.concatenate(waves) if waves else np.zeros(0, np.int64)


def _induce(text: np.ndarray, seeds: np.ndarray, size: int = 256) -> np.ndarray:
    """Order of all suffixes, given the order of the leftmost S suffixes of each run (``seeds``)."""
    letters = text[seeds]
    order = np.argsort(letters, kind="stable")
    edge = np.searchsorted(letters[order], np.arange(size + 1))
    seeds = seeds[order]
    pending: list[list[np.ndarray]] = [[] for _ in range(size)]
    large: list[np.ndarray] = []
    for c in range(size):
        large.append(_own(text, pending[c], c))
        pending[c] = []
        if len(large[c]):
            _deal(pending, text, large[c], c + 1, size)
        if edge[c] < edge[c + 1]:
            _deal(pending, text, seeds[edge[c] : edge[c + 1]], c + 1, size)
    pending = [[] for _ in range(size)]
    pending[text[-1]].append(np.array([len(text) - 1]))
    out: list[np.ndarray] = []
    for c in range(size - 1, -1, -1):
        small = _own(text, pending[c], c)
        pending[c] = []
        out.append(small)
        out.append(large[c][::-1])
        for part in (small, large[c][::-1]):
            if len(part):
                _deal(pending, text, part, 0, c)
    return np.concatenate(out)[::-1]


def _same(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` bytes from ``a`` and from ``b`` are equal, one by one."""
    equal, active, k = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(active):
        active = active[length[active] > k]
        good = text[a[active] + k] == text[b[active] + k]
        equal[active[~good]] = False
        active, k = active[good], k + 1
    return equal


def _arranged(columns: tuple[np.ndarray, np.ndarray], at: np.ndarray, count: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of items by ``count`` columns, then by ``final``: an item's first column is its head (``columns[0]``), the others
    stand behind place ``at`` of ``columns[1]``. Also which of them in this order differ from the one before.

    Items that agree on all columns so far have the same count or are both short of it, so column after column
    is compared, for those that are still alike only.
    """
    head, columns = columns
    order = np.argsort(head, kind="stable")
    key = head[order]
    new = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(at)])
    group, open_ = np.repeat(first, size), np.repeat(size > 1, size)
    top, k = int(max(columns.max(), final.max())) + 1, 1
    while len(slots := np.flatnonzero(open_)):
        items = order[slots]
        inside = count[items] > k
        value = np.where(inside, columns[np.minimum(at[items] + k, len(columns) - 1)], final[items])
        key = group[slots] * top + value
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[slots] = items[by]
        edge = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(edge)
        size = np.diff(np.r_[first, len(key)])
        group[slots] = np.repeat(slots[first], size)
        new[slots[first]] = True
        open_[slots] = np.repeat(size > 1, size) & inside[by]
        k += 1
    return order, new


def _by_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``names`` (integers; the last is smaller than all others), by recursion.

    Its own leftmost-smaller substrings are named in turn until all names differ. The order of these suffixes then
    orders all others: each is told by its symbols up to the next of them, and its rank. A run of one name is one
    symbol: the longer it is, the larger before a smaller name, and the smaller before a larger one.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    if n < 2 or (np.diff(names[order]) > 0).all():
        return order
    small = _types(names)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    begin = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    run = np.cumsum(np.r_[True, names[1:] != names[:-1]]) - 1
    left = np.r_[begin[1:], n][run] - np.arange(n)
    symbol = np.unique((2 * names.astype(np.int64) + small) * (2 * n + 2) + np.where(small, n - left, n + left), return_inverse=True)[1]
    columns = symbol[begin]
    follow = np.searchsorted(marks, np.arange(n), "right")
    count = run[np.r_[marks, n - 1][follow]] - run + 1  # the symbol of the next mark included
    order, new = _arranged((symbol[marks], columns), run[marks], count[marks], np.zeros(len(marks), np.int64))
    reduced = np.empty(len(marks), np.int64)
    reduced[order] = np.cumsum(new) - 1
    rank = np.zeros(len(marks) + 1, np.int64)  # the last is behind the last name, which stands alone
    rank[_by_names(reduced)] = np.arange(len(marks))
    return _arranged((symbol, columns), run, count, rank[follow])[0]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` (uint8; the last byte is 0 and no other is) in order."""
    small = _types(text)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(marks) <= 1:
        return _induce(text, marks)
    # The leftmost-smaller substrings, sorted by one induction from their first bytes.
    sorted_ = _induce(text, marks)
    leftmost = np.zeros(len(text), bool)
    leftmost[marks] = True
    sorted_ = sorted_[leftmost[sorted_]]
    place = np.zeros(len(text), np.int32)
    place[marks] = np.arange(len(marks))
    length = np.r_[np.diff(marks), 0] + 1
    own = length[place[sorted_]]
    new = np.ones(len(sorted_), bool)
    alike = np.flatnonzero(own[1:] == own[:-1]) + 1
    new[alike] = ~_same(text, sorted_[alike - 1], sorted_[alike], own[alike])
    names = np.zeros(len(marks), np.int64)
    names[place[sorted_]] = np.cumsum(new) - 1
    return _induce(text, marks[_by_names(names)])


def _compare(eight: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the text shares from ``a`` and from ``b``, one by one; ``eight`` has eight bytes from each position."""
    found, slot, k = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(a):
        live = np.maximum(a, b) + k < len(eight)
        found[slot[~live]] = k
        a, b, slot = a[live], b[live], slot[live]
        differs = eight[a + k] != eight[b + k]
        stops = differs.any(axis=1)
        found[slot[stops]] = k + differs[stops].argmax(axis=1)
        a, b, slot, k = a[~stops], b[~stops], slot[~stops], k + 8
    return np.minimum(found, len(eight))


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the bytes it shares with its predecessor in ``order`` (a selection of suffixes in order).

    The values are permuted into text order: where a position and its predecessor both follow those of the
    position before, its value is one less; only the others are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    has = before >= 0
    follows = np.zeros(n, bool)
    follows[1:] = has[1:] & has[:-1] & (before[1:] == before[:-1] + 1)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
    value = np.zeros(n, np.int64)
    at = np.flatnonzero(has)
    head = np.flatnonzero(has & ~follows)
    value[head] = _compare(eight, head, before[head])
    while len(at):
        which = head[np.searchsorted(head, at, "right") - 1]
        steps = at - which
        good = steps <= value[which]
        value[at[good]] = value[which[good]] - steps[good]
        at, steps, which = at[~good], steps[~good], which[~good]
        fresh = at[steps == value[which] + 1]  # behind a byte that differs, nothing is known
        value[fresh] = _compare(eight, fresh, before[fresh])
        head = np.union1d(head, fresh)
        at = np.setdiff1d(at, fresh, assume_unique=True)
    return value
