"""Suffix arrays by linear grouping.

Suffixes start in groups of equal first symbols. Groups are taken in descending order. When a group is taken, all greater
ones are done, so the previous smaller suffix of a member is the nearest place to its left that is neither done nor in
the group (found over pointers that skip done places). These previous places get longer Lyndon prefixes: they leave
their groups for new ones just above, the more members point to them the higher. In the end a group holds the suffixes
that share their longest Lyndon prefix, and the order in which groups were taken is their order.

Then suffixes are emitted from the smallest: behind the suffix at r, the place before r and, over the pointers, its
previous smaller places are next in their own groups. No renaming, no recursion.

``suffix_array`` does this for one text; ``suffix_arrays`` for many short ones in step, one group of each at a time.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: list[int]) -> list[int]:
    """The order of all suffixes of ``text``, whose last symbol must be its smallest and occur once."""
    n = len(text)
    symbols = sorted(set(text))
    group_of_symbol = {s: g for g, s in enumerate(symbols)}
    group = [group_of_symbol[s] for s in text]
    members: list[set[int]] = [set() for _ in symbols]
    for i, g in enumerate(group):
        members[g].add(i)
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    before, done = list(range(-1, n - 1)), [False] * n
    front = [0] * n                                   # by place: the first free place of its group in the result
    fronts: list[int] = []
    left, g = n, len(symbols) - 1
    taken = [0] * n
    while g >= 0:
        own = members[g]
        if own:
            left -= len(own)
            fronts.append(left)
            for i in own:
                done[i], taken[i] = True, len(fronts) - 1
            pointed: dict[int, int] = {}
            for i in own:
                j = before[i]
                while j >= 0 and done[j]:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    pointed[j] = pointed.get(j, 0) + 1
            fresh: dict[tuple[int, int], int] = {}
            for j, count in sorted(pointed.items(), key=lambda x: -x[1]):
                old = group[j]
                if (old, count) not in fresh:
                    new, high = len(members), above[old]
                    members.append(set())
                    below.append(old)
                    above.append(high)
                    if high >= 0:
                        below[high] = new
                    above[old] = new
                    fresh[old, count] = new
                new = fresh[old, count]
                members[old].discard(j)
                members[new].add(j)
                group[j] = new
        g = below[g]
    front, out, placed = fronts, [-1] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    front[taken[n - 1]] += 1
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            out[front[taken[j]]] = j
            front[taken[j]] += 1
            placed[j] = True
            j = before[j]
    return out


def suffix_arrays(texts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The suffix arrays of the rows of ``texts`` (symbols below 512, -1 behind ``lengths``), each as ``suffix_array``."""
    rows, width = texts.shape
    span = 512 + width + 1
    group = np.where(np.arange(width) < lengths[:, None], texts, -1).astype(np.int16)
    below = np.tile(np.arange(-1, span - 1, dtype=np.int32), (rows, 1)).ravel()
    above = np.tile(np.arange(1, span + 1, dtype=np.int32), (rows, 1)).ravel()
    fresh = np.full(rows, 512, dtype=np.int64)
    above[np.arange(rows) * span + 511] = -1
    flat = group.ravel()
    # Only symbols that occur are linked.
    used = np.zeros((rows, 512), dtype=bool)
    r, c = np.nonzero(group >= 0)
    used[r, group[r, c]] = True
    for_row, symbol = np.nonzero(used)
    same = np.concatenate([for_row[1:] == for_row[:-1], [False]])
    at = for_row * span + symbol
    above[at] = np.where(same, np.append(symbol[1:], -1), -1)
    first = np.concatenate([[True], ~same[:-1]])
    below[at] = np.where(first, -1, np.append(-1, symbol[:-1]))
    current = np.full(rows, -1, dtype=np.int64)
    current[for_row[~same]] = symbol[~same]
    before = np.tile(np.arange(-1, width - 1, dtype=np.int64), (rows, 1)).ravel()
    done = np.zeros(rows * width, dtype=bool)
    start = np.zeros(rows * width, dtype=np.int64)     # of the place's group in the result
    left = lengths.astype(np.int64).copy()
    live = np.flatnonzero(current >= 0)
    while len(live):
        which, place = np.nonzero(group[live] == current[live, None].astype(np.int16))
        row = live[which]
        own = row * width + place
        count = np.bincount(which, minlength=len(live))
        left[live] -= count
        start[own] = left[row]
        done[own] = True
        j = before[own]
        move = np.flatnonzero(j >= 0)
        base = row * width
        while len(move):
            move = move[done[base[move] + j[move]]]
            j[move] = before[base[move] + j[move]]
            move = move[j[move] >= 0]
        before[own] = j
        has = j >= 0
        if has.any():
            target, times = np.unique(base[has] + j[has], return_counts=True)
            trow = target // width
            old = flat[target].astype(np.int64)
            key = (trow * span + old) * (width + 1) + (width - times)       # by row, old group, most pointers first
            kinds, kind = np.unique(key, return_inverse=True)
            node = kinds // (width + 1)                                     # row * span + old group
            krow, kold = node // span, node % span
            head = np.concatenate([[True], node[1:] != node[:-1]])
            rank = np.arange(len(kinds)) - np.maximum.accumulate(np.where(head, np.arange(len(kinds)), 0))
            row_head = np.concatenate([[True], krow[1:] != krow[:-1]])
            in_row = np.arange(len(kinds)) - np.maximum.accumulate(np.where(row_head, np.arange(len(kinds)), 0))
            new = fresh[krow] + in_row
            np.maximum.at(fresh, krow, new + 1)
            for k in range(int(rank.max()) + 1):
                some = rank == k
                n_at, o_at, high = krow[some] * span + new[some], node[some], above[node[some]]
                above[n_at], below[n_at] = high, kold[some]
                ok = high >= 0
                below[krow[some][ok] * span + high[ok]] = new[some][ok]
                above[o_at] = new[some]
            flat[target] = new[kind].astype(np.int16)
        current[live] = below[live * span + current[live]]
        live = live[current[live] >= 0]
    return _emit(before, start, lengths, rows, width)


def _emit(before: np.ndarray, start: np.ndarray, lengths: np.ndarray, rows: int, width: int) -> np.ndarray:
    out = np.full(rows * width, -1, dtype=np.int64)
    placed = np.zeros(rows * width, dtype=bool)
    front = np.tile(np.arange(width), (rows, 1)).ravel()   # next free place of the group that starts here
    base = np.arange(rows) * width
    last = base + lengths - 1
    out[base], placed[last] = lengths - 1, True
    front[base] += 1
    at, j = np.zeros(rows, dtype=np.int64), lengths.astype(np.int64) - 2
    live = np.arange(rows)
    while len(live):
        b, i = base[live], j[live]
        put = i >= 0
        put[put] = ~placed[b[put] + i[put]]
        own = live[put]
        spot = base[own] + j[own]
        group = base[own] + start[spot]
        out[base[own] + front[group]] = j[own]
        front[group] += 1
        placed[spot] = True
        j[own] = before[spot]
        rest = live[~put]
        at[rest] += 1
        rest = rest[at[rest] < lengths[rest]]
        j[rest] = out[base[rest] + at[rest]] - 1
        live = live[at[live] < lengths[live]]
    return out.reshape(rows, width)
