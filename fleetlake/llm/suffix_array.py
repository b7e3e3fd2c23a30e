"""Suffix arrays by linear grouping.

Suffixes are grouped by a prefix that, in the end, is their longest Lyndon
prefix. Groups are taken from the highest to the lowest: each suffix of a group
finds the nearest one before it in a lower group, and suffixes that are found
move up within their group's place, the more often found the higher. The groups
then stand in order; one pass from the lowest suffix on emits the order within
them, following the same pointers. Nothing is renamed or sorted again.
"""

from __future__ import annotations

import numpy as np


def _first_groups(symbols: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """Suffixes by first symbol: order, places, start of each one's group, size by start."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    n = len(symbols)
    new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    sizes = np.zeros(n + 1, np.int64)
    sizes[new] = np.diff(np.append(new, n))
    start_of_place = np.repeat(new, sizes[new])
    place, start = np.empty(n, np.int64), np.empty(n, np.int64)
    place[order] = np.arange(n)
    start[order] = start_of_place
    return order.tolist(), place.tolist(), start.tolist(), sizes.tolist()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a string of whole numbers; a shorter one comes first.

    An empty string has an empty order.
    """
    if not len(symbols):
        return np.zeros(0, np.int64)
    # an end that is lower than every symbol
    text = np.append(symbols.astype(np.int64) - int(symbols.min()) + 1, 0)
    n = len(text)
    order, place, start, size = _first_groups(text)
    before = [-1] * n  # nearest suffix on the left that is in a lower group
    jump = [-1] * n  # the same, with paths cut short

    end = n - 1
    while end >= 0:
        low = start[order[end]]
        members = sorted(order[low : end + 1]) if end > low else [order[low]]
        end = low - 1
        found: dict[int, int] = {}
        for i in members:
            p = i - 1
            passed = []
            while p >= 0 and start[p] >= low:
                passed.append(p)
                p = jump[p]
            for q in passed:
                jump[q] = p
            before[i] = jump[i] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        if not found:
            continue
        if len(found) == 1:
            by_times = [list(found)]
        else:
            times: dict[int, list[int]] = {}
            for p, k in found.items():
                times.setdefault(k, []).append(p)
            by_times = [times[k] for k in sorted(times, reverse=True)]
        for moved in by_times:
            taken: dict[int, list[int]] = {}
            for p in moved:
                g = start[p]
                if size[g] == 1 and g not in taken:  # alone in its group
                    continue
                size[g] -= 1
                last = g + size[g]
                at, other = place[p], order[last]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                taken.setdefault(g, []).append(p)
            for g, members_ in taken.items():
                new = g + size[g]
                if new != g:
                    size[new] = len(members_)
                    for p in members_:
                        start[p] = new
                else:  # all of the group moved
                    size[g] = len(members_)

    result = [-1] * n
    result[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    free = list(range(n + 1))  # by start of a group, its next free place
    for i in range(n):
        p = result[i] - 1
        while p >= 0 and not done[p]:
            g = start[p]
            result[free[g]] = p
            free[g] += 1
            done[p] = 1
            p = before[p]
    return np.array(result[1:], np.int64)
