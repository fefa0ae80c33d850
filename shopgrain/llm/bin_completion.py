"""Bin completion over counts of lengths: as few bins as a bounded search finds.

Items of one length are alike, so the input is the count of each length, at most one
entry per unit of capacity however many items there are. The search takes the largest
remaining length and enumerates, as they are asked for and least waste first, the
fillings of the rest of its bin that no other one dominates: none in which a remaining
item could take the place of some of the items. It branches over all of them, gives up
where the waste so far cannot beat the incumbent, and starts from best-fit decreasing as
the first incumbent. The number of steps is its only bound; without it the result has
the fewest bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: (times, lengths): bins that hold these lengths in this order.
Pattern = tuple[int, tuple[int, ...]]

#: Steps of the search. The search is cut, never the items.
NODES = 600_000


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: large items stand apart, the others need the room left."""
    lengths = np.arange(len(counts), dtype=np.int64)
    sizes = counts.astype(object) * lengths
    best = -(-int(sizes.sum()) // capacity)
    half = capacity // 2
    n_from = np.append(np.cumsum(counts[::-1].astype(object))[::-1], 0)
    s_from = np.append(np.cumsum(sizes[::-1])[::-1], 0)
    for k in range(half + 1):
        alone = int(n_from[capacity - k + 1]) if k else 0
        top = min(capacity - k, capacity) + 1
        middle = int(n_from[half + 1] - n_from[top])
        middle_size = int(s_from[half + 1] - s_from[top])
        small = int(s_from[max(k, 1)] - s_from[half + 1])
        best = max(best, alone + middle + max(0, -(-(small - (middle * capacity - middle_size)) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing, for all items of a length at once."""
    open_bins: dict[int, list[list]] = {}  # room -> [times, lengths]
    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        for room in sorted(r for r in open_bins if r >= length):
            if not left:
                break
            stay = []
            for times, lengths in open_bins.pop(room):
                each = room // length
                full = min(times, left // each)
                left -= full * each
                parts = [(full, each), (1, left)] if full < times and left else [(full, each)]
                if full < times and left:
                    left, times = 0, times - 1
                for n, more in parts:
                    if n and more:
                        open_bins.setdefault(room - more * length, []).append([n, lengths + (length,) * more])
                if times - full:
                    stay.append([times - full, lengths])
            if stay:
                open_bins.setdefault(room, []).extend(stay)
        if left:
            each = capacity // length
            if left // each:
                open_bins.setdefault(capacity - each * length, []).append([left // each, (length,) * each])
            if left % each:
                open_bins.setdefault(capacity - left % each * length, []).append([1, (length,) * (left % each)])
    return [(n, lengths) for group in open_bins.values() for n, lengths in group]


def _reachable(counts: list[int], room: int) -> list[int]:
    """For each length x, as bits, the sums up to `room` that lengths up to x can have."""
    every = (1 << (room + 1)) - 1
    sums, out = 1, [1]
    for length in range(1, room + 1):
        left, part = min(counts[length] if length < len(counts) else 0, room // length), 1
        while left > 0:
            take = min(part, left)
            sums |= (sums << (take * length)) & every
            left, part = left - take, 2 * part
        out.append(sums)
    return out


def _dominated(filling: list[int], slack: int, counts: list[int], there: int) -> bool:
    """Whether one remaining item can take the place of a subset of the filling.

    It must be at least as long as the subset, and longer or for two items or more, and
    fit into the subset's room and the slack; the empty subset is the slack alone.
    `there` has a bit for each remaining length.
    """
    for length in set(filling):
        if filling.count(length) == counts[length]:
            there &= ~(1 << length)
    one = two = 0  # sums of subsets of one item or more, of two or more
    for length in filling:
        two |= one << length
        one |= one << length | 1 << length
    two |= one & two
    if there & two:
        return True
    return any(there & ((one | 1) << more) for more in range(1, slack + 1))


def fillings(counts: list[int], room: int, reach: list[int], most: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Undominated multisets of remaining lengths within `room`, least waste first, as asked for.

    One item that fills the room dominates every other filling. Nothing is left out up to
    a waste of `most`; each step takes one from the budget, and none is made without it.
    """
    if room < len(counts) and counts[room]:
        yield (room,)
        return
    there = 0
    for length in range(1, min(room, len(counts) - 1) + 1):
        there |= (counts[length] > 0) << length
    for slack in range(min(most, room) + 1):
        chosen: list[int] = []
        rest, length = room - slack, room - slack
        if not reach[room] >> rest & 1:
            continue
        while budget[0] > 0:
            if not rest and (not _dominated(chosen, slack, counts, there)):
                yield tuple(chosen)
            # The longest item that can go on, or back to one that can be shorter.
            below = there & ((1 << (min(length, rest) + 1)) - 1)
            found = 0
            while below and not found:
                budget[0] -= 1
                length = below.bit_length() - 1
                if not reach[length] >> rest & 1:  # nor can shorter ones
                    break
                if counts[length] > chosen.count(length) and reach[length] >> (rest - length) & 1:
                    found = length
                below &= ~(1 << length)
            if found:
                chosen.append(found)
                rest, length = rest - found, found
            elif chosen:
                last = chosen.pop()
                rest, length = rest + last, last - 1
            else:
                break


def pack(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold every item once; counts[length], lengths from 1 to capacity.

    A filling is first used as often as the counts allow; going back takes one use away
    and tries the fillings behind it, so with enough nodes every packing is considered.
    """
    counts = np.asarray(counts, dtype=np.int64)
    total = int((counts.astype(object) * np.arange(len(counts))).sum())
    if not total:
        return []
    goal = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    n_best = sum(n for n, _ in best)
    left = [int(c) for c in counts]
    budget = [nodes]
    reach = _reachable(left, capacity) if n_best > goal else []
    path: list[Pattern] = []
    waste, top, after = 0, len(left) - 1, None  # after: the filling behind which to go on
    while n_best > goal and budget[0] > 0:
        budget[0] -= 1
        while top and not left[top]:
            top -= 1
        lengths = None
        spare = (n_best - 1) * capacity - total - waste  # waste that still allows a better packing
        if not top and spare >= 0:
            best, n_best = list(path), sum(n for n, _ in path)
        elif spare >= 0:
            left[top] -= 1
            for filling in fillings(left, capacity - top, reach, spare, budget):
                if after is None:
                    lengths = (top, *filling)
                    break
                if filling == after:
                    after = None
            left[top] += 1
        after = None
        if lengths is None:  # nothing better this way: one use less of the last filling
            if not path:
                break
            times, lengths = path.pop()
            for length in lengths:
                left[length] += 1
            waste -= capacity - sum(lengths)
            if times > 1:
                path.append((times - 1, lengths))
            top, after = lengths[0], lengths[1:]
            continue
        lost = capacity - sum(lengths)
        times = min(left[length] // lengths.count(length) for length in set(lengths))
        if lost:
            times = max(1, min(times, spare // lost))
        for length in lengths:
            left[length] -= times
        waste += times * lost
        path.append((times, lengths))
    return best
