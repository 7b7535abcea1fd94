"""Bin completion over a histogram of lengths: which fillings a packing uses, and how often each.

The input has at most ``capacity`` sizes, whatever the number of documents, so the search is small and its plan is
too: every step repeats a filling until one of its sizes runs short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

Filling = tuple[tuple[int, int], ...]  # (size, times) with sizes descending
Plan = list[tuple[Filling, int]]

# The limit of a search, not of the data: nodes visited and dominated fillings. The first searches take few branches at a node, so
# that they come back to the large items too, the last one all. The first has fillings by waste alone, without the greedy one early and
# the dominance test: where few items fit a bin, near-equal fillings matter.
NODES, SEARCHES = 4000, ((2, False), (3, True), (None, True))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: total length, or large items plus what cannot go beside them."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for small in {0, *(s for s in counts if 2 * s <= capacity), *(capacity - s for s in counts if 2 * s > capacity)}:
        if 2 * small > capacity:
            continue
        alone = sum(n for s, n in counts.items() if s > capacity - small)
        half = {s: n for s, n in counts.items() if capacity >= 2 * small and capacity // 2 < s <= capacity - small and 2 * s > capacity}
        room = sum(n * (capacity - s) for s, n in half.items())
        rest = sum(s * n for s, n in counts.items() if small <= s and 2 * s <= capacity)
        best = max(best, alone + sum(half.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, many equal items at once: the first incumbent."""
    open_bins: dict[int, dict[Filling, int]] = {}

    def put(room: int, filling: Filling, times: int) -> None:
        slot = open_bins.setdefault(room, {})
        slot[filling] = slot.get(filling, 0) + times

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_bins if r >= size):
            while left and open_bins.get(room):
                filling, times = open_bins[room].popitem()
                each = min(room // size, left)
                used = min(times, left // each)
                if used < times:
                    put(room, filling, times - used)
                put(room - each * size, (*filling, (size, each)), used)
                left -= used * each
            if not left:
                break
        if left:
            each = capacity // size
            if left // each:
                put(capacity - each * size, ((size, each),), left // each)
            if left % each:
                put(capacity - left % each * size, ((size, left % each),), 1)
    return [(filling, times) for bins in open_bins.values() for filling, times in bins.items() if times]


def _exact(target: int, sizes: list[int], at: int, counts: dict[int, int], reach: list[int]) -> Iterator[Filling]:
    """Fillings of the sizes from place ``at`` on that sum to ``target``, large items first, so that dominated ones come last.

    ``reach`` has the sums that the sizes from each place on can make, so every way taken ends in a filling.
    """
    if target == 0:
        yield ()
        return
    for i in range(at, len(sizes)):
        size = sizes[i]
        for times in range(min(counts[size], target // size), 0, -1):
            if reach[i + 1] >> (target - times * size) & 1:
                for rest in _exact(target - times * size, sizes, i + 1, counts, reach):
                    yield ((size, times), *rest)
        if not reach[i + 1] >> target & 1:
            return


def fillings(room: int, counts: dict[int, int], most_waste: int, early: bool = True) -> Iterator[tuple[int, Filling]]:
    """(waste, items) for a bin with ``room`` left: the first with least waste, with ``early`` the greedy one, then all others by waste."""
    sizes = sorted((s for s, n in counts.items() if n and s <= room), reverse=True)
    every = (1 << room + 1) - 1
    reach = [1]
    for s in reversed(sizes):
        # Multiples of a size, up to its count, as sums of powers of two and a rest.
        sums, left, step = reach[-1], min(counts[s], room // s), 1
        while left:
            step = min(step, left)
            sums |= sums << s * step
            left, step = left - step, 2 * step
        reach.append(sums & every)
    reach.reverse()
    left, greedy = room, []
    for s in sizes:
        if s <= left:
            greedy.append((s, min(counts[s], left // s)))
            left -= s * greedy[-1][1]
    first = early
    for waste in range(min(most_waste, room) + 1):
        if reach[0] >> (room - waste) & 1:
            for found in _exact(room - waste, sizes, 0, counts, reach):
                if first or not early or found != tuple(greedy):
                    yield waste, found
                if first and left <= most_waste and found != tuple(greedy):
                    yield left, tuple(greedy)
                first = False


def dominates(a: Filling, b: Filling) -> bool:
    """Whether first-fit finds a place in the items of ``a`` for all items of ``b``; then a packing with ``b`` is no better (Martello and Toth)."""
    rooms = [[s, n] for s, n in a]
    for size, n in b:
        i = 0
        while n:
            while i < len(rooms) and rooms[i][0] < size:
                i += 1
            if i == len(rooms):
                return False
            room, times = rooms[i]
            each = min(room // size, n)
            used = min(times, n // each)
            n -= used * each
            rooms[i : i + 1] = [r for r in ([room, times - used], [room - each * size, used]) if r[0] and r[1]]
            i = 0
    return True


def bins(plan: Plan) -> int:
    return sum(times for _, times in plan)


def _branches(left: dict[int, int], allowed: int, capacity: int, spent: list[int], known: int, dominance: bool) -> Iterator[tuple[int, Filling, int]]:
    """(waste, filling, times) around the largest item left, each as often as it goes and then once. With ``dominance``, dominated fillings are left out.

    The first ``known`` branches were made before and are not counted again.
    """
    largest = max(left)
    rest = dict(left)
    rest[largest] -= 1
    again: list[tuple[int, Filling]] = []
    for waste, items in fillings(capacity - largest, rest, allowed, dominance):
        if dominance and any(dominates(other, items) for _, other in again):
            spent[0] += len(again) >= known
            if spent[0] > NODES:
                return
            continue
        again.append((waste, items))
        yield waste, *_around(largest, items, left, allowed, waste)
    for waste, items in again:
        filling, times = _around(largest, items, left, allowed, waste)
        if times > 1:
            yield waste, filling, 1


def _around(largest: int, items: Filling, left: dict[int, int], allowed: int, waste: int) -> tuple[Filling, int]:
    need = dict(items)
    need[largest] = need.get(largest, 0) + 1
    times = min(left[s] // n for s, n in need.items())
    return tuple(sorted(need.items(), reverse=True)), min(times, max(1, allowed // waste)) if waste else times


def complete_bins(counts: dict[int, int], capacity: int) -> Plan:
    """Branch and bound around the largest item left. Stops at the lower bound or after the ``SEARCHES`` of ``NODES`` nodes each.

    A branch is cut when its waste exceeds what the incumbent minus one bin would allow.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    total = sum(s * n for s, n in counts.items())
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    for width, dominance in SEARCHES:
        spent = [0]
        # Depth first with an own stack, so deep plans need no recursion. A node's branches are made again when it is come back
        # to (their number taken is kept), so that the stack stays small.
        stack: list[tuple[dict[int, int], Plan, int, int]] = [(counts, [], 0, 0)]
        while stack and bins(best) > least and spent[0] <= NODES:
            left, plan, waste, taken = stack.pop()
            allowed = (bins(best) - 1) * capacity - total - waste
            if allowed < 0 or width and taken >= width:
                continue
            if not left:
                best = plan
                continue
            spent[0] += not taken
            step = next(islice(_branches(left, allowed, capacity, spent, taken, dominance), taken, None), None)
            if step is None:
                continue
            stack.append((left, plan, waste, taken + 1))
            extra, filling, times = step
            after = dict(left)
            for s, n in filling:
                after[s] -= times * n
            stack.append(({s: n for s, n in after.items() if n}, [*plan, (filling, times)], waste + extra * times, 0))
    return best
