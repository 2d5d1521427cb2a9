"""The configuration linear program of packing, over a histogram of lengths.

A configuration is a multiset of lengths that fit in one bin. The program asks for the
smallest sum of amounts x_c such that each length is covered as often as it occurs. Its dual
asks for prices of the lengths, as high as possible in sum over all pieces, such that no
configuration is worth more than 1.

Multiplicative weights solve both. Prices begin with each length's share of a bin. A round
prices configurations by the knapsack dynamic program: the prices over the best
configuration's worth are feasible for the dual, so their sum over all pieces is a lower
bound. Then the lengths, the longest first, are covered by configurations that are worth
nearly as much as the best; lengths for which there is none among what is left are covered
by what there is, and their weights are multiplied by how much the worth falls short. Rounds
end when the sum of amounts is within GAP of the best lower bound, or with MOST_ROUNDS.

Amounts are kept whole in every round, so rounding has only to deal with the bins that are not
full: their pieces, with those of some full bins of many pieces, are packed anew, best fit by
decreasing length, if that makes fewer bins. All of it works on at most `capacity` counts, so
it costs the same for any number of pieces.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

#: Rounds end when the covering is within this share of the lower bound, or rounds up to it.
GAP, MOST_ROUNDS = 0.001, 20
#: A configuration is good if its worth is within this share of the best one's.
NEARLY = 0.002
#: How fast weights grow with what worth falls short, in the first round; then with the root of the rounds' number.
RATE = 2.0
#: Full bins that rounding opens again for each one with room left: the best of these is taken.
OPENED = (0, 2, 8, 32)


@dataclass
class Plan:
    """Bins: each entry stands for `times` equal bins with the given (length, copies)."""

    times: list[int] = field(default_factory=list)
    contents: list[tuple[tuple[int, int], ...]] = field(default_factory=list)
    #: The program's value as far as it was solved, a proven lower bound of it, and how many rounds that took.
    lp_value: float = 0.0
    lower_bound: float = 0.0
    rounds: int = 0

    def bins(self) -> int:
        return sum(self.times)


def knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Best price of a configuration within each room 0..capacity; lengths ascend."""
    best = np.zeros(capacity + 1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := upto[room]:
            best[room] = max(best[room], (prices[:k] + best[room - lengths[:k]]).max())
    return best


def filled(best: np.ndarray, prices: np.ndarray, lengths: np.ndarray, room: int, lack: np.ndarray) -> list[int]:
    """Places of lengths that fill room at a price near the best one, none taken more often than it lacks.

    Of several that keep to the best price the longest is taken: short ones fit later, too.
    """
    found: list[int] = []
    left = lack.copy()
    while k := int(np.searchsorted(lengths, room, side="right")):
        value = np.where(left[:k] > 0, prices[:k] + best[room - lengths[:k]], -1.0)
        top = value.max()
        if top < 0:
            break
        j = k - 1 - int((value[::-1] >= top - 1e-9).argmax())
        found.append(j)
        left[j] -= 1
        room -= int(lengths[j])
    return found


def cover(prices: np.ndarray, best: np.ndarray, lengths: np.ndarray, need: np.ndarray, capacity: int) -> tuple[dict[tuple[int, ...], int], np.ndarray]:
    """Amounts of configurations (places of lengths) that cover need exactly, and by length what its configurations' worth falls short.

    First only good configurations; for the lengths then left the program is priced again,
    until none is good among them.
    """
    lack, amounts, worth = need.copy(), {}, best[capacity]
    missed = np.zeros(len(lengths))
    table, strict = best, True
    while lack.any():
        took = False
        for i in range(len(lengths) - 1, -1, -1):
            while lack[i] > 0:
                lack[i] -= 1
                places = [i, *filled(table, prices, lengths, capacity - int(lengths[i]), lack)]
                lack[i] += 1
                value = prices[places].sum()
                if strict and value < (1 - NEARLY) * table[capacity]:
                    break
                took = True
                at, times = np.unique(places, return_counts=True)
                step = int((lack[at] // times).min())
                lack[at] -= times * step
                config = tuple(sorted(places, reverse=True))
                amounts[config] = amounts.get(config, 0) + step
                missed[at] += times * step * max(0.0, 1 - value / worth)
        if not took:
            strict = False
        elif lack.any():
            own = np.flatnonzero(lack)
            table = knapsack(prices[own], lengths[own], capacity)
    return amounts, missed / need


def solve(counts: dict[int, int], capacity: int, gap: float = GAP, most_rounds: int = MOST_ROUNDS) -> tuple[dict[tuple[int, ...], int], float, int]:
    """Configurations (lengths, descending) with amounts that cover the counts, a proven lower bound, and rounds made."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    need = np.array([counts[int(x)] for x in lengths], dtype=np.int64)
    weight, bound, least, chosen, t = np.ones(len(lengths)), 0.0, math.inf, {}, 0
    for t in range(1, most_rounds + 1):
        prices = weight * lengths
        prices /= prices.max()
        best = knapsack(prices, lengths, capacity)
        bound = max(bound, float((need * prices).sum()) / best[capacity])
        amounts, missed = cover(prices, best, lengths, need, capacity)
        value = sum(amounts.values())
        if value < least:
            least, chosen = value, amounts
        if least <= max(math.ceil(bound - 1e-6), (1 + gap) * bound):
            break
        weight *= np.exp(RATE / math.sqrt(t) * missed)
    return {tuple(int(lengths[i]) for i in c): n for c, n in chosen.items()}, bound, t


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing: each piece goes to the bin with the least room that holds it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    bins: list[list[int]] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            above = rooms >> length
            if above:
                r = length + (above & -above).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    rooms &= ~(1 << r)
            else:
                b, r = len(bins), capacity
                bins.append([])
            bins[b].append(length)
            by_room[r - length].append(b)
            rooms |= 1 << (r - length)
    return [tuple(b) for b in bins]


def counted(config: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
    values, times = np.unique(config, return_counts=True)
    return tuple((int(v), int(n)) for v, n in zip(values[::-1], times[::-1], strict=True))


def repacked(amounts: dict[tuple[int, ...], int], capacity: int, opened: int) -> dict[tuple[int, ...], int]:
    """amounts, with the pieces of bins that aren't full, and of so many full ones for each, packed anew."""
    kept = {c: n for c, n in amounts.items() if sum(c) == capacity}
    loose = {c: n for c, n in amounts.items() if sum(c) < capacity}
    to_open = opened * sum(loose.values())
    for c in sorted(kept, key=lambda c: (-len(c), c)):
        if to_open <= 0:
            break
        n = min(to_open, kept[c])
        to_open -= n
        kept[c] -= n
        loose[c] = n
    counts: dict[int, int] = {}
    for c, n in loose.items():
        for v in c:
            counts[v] = counts.get(v, 0) + n
    for c in best_fit(counts, capacity):
        kept[c] = kept.get(c, 0) + 1
    return kept


def pack(counts: dict[int, int], capacity: int) -> Plan:
    """A plan that places every piece of the histogram exactly once."""
    plan = Plan()
    left = {k: n for k, n in counts.items() if n > 0}
    if not left:
        return plan
    amounts, plan.lower_bound, plan.rounds = solve(left, capacity)
    plan.lp_value = float(sum(amounts.values()))
    whole = min((amounts, *(repacked(amounts, capacity, n) for n in OPENED)), key=lambda a: sum(a.values()))
    plan.lp_value = min(plan.lp_value, float(sum(whole.values())))
    for config, n in whole.items():
        if n:
            plan.times.append(n)
            plan.contents.append(counted(config))
    return plan
