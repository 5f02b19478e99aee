"""Re-Pair: a grammar that derives one sequence, made by replacing the most frequent pair."""

from __future__ import annotations

from heapq import heapify, heappop, heappush


def compress(sequence: list[int], first: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Rules and the sequence that is left.

    Symbols below ``first`` are words; rule ``k`` replaces the pair it holds by ``first + k``. The most
    frequent pair goes first, until no pair is counted twice. Pairs of old symbols only become
    rarer, so an entry of the heap is an upper bound and is corrected when it is popped.
    """
    n = len(sequence)
    symbol = [*sequence, -1]
    after, before = list(range(1, n + 2)), list(range(-1, n))
    count: dict[tuple[int, int], int] = {}
    places: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        pair = (symbol[i], symbol[i + 1])
        if pair in count:
            count[pair] += 1
            places[pair].append(i)
        else:
            count[pair] = 1
            places[pair] = [i]
    heap = [(-c, pair) for pair, c in count.items() if c > 1]
    heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        c, pair = heappop(heap)
        now = count[pair]
        if now != -c:
            if now > 1:
                heappush(heap, (-now, pair))
            continue
        left, right = pair
        new = first + len(rules)
        rules.append(pair)
        made: set[tuple[int, int]] = set()
        for i in places.pop(pair):
            if symbol[i] != left:
                continue
            j = after[i]
            if symbol[j] != right:
                continue
            p, k = before[i], after[j]
            if p >= 0:
                count[symbol[p], left] -= 1
                joined = (symbol[p], new)
                count[joined] = count.get(joined, 0) + 1
                places.setdefault(joined, []).append(p)
                made.add(joined)
            if symbol[k] >= 0:
                count[right, symbol[k]] -= 1
                joined = (new, symbol[k])
                count[joined] = count.get(joined, 0) + 1
                places.setdefault(joined, []).append(i)
                made.add(joined)
            symbol[i], symbol[j] = new, -2
            after[i] = k
            before[k] = i
        count[pair] = 0
        for joined in made:
            if count[joined] > 1:
                heappush(heap, (-count[joined], joined))
    rest, i = [], 0
    while i < n:
        rest.append(symbol[i])
        i = after[i]
    return rules, rest
