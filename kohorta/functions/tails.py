"""Tail probabilities for statistics that were already aggregated by Spark.

Each takes a few numbers, never a data set.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_square(x: float, df: int) -> float:
    """P(X >= x) for a chi-square variable."""
    if x <= 0:
        return 1.0
    return _upper_gamma(df / 2.0, x / 2.0)


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - scale * total)
    # Continued fraction, evaluated from the front.
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return min(1.0, scale * h)


def fisher_2x2(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact p-value of a 2 x 2 table (sum of tables no more likely)."""
    row, other, col = a + b, c + d, a + c
    low, high = max(0, col - other), min(row, col)

    # Likelihoods relative to the start, step by step: logarithms of factorials are too coarse for large tables.
    logs = [0.0]
    for x in range(low, high):
        logs.append(logs[-1] + math.log((row - x) * (col - x) / ((x + 1) * (other - col + x + 1))))
    top, seen = max(logs), logs[a - low]
    weights = [math.exp(v - top) for v in logs]
    return min(1.0, math.fsum(w for w, v in zip(weights, logs) if v <= seen + 1e-7) / math.fsum(weights))


def rare_tables(table: list[list[int]]) -> int:
    """At most so many tables have these margins: ways to deal all rows but the largest to the columns."""
    columns = len(table[0])
    return math.prod(math.comb(n + columns - 1, columns - 1) for n in sorted(map(sum, table))[:-1])


def fisher_rare(table: list[list[int]]) -> float:
    """``fisher_exact`` for tables with one large row, in the count of the other rows alone."""
    table = sorted((r for r in table if sum(r)), key=sum)
    columns = [c for c in zip(*table) if sum(c)]
    if len(table) < 2 or len(columns) < 2:
        return 1.0
    rare = tuple(sum(r) for r in table[:-1])
    logs = [0.0]
    for i in range(1, sum(rare) + 1):
        logs.append(logs[-1] + math.log(i))

    def falling(n: int) -> list[float]:
        """log(n! / (n - k)!) for k up to the rare rows."""
        out = [0.0]
        for k in range(min(n, sum(rare))):
            out.append(out[-1] + math.log(n - k))
        return out

    fixed = sum(logs[n] for n in rare) - falling(sum(map(sum, table)))[-1]
    falls = [falling(sum(c)) for c in columns]
    observed = sum(f[sum(c[:-1])] - sum(logs[v] for v in c[:-1]) for c, f in zip(columns, falls))
    states: dict[tuple[int, ...], dict[float, int]] = {rare: {0.0: 1}}
    for i, fall in enumerate(falls):
        following: dict[tuple[int, ...], dict[float, int]] = {}
        for left, weights in states.items():
            last = i == len(falls) - 1
            for cells in [left] if last else product(*(range(n + 1) for n in left)):
                if sum(cells) >= len(fall):
                    continue
                gain = fall[sum(cells)] - sum(logs[v] for v in cells)
                target = following.setdefault(tuple(x - y for x, y in zip(left, cells)), {})
                for w, times in weights.items():
                    key = round(w + gain, 9)
                    target[key] = target.get(key, 0) + times
        states = following
    found = states.get((0,) * len(rare), {})
    return min(1.0, math.fsum(n * math.exp(fixed + w) for w, n in found.items() if w <= observed + 1e-7))


def fisher_network(table: list[list[int]], most: int) -> float | None:
    """``fisher_exact`` over layers of partial margins; None beyond ``most`` entries.

    Columns are filled one by one. Row totals still open, in sorted order, are a
    node: paths that lead to the same node with the same probability so far are one
    entry. An entry ends where bounds on what is left decide it: if even the
    likeliest rest is no likelier than the observed table, all rests count, and
    their sum is known in closed form; if even the least likely rest is likelier,
    none counts.
    """
    table = [r for r in table if sum(r)]
    columns = [c for c in zip(*table) if sum(c)]
    if len(table) < 2 or len(columns) < 2:
        return 1.0
    if len(columns) < len(table):
        table, columns = [list(c) for c in columns], [tuple(r) for r in zip(*columns)]
    log = lambda n: math.lgamma(n + 1.0)
    totals = sorted((sum(c) for c in columns), reverse=True)
    rows = tuple(sorted(map(sum, table)))
    n = sum(rows)
    fixed = math.fsum(map(log, rows)) + math.fsum(map(log, totals)) - log(n)
    # The cost of a table is the sum of log(cell!); it counts from the observed cost on.
    observed = math.fsum(log(v) for r in table for v in r) - 1e-7
    rest = [math.fsum(map(log, totals[i:])) for i in range(len(totals) + 1)]
    left = [sum(totals[i:]) for i in range(len(totals) + 1)]
    sizes = [totals[i:] for i in range(len(totals) + 1)]

    def weight(at: int, open_rows: tuple[int, ...]) -> float:
        """log of the sum over all rests of the product of 1 / cell!."""
        return log(left[at]) - math.fsum(map(log, open_rows)) - rest[at]

    def least(at: int, open_rows: tuple[int, ...]) -> float:
        """Each column dealt as evenly as the open rows allow, or each row over the columns."""
        by_column = math.fsum(_even_cost(c, open_rows) for c in sizes[at])
        return max(by_column, math.fsum(_even_cost(r, sizes[at][::-1]) for r in open_rows))

    def largest(at: int, open_rows: tuple[int, ...]) -> float:
        return min(math.fsum(map(log, open_rows)), rest[at])

    nodes: dict[tuple[int, ...], dict[float, int]] = {rows: {0.0: 1}}
    total, entries = 0.0, 0
    for at, size in enumerate(totals):
        following: dict[tuple[int, ...], dict[float, int]] = {}
        for open_rows, costs in nodes.items():
            low, high, whole = least(at, open_rows), largest(at, open_rows), weight(at, open_rows)
            undecided = {}
            for cost, times in costs.items():
                if cost + low >= observed:
                    total += times * math.exp(fixed - cost + whole)
                elif cost + high >= observed:
                    undecided[cost] = times
            if not undecided:
                continue
            for cells in _fillings(size, open_rows):
                entries += len(undecided)
                if entries > most:
                    return None
                gain = math.fsum(map(log, cells))
                target = following.setdefault(tuple(sorted(a - b for a, b in zip(open_rows, cells))), {})
                for cost, times in undecided.items():
                    key = round(cost + gain, 9)
                    target[key] = target.get(key, 0) + times
        nodes = following
    total += math.fsum(
        times * math.exp(fixed - cost) for costs in nodes.values() for cost, times in costs.items() if cost >= observed
    )
    return min(1.0, total)


def _even_cost(total: int, most: Sequence[int]) -> float:
    """Least sum of log(x!) of whole numbers with this total, none above its entry of the rising ``most``."""
    cost = 0.0
    for i, cap in enumerate(most):
        share, more = divmod(total, len(most) - i)
        if cap > share:
            return cost + more * math.lgamma(share + 2.0) + (len(most) - i - more) * math.lgamma(share + 1.0)
        cost += math.lgamma(cap + 1.0)
        total -= cap
    return cost


def rank_sum_exact(w: float, a: int, b: int) -> float:
    """Two-sided p-value of the rank-sum statistic w (less its minimum) without ties.

    The ways to reach each statistic are counted by taking the a ranks one by one.
    """
    ways = [1] + [0] * (a * b)
    # Product of (1 - q^(b + i)) / (1 - q^i): the generating function of the statistic.
    for i in range(1, a + 1):
        for s in range(a * b, b + i - 1, -1):
            ways[s] -= ways[s - b - i]
        for s in range(i, a * b + 1):
            ways[s] += ways[s - i]
    w = round(w)
    tail = sum(ways[: w + 1]) if 2 * w <= a * b else sum(ways[w:])
    return min(1.0, 2 * tail / math.comb(a + b, a))


def fisher_exact(table: list[list[int]]) -> float:
    """Two-sided exact test of an r x c table.

    Columns are filled one by one. What is kept is the row totals still open
    and, for each value of the probability so far, the sum over the tables that
    lead there; tables no likelier than the observed one are added up.
    """
    table = sorted((r for r in table if sum(r)), key=sum)
    columns = [c for c in zip(*table) if sum(c)]
    if len(table) < 2 or len(columns) < 2:
        return 1.0
    logs = [0.0]
    for i in range(1, sum(map(sum, table)) + 1):
        logs.append(logs[-1] + math.log(i))
    # P = prod(row!) prod(column!) / (n! prod(cell!)); only the cells differ.
    fixed = sum(logs[sum(r)] for r in table) + sum(logs[sum(c)] for c in columns) - logs[sum(map(sum, table))]
    observed = fixed - sum(logs[v] for r in table for v in r)
    states: dict[tuple[int, ...], dict[float, float]] = {tuple(map(sum, table)): {0.0: 1.0}}
    for column in columns[:-1]:
        following: dict[tuple[int, ...], dict[float, float]] = {}
        for left, weights in states.items():
            for cells in _fillings(sum(column), left):
                cost = sum(logs[v] for v in cells)
                target = following.setdefault(tuple(a - b for a, b in zip(left, cells)), {})
                for w, times in weights.items():
                    key = round(w + cost, 9)
                    target[key] = target.get(key, 0.0) + times
        states = following
    total = 0.0
    for left, weights in states.items():
        cost = sum(logs[v] for v in left)
        for w, times in weights.items():
            if fixed - w - cost <= observed + 1e-7:
                total += times * math.exp(fixed - w - cost)
    return min(1.0, total)


def _fillings(n: int, most: tuple[int, ...]):
    """All ways to deal n to places that hold at most ``most``."""
    if len(most) == 1:
        if n <= most[0]:
            yield (n,)
        return
    rest = sum(most[1:])
    for v in range(max(0, n - rest), min(n, most[0]) + 1):
        for tail in _fillings(n - v, most[1:]):
            yield (v, *tail)
