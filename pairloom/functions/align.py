"""Which lines of two versions of a text belong together."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Generator, Iterator, Sequence

import numpy as np

#: None: gaps of every size are matched. A number would leave gaps without anchors and with unequal sides unmatched
#: where one side's lines times the other's are more; only a test sets one.
CELLS: int | None = None
#: Numbers of the table of sums, and of likenesses, that are held at a time; what is not held is computed again. Up to
#: SMALL numbers a plain table takes less time than arrays. Both change time and memory and no result.
HELD, SMALL = 1 << 22, 1 << 10
#: Share of common words that two different lines need to count as versions of each other.
ALIKE = 0.5

_WORD = re.compile(r"\w+")
Pair = tuple[int, int]


def matched_lines(a: Sequence[str], b: Sequence[str]) -> list[Pair]:
    """Pairs of line numbers, rising on both sides.

    Equal lines at both ends are matched first, then lines that are equal and unique on both sides (anchors),
    as many as keep their order. This is repeated between the anchors. A gap without anchors is matched line by
    line if its sides are equally long, else by dynamic programming, which makes the sum of likenesses largest,
    whatever the gap's size.
    """
    found: list[Pair] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        fixed = _anchors(a, b, a0, a1, b0, b1)
        if not fixed and a1 - a0 == b1 - b0:
            found += zip(range(a0, a1), range(b0, b1))
            continue
        if not fixed and (CELLS is None or (a1 - a0) * (b1 - b0) <= CELLS):
            found += ((a0 + i, b0 + j) for i, j in best_matching(a[a0:a1], b[b0:b1]))
            continue
        found += fixed
        edges = [(a0 - 1, b0 - 1), *fixed, (a1, b1)]
        if fixed:
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(found)


def _anchors(a: Sequence[str], b: Sequence[str], a0: int, a1: int, b0: int, b1: int) -> list[Pair]:
    """The longest rising run of lines that are unique on both sides of the gap."""
    n_a, n_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    where = {line: j for j, line in enumerate(b[b0:b1], b0) if n_b[line] == 1}
    shared = [(i, where[line]) for i, line in enumerate(a[a0:a1], a0) if n_a[line] == 1 and line in where]
    # patience: the least end of a run of every length, and the pair before each pair
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for at, (_, j) in enumerate(shared):
        size = bisect_left(ends, j)
        ends[size : size + 1] = [j]
        last[size : size + 1] = [at]
        before.append(last[size - 1] if size else -1)
    run, at = [], last[-1] if last else -1
    while at >= 0:
        run.append(shared[at])
        at = before[at]
    return run[::-1]


def words_of(line: str) -> Counter[str]:
    """The words of a line, without the punctuation and symbols that cleaning changes most."""
    return Counter(_WORD.findall(line))


def likeness(x: Counter[str], y: Counter[str]) -> float:
    """The share of words two lines have in common: 1 for the same words, 0 below ALIKE."""
    most = x.total() + y.total()
    share = 2 * sum(min(n, y[w]) for w, n in x.items() if w in y) / most if most else 0.0
    return share if share >= ALIKE else 0.0


def best_matching(a: Sequence[str], b: Sequence[str]) -> Iterator[Pair]:
    """Rising pairs with the largest sum of likenesses; of equal sums the one that matches the earliest lines.

    Both ways give the same pairs. Time grows with the product of the sides; beyond a small table, memory grows with
    their sum, as only some rows of the table are held.
    """
    if len(a) * len(b) <= SMALL:
        yield from _by_table(a, b)
        return
    for i, place in _by_rows(a, 0, len(a), np.zeros(len(b) + 1), _Versions(b)):
        yield i, len(b) - place


def _by_table(a: Sequence[str], b: Sequence[str]) -> Iterator[Pair]:
    words_a, words_b = [words_of(x) for x in a], [words_of(y) for y in b]
    like = [[1.0 if x == y else likeness(u, v) for y, v in zip(b, words_b)] for x, u in zip(a, words_a)]
    # best[i][j]: of the lines from i and j on
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], like[i][j] + below[j + 1])
    i = j = 0
    while i < len(a) and j < len(b):
        if like[i][j] and best[i][j] == like[i][j] + best[i + 1][j + 1]:
            yield i, j
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1


class _Versions:
    """Of a line: the lines of b that are versions of it, as rising places from b's end (its last line is 1), and
    their likenesses."""

    def __init__(self, b: Sequence[str]):
        self.kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.room = HELD
        total, where = [0], defaultdict(list)
        for place, line in enumerate(reversed(b), 1):
            found = _numbered(line)
            total.append(len(found))
            for word in found or [line]:
                where[word].append(place)
        self.total = np.array(total)
        self.where = {word: np.array(places) for word, places in where.items()}

    def __call__(self, line: str) -> tuple[np.ndarray, np.ndarray]:
        if line in self.kept:
            return self.kept[line]
        found = _numbered(line)
        at = np.concatenate([_NOWHERE, *(self.where[word] for word in found or [line] if word in self.where)])
        like = np.ones(len(at))  # a line without words has equal lines as its only versions
        if found:
            common = np.bincount(at)
            like = 2 * common / (len(found) + self.total[: len(common)])
            at = (like >= ALIKE).nonzero()[0]
            like = like[at]
        if len(at) < self.room:
            self.room -= len(at) + 1
            self.kept[line] = at, like
        return at, like


_NOWHERE = np.zeros(0, np.int64)


def _numbered(line: str) -> list[str | tuple[str, int]]:
    """The words of a line, repeats with their number: two lines share as many of these as they share words."""
    found = _WORD.findall(line)
    if len(set(found)) == len(found):
        return found
    return [(word, n) if n else word for word, times in words_of(line).items() for n in range(times)]


def _add_line(row: np.ndarray, at: np.ndarray, like: np.ndarray) -> None:
    """Make the sums of the lines below a line (by the last place in b that is open) those from the line on."""
    n = at.searchsorted(len(row))
    at, like = at[:n], like[:n]
    sums = like + row[at - 1]
    more = sums > row[at]
    if more.any():
        at, sums = at[more], sums[more]
        # sums rise with the place: those from the first change on that are below the largest new one may have to follow
        part = row[at[0] : row.searchsorted(sums.max())]
        row[at] = sums
        np.maximum.accumulate(part, out=part)


def _by_rows(
    a: Sequence[str], first: int, last: int, below: np.ndarray, versions: _Versions
) -> Generator[Pair, None, int]:
    """The pairs of the lines from ``first`` to ``last``; returns the last place that is left open.

    ``below`` has the sums of the lines from ``last`` on, up to the last place open. Where all rows are too many to
    hold, every so many are, and those between two held ones are computed again when the pairs get there.
    """
    place = len(below) - 1
    step = -(-(last - first) // max(2, HELD // len(below)))
    held, row = {last: below}, below.copy()
    for i in range(last - 1, first - 1, -1):
        _add_line(row, *versions(a[i]))
        if (i - first) % step == 0:
            held[i] = row.copy()
    for i in range(first, last, step):
        if not place:
            break
        if step > 1:
            end = min(i + step, last)
            place = yield from _by_rows(a, i, end, held.pop(end)[: place + 1], versions)
            continue
        at, like = versions(a[i])
        n = at.searchsorted(place, "right")
        best, under = held[i][place], held[i + 1]
        hits = at[:n][like[:n] + under[at[:n] - 1] == best]
        # the line is passed over where that costs nothing and it does not match the first line open
        if best == under[place] and not (len(hits) and hits[-1] == place):
            continue
        yield i, int(hits[-1])
        place = int(hits[-1]) - 1
    return place
