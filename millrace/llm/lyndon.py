"""Lyndon arrays by Baier's grouping, and runs from Lyndon roots.

The first phase of Baier's suffix sorter divides suffixes into groups, highest first, by their longest
Lyndon prefix: every suffix of the highest group not yet seen lengthens the prefix of the nearest suffix
before it that lies in a lower group, which moves to a new group right above its own. Suffixes that are met
several times move further. When all groups are seen, the length of a suffix's prefix is its entry of the
Lyndon array; the sorter's second phase isn't needed. The same with the order of words turned round gives the
second array. Each run has a Lyndon root under one of the two orders, which longest common extensions to both
sides complete.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.text import mix

_BASE = np.uint64(0xD1342543DE82EF95)


def lyndon_array(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place."""
    n = len(letters)
    # groups are numbered as they arise and linked from lowest to highest; number 0 ends the list below
    members: list[list[int]] = [[]]
    for letter in sorted(set(letters)):
        members.append([])
    number = {letter: i + 1 for i, letter in enumerate(sorted(set(letters)))}
    group = [number[letter] for letter in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    length = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    upper = list(range(1, len(members) + 1))
    upper[-1] = 0
    seen, before, found = [False] * n, list(range(-1, n - 1)), [0] * n

    top = len(members) - 1
    while top:
        reach, below = length[top], lower[top]
        if size[top] == 1:
            # the usual case: one suffix, so one other to lengthen
            i = members[top][-1]
            if group[i] != top:
                i = next(j for j in members[top] if group[j] == top)
            seen[i], found[i] = True, reach
            j = before[i]
            while j >= 0 and seen[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                g = group[j]
                if size[g] == 1:
                    length[g] += reach
                else:
                    size[g] -= 1
                    new = len(members)
                    members.append([j])
                    group[j] = new
                    size.append(1)
                    length.append(length[g] + reach)
                    above = upper[g]
                    lower.append(g)
                    upper.append(above)
                    upper[g] = new
                    if above:
                        lower[above] = new
                    # the new group may be the one right below this one
                    below = lower[top]
            top = below
            continue
        here = [i for i in members[top] if group[i] == top]
        for i in here:
            seen[i], found[i] = True, reach
        times: dict[int, int] = {}
        for i in here:
            j = before[i]
            while j >= 0 and seen[j]:
                j = before[j]
            # places between are passed over at once next time
            k = i
            while k >= 0 and before[k] != j and k != j:
                before[k], k = j, before[k]
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, k in times.items():
            moved.setdefault((k, group[j]), []).append(j)
        for k, g in sorted(moved, reverse=True):
            those = moved[k, g]
            if len(those) == size[g]:
                length[g] += k * reach
                continue
            size[g] -= len(those)
            new = len(members)
            members.append(those)
            for j in those:
                group[j] = new
            size.append(len(those))
            length.append(length[g] + k * reach)
            above = upper[g]
            lower.append(g)
            upper.append(above)
            upper[g] = new
            if above:
                lower[above] = new
        top = lower[top]
    return found


class Extensions:
    """Longest common extensions of many pairs of places at once, by sums over the letters."""

    def __init__(self, letters: np.ndarray):
        self.n = n = len(letters)
        self.power = np.ones(n + 1, dtype=np.uint64)
        self.power[1:] = np.cumprod(np.full(n, _BASE))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(letters.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` letters from ``a`` on seem to equal those from ``b`` > ``a`` on."""
        return (self.sums[a + size] - self.sums[a]) * self.power[b - a] == self.sums[b + size] - self.sums[b]

    def _longest(self, most: np.ndarray, fits) -> np.ndarray:
        low, high = np.zeros(len(most), dtype=np.int64), most.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) // 2
            good = fits(middle)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._longest(self.n - b, lambda size: self.same(a, b, size))

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the letters before ``a`` and before ``b`` agree."""
        return self._longest(a.copy(), lambda size: self.same(a - size, b - size, size))


def runs(letters: np.ndarray, least: int = 2) -> list[tuple[int, int, int]]:
    """All maximal repetitions (start, length, period) of length ``least`` and twice the period, sorted.

    Sums may let unequal stretches pass as equal; so each result is compared letter by letter, and its
    root extended by comparing letters if that fails.
    """
    listed = letters.tolist()
    found: set[tuple[int, int, int]] = set()
    if len(listed) < 2:
        return []
    extensions = None
    for order in (listed, [-x for x in listed]):
        period = np.array(lyndon_array(order))
        root = np.flatnonzero(np.arange(len(period)) + period < len(letters))
        other = root + period[root]
        # a root that neither goes on behind it nor before it is no run
        on = letters[root] == letters[other]
        on[root > 0] |= letters[root[root > 0] - 1] == letters[other[root > 0] - 1]
        root, other = root[on], other[on]
        if not len(root):
            continue
        extensions = extensions or Extensions(letters)
        right, left = extensions.right(root, other), extensions.left(root, other)
        p = other - root
        start, length = root - left, left + p + right
        good = length >= np.maximum(2 * p, least)
        for k, s, x, q in zip(root[good].tolist(), start[good].tolist(), length[good].tolist(), p[good].tolist(), strict=True):
            found.add((k, s, x, q))
    exact: dict[tuple[int, int, int], bool] = {}
    for k, s, x, q in found:
        if (s, x, q) not in exact:
            exact[s, x, q] = _is_run(letters, s, x, q)
        if not exact[s, x, q]:
            s, x = _extended(letters, k, q)
            if x >= max(2 * q, least):
                exact[s, x, q] = True
    return sorted(run for run, true in exact.items() if true)


def _is_run(letters: np.ndarray, start: int, length: int, period: int) -> bool:
    return bool(np.array_equal(letters[start : start + length - period], letters[start + period : start + length]))


def _extended(letters: np.ndarray, root: int, period: int) -> tuple[int, int]:
    start, end = root, root + period
    while end < len(letters) and letters[end] == letters[end - period]:
        end += 1
    while start > 0 and letters[start - 1] == letters[start - 1 + period]:
        start -= 1
    return start, end - start
