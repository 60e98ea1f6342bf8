"""Which windows of a set of short strings repeat, from a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` sorted by at least their first ``depth`` symbols (prefix
    tripling); in which order equal ones come does not matter for shorter strings."""
    n = len(text)
    codes = np.cumsum(np.bincount(text) > 0).astype(np.uint64)[text]
    bits = int(codes.max()).bit_length()
    reach = 63 // bits
    padded = np.concatenate((codes, np.zeros(reach, np.uint64)))
    keys = np.zeros(n, np.uint64)
    for k in range(reach):
        keys = keys << np.uint64(bits) | padded[k : k + n]
    # As many ranks as fit are put together: three in tasks of the usual size.
    width = (n + 1).bit_length()
    times = 3 if 3 * width <= 64 else 2
    while True:
        order = np.argsort(keys)
        ordered = keys[order]
        fresh = np.concatenate(([1], ordered[1:] != ordered[:-1]))
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh, dtype=np.uint64)
        if reach >= depth or int(rank[order[-1]]) == n:
            return order
        keys = rank.copy()
        for k in range(1, times):
            keys <<= np.uint64(width)
            keys[: max(n - k * reach, 0)] |= rank[k * reach :]
        reach *= times


def common_groups(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Group number of every row of the suffix order: rows next to each other that start
    with the same ``depth`` symbols are in one group.

    ``text`` holds symbols from 1 and the separator 0. Intervals of the suffix order are
    expanded breadth first: every interval of a string of length l - 1 gives those of the
    strings one symbol longer to the left, found by the last-to-first mapping of the
    transform. The first time an interval ends at a row, the common prefix of that row with
    the row before is known to be l - 1 long, so prefixes come out in increasing order, and
    only such intervals go on to the next round. After round ``depth`` the rows without a
    value share at least ``depth`` symbols with the row before. Separators are never
    prepended, so a value is missing only behind a row that meets a separator within
    ``depth`` symbols; such rows hold no whole window.
    """
    n = len(text)
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    before = text[order - 1]  # the transform; position 0 follows the last separator
    before[order == 0] = 0
    last_to_first = where[order - 1]
    first = text[order]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    owner, counter = np.full(n, -1, np.int64), 0
    ends = np.flatnonzero(np.concatenate((first[1:] != first[:-1], [True]))) + 1
    starts = np.concatenate(([0], ends[:-1]))
    known[ends] = True
    real = first[starts] > 0
    low, high = starts[real], ends[real]
    mask = np.zeros(n, bool)
    for _ in range(2, depth + 1):
        if not len(low):
            break
        sizes = high - low
        rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        whose = np.repeat(np.arange(counter, counter + len(low)), sizes)
        counter += len(low)
        real = before[rows] > 0
        goal = last_to_first[rows[real]]
        owner[goal] = whose[real]
        if len(goal) * 16 > n:
            mask[goal] = True
            goal = np.flatnonzero(mask)
            mask[goal] = False
        else:
            goal = np.sort(goal)
        if not len(goal):
            break
        split = (
            (goal[1:] != goal[:-1] + 1)
            | (owner[goal[1:]] != owner[goal[:-1]])
            | (first[goal[1:]] != first[goal[:-1]])
        )
        at = np.flatnonzero(split)
        low = goal[np.concatenate(([0], at + 1))]
        high = goal[np.concatenate((at, [len(goal) - 1]))] + 1
        new = ~known[high]
        known[high[new]] = True
        low, high = low[new], high[new]
    return np.cumsum(known[:n])


def repeated_starts(
    strings: list[np.ndarray], counts: np.ndarray, width: int
) -> list[np.ndarray]:
    """For each byte string the starts of its windows of ``width`` bytes that occur twice or
    more, a string standing for ``counts`` copies of itself."""
    lengths = np.array([len(s) for s in strings])
    text = np.zeros(int(lengths.sum()) + len(strings), np.uint16)
    begins = np.cumsum(lengths + 1) - lengths - 1
    for s, b in zip(strings, begins, strict=True):
        text[b : b + len(s)] = s
        text[b : b + len(s)] += 1
    order = suffix_order(text, width)
    groups = common_groups(text, order, width)
    # Whole windows only: others weigh nothing.
    weight = np.zeros(len(text), np.int64)
    for b, n, c in zip(begins, lengths, counts, strict=True):
        weight[b : b + max(n - width + 1, 0)] = c
    rows = weight[order]
    total = np.bincount(groups, rows)
    hit = np.zeros(len(text), bool)
    hit[order[(total[groups] >= 2) & (rows > 0)]] = True
    return [np.flatnonzero(hit[b : b + n]) for b, n in zip(begins, lengths, strict=True)]
