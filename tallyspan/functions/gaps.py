"""Distances to the nearest center, measured only where the triangle inequality leaves them open.

A point whose nearest center is at distance r stays with it when a new center is
at least 2 r away from that center. Points are grouped by their nearest center,
and a group is passed over as a whole when this holds for its farthest point.
"""

from __future__ import annotations

import numpy as np

from tallyspan.functions.kernels import distances_to

# New centers after which points are grouped again.
_REGROUP = 16
# Share of open points from which on all are measured, and how often that is seen
# before no more is ruled out until points are grouped again.
_MOST_OPEN = 0.4
_IDLE = 2
# Below this a distance may be off by more than rounding, as squares underflow.
_TINY = 1e-140


def gap_table(kept: list[np.ndarray], newest: list[list[np.ndarray]], rows: list[list[np.ndarray]], dropped: list[int]):
    """Distances between centers in one flat array, and how to find them.

    ``rows`` holds, for each of a part's newest centers, the distances to its
    kept earlier centers and to the newest ones before it. Returns the values,
    where each part's begin, the width of a row, the number of kept centers and
    the number of those dropped before them. A distance that overflowed is 0,
    which rules nothing out.
    """
    blocks, widths = [], []
    for before, found, distances in zip(kept, newest, rows, strict=True):
        width = len(before) + len(found)
        block = np.zeros((len(found), width))
        for turn, row in enumerate(distances):
            block[turn, : len(row)] = row
        blocks.append(block.ravel())
        widths.append(width)
    values = np.concatenate(blocks) if blocks else np.empty(0)
    values[~np.isfinite(values)] = 0.0
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks])))[:-1]
    numbers = (np.array(x, np.int64) for x in (offsets, widths, [len(b) for b in kept], dropped))
    return (values, *numbers)


def _settled(gap: np.ndarray, nearest: np.ndarray, width: int) -> np.ndarray:
    """Whether no point this near to its center can be nearer to one that far from it, whatever the rounding."""
    slack = 2.0 * (1.0 + 16 * (width + 8) * np.finfo(np.float64).eps)
    return (gap >= slack * nearest) & (gap >= _TINY)


def shrink(
    matrix: np.ndarray,
    at: np.ndarray,
    nearest: np.ndarray,
    owner: np.ndarray,
    vectors: np.ndarray,
    starts: np.ndarray,
    gaps,
) -> int:
    """Take the newest centers into ``nearest`` and ``owner``; returns how many distances were measured.

    ``at`` is the place of each point's part, ``vectors[starts[at]:starts[at + 1]]``
    that part's newest centers, ``owner`` the number of the nearest center in its
    part, -1 where there is none, and ``nearest`` is NaN there. The outcome
    is that of measuring every distance.
    """
    values, offsets, widths, kept, dropped = gaps
    own = np.maximum(owner - dropped[at], -1)
    sizes, width, measured = np.diff(starts), matrix.shape[1], 0

    def gap(part, column, turn):
        place = offsets[part] + turn * widths[part] + np.maximum(column, 0)
        return np.where(column < 0, 0.0, values[place])

    alone, n = len(sizes) == 1, len(matrix)
    for turn in range(sizes[np.unique(at)].max(initial=0)):
        if turn % _REGROUP == 0:
            key = at * (widths.max() + 1) + own + 1
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            lengths = np.diff(np.append(first, len(order)))
            part, column = at[order[first]], own[order[first]]
            radius = np.maximum.reduceat(nearest[order], first)
            idle = 0
        if alone and idle >= _IDLE:
            rows = None
        else:
            left = sizes[part] > turn
            left[left] = ~_settled(gap(part[left], column[left], turn), radius[left], width)
            rows = order if left.all() else order[np.repeat(left, lengths)]
            rows = rows[~_settled(gap(at[rows], own[rows], turn), nearest[rows], width)]
            if alone and len(rows) > _MOST_OPEN * n:
                # picking the points would cost more than it saves
                rows, idle = None, idle + 1
        if rows is None:
            dist, measured = distances_to(matrix, vectors[turn]), measured + n
            rows = np.flatnonzero(~(dist >= nearest))
            dist = dist[rows]
        elif len(rows):
            dist = distances_to(matrix[rows], vectors[turn] if alone else vectors[starts[at[rows]] + turn])
            measured += len(rows)
            closer = ~(dist >= nearest[rows])
            rows, dist = rows[closer], dist[closer]
        else:
            continue
        nearest[rows] = dist
        own[rows] = kept[at[rows]] + turn
    known = own >= 0
    owner[known] = own[known] + dropped[at[known]]
    return measured
