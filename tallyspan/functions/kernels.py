"""NumPy helpers for the Arrow tasks: small functions on one batch or block.

All distances come from :func:`squared_distances`, from coordinate differences
summed row by row, so a pair has the same distance to the last bit in whatever
batch it is computed. Work is cut to pieces that stay in a core's cache.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Numbers in one piece of scratch memory, and the tile of a block pair.
_SCRATCH = 32_768
_TILE_ROWS = 256
_TILE_COLUMNS = 1_024


def feature_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column as a matrix with one row per point."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten()
    if column.null_count or values.null_count:
        raise ValueError("a point has a missing coordinate")
    rows = len(column)
    width = len(values) // rows if rows else 0
    if rows and np.any(np.diff(column.offsets.to_numpy()) != width):
        raise ValueError("points have different dimensions")
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows, width)


def feature_column(matrix: np.ndarray) -> pa.ListArray:
    """A matrix as an Arrow list column."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(matrix).ravel(), pa.float64())
    )


def squared_distances(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Squared distance of every row to one point, or row by row to equally many."""
    if len(matrix) and matrix.shape[1] != target.shape[-1]:
        raise ValueError("points have different dimensions")
    out = np.empty(len(matrix))
    step = max(1, _SCRATCH // max(matrix.shape[1], 1))
    for start in range(0, len(matrix), step):
        rows = slice(start, start + step)
        difference = matrix[rows] - (target if target.ndim == 1 else target[rows])
        out[rows] = np.square(difference, out=difference).sum(axis=1)
    return out


def distances_to(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Distance of every row to one point, or row by row to equally many."""
    squares = squared_distances(matrix, target)
    return np.sqrt(squares, out=squares)


def first_rows(group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: int) -> np.ndarray:
    """Positions of the ``rows`` first rows of each group by (score, id)."""
    order = np.lexsort((ids, score, group))
    if not len(order):
        return order
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    lengths = np.diff(np.r_[starts, len(order)])
    return order[np.arange(len(order)) - np.repeat(starts, lengths) < rows]


class FarthestPairs:
    """The first ``rows`` pairs by (squared distance descending, i, j).

    Pairs of a squared distance below ``floor`` are of no interest, nor, with a
    ``cap``, pairs with a point that has ``cap`` earlier pairs. ``bound`` is a
    squared distance that no other pair left out exceeds.
    """

    def __init__(self, rows: int, floor: float = -np.inf, cap: int | None = None):
        self.rows = rows
        self.floor = floor
        self.cap = cap
        self.bound = -np.inf
        self.d2 = np.empty(0)
        self.i = np.empty(0, np.int64)
        self.j = np.empty(0, np.int64)

    def _floor(self) -> float:
        if len(self.d2) < self.rows:
            return self.floor
        self.bound = max(self.bound, self.d2[-1])
        return self.d2[-1]

    def _within_cap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of pairs in order, those whose points have fewer than ``cap`` pairs before."""
        ends = np.concatenate([i, j])
        turn = np.tile(np.arange(len(i)), 2)
        order = np.lexsort((turn, ends))
        starts = np.flatnonzero(np.r_[True, ends[order][1:] != ends[order][:-1]])
        lengths = np.diff(np.r_[starts, len(order)])
        before = np.empty(len(order), np.int64)
        before[order] = np.arange(len(order)) - np.repeat(starts, lengths)
        return np.maximum(before[: len(i)], before[len(i) :]) < self.cap

    def _add(self, d2: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        keep = d2 >= self._floor()
        d2 = np.concatenate([self.d2, d2[keep]])
        i = np.concatenate([self.i, np.minimum(a, b)[keep]])
        j = np.concatenate([self.j, np.maximum(a, b)[keep]])
        order = np.lexsort((j, i, -d2))
        if self.cap is not None and len(order):
            order = order[self._within_cap(i[order], j[order])]
        if len(order) > self.rows:
            self.bound = max(self.bound, d2[order[self.rows]])
        order = order[: self.rows]
        self.d2, self.i, self.j = d2[order], i[order], j[order]

    def compare(self, ids_a, a, ids_b, b, same_block: bool) -> None:
        """Take in all pairs of two blocks, or of one block with itself.

        A matrix product gives the squared distances of a tile up to rounding.
        Only the pairs that may still be among the first, allowing for its
        error bound, are computed again from the differences, and those values
        count.
        """
        center = a.mean(axis=0)
        ids_a, a, ca, na = _outermost_first(ids_a, a, center)
        ids_b, b, cb, nb = _outermost_first(ids_b, b, center)
        slack = _rounding_bound(a, b, center, na[0] + nb[0])
        # |x|^2 + |y|^2 - 2xy as one product
        left = np.column_stack([-2.0 * ca, na, np.ones(len(a))])
        right = np.column_stack([cb, np.ones(len(b)), nb]).T
        for top in range(0, len(a), _TILE_ROWS):
            rows = slice(top, min(top + _TILE_ROWS, len(a)))
            for edge in range(0, len(b), _TILE_COLUMNS):
                columns = slice(edge, min(edge + _TILE_COLUMNS, len(b)))
                if same_block and columns.stop <= rows.start + 1:
                    continue
                # no distance here or further right exceeds the sum of the radii
                if (np.sqrt(na[top]) + np.sqrt(nb[edge])) ** 2 < self._floor() - slack:
                    break
                rough = left[rows] @ right[:, columns]
                if same_block and columns.start < rows.stop:
                    at = np.arange(rows.start, rows.stop)[:, None]
                    rough[at >= np.arange(columns.start, columns.stop)] = -np.inf
                self._take(rough, slack, ids_a[rows], a[rows], ids_b[columns], b[columns])

    def _take(self, rough, slack, ids_a, a, ids_b, b) -> None:
        cut = max(self._floor() - slack, np.finfo(np.float64).min)
        if rough.max() < cut:
            return
        if self.rows == 1:
            possible = rough >= max(cut, rough.max() - 2 * slack)
        else:
            possible = rough >= cut
            found = np.count_nonzero(possible)
            if found > self.rows and self.cap is not None:
                # a point's pairs beyond its first ones in this tile
                for axis in (0, 1):
                    if self.cap < rough.shape[axis]:
                        place = rough.shape[axis] - self.cap
                        least = np.partition(rough, place, axis).take([place], axis)
                        possible &= rough >= least - 2 * slack
                found = np.count_nonzero(possible)
            if found > self.rows:
                last = np.partition(rough[possible], found - self.rows)[found - self.rows]
                possible &= rough >= last - 2 * slack
                self.bound = max(self.bound, last + slack)
        x, y = np.nonzero(possible)
        step = max(1, 8 * _SCRATCH // max(a.shape[1], 1))
        for first in range(0, len(x), step):
            i, j = x[first : first + step], y[first : first + step]
            self._add(squared_distances(a[i], b[j]), ids_a[i], ids_b[j])


def _outermost_first(ids: np.ndarray, matrix: np.ndarray, center: np.ndarray):
    """Ids, points, offsets from the center and their squared lengths, longest first."""
    offsets = matrix - center
    squares = np.square(offsets).sum(axis=1)
    order = np.lexsort((ids, -squares))
    return ids[order], matrix[order], offsets[order], squares[order]


def _rounding_bound(a, b, center, reach: float) -> float:
    """Bound on the error of a squared distance from the centered product."""
    width = a.shape[1]
    eps = np.finfo(np.float64).eps
    shift = 2 * eps * max(np.abs(part).max(initial=0) for part in (a, b, center))
    bound = 4 * (width + 8) * eps * reach
    return bound + 8 * shift * np.sqrt(width * reach) + 8 * width * shift**2


class ExactSum:
    """A sum of non-negative numbers without rounding, as integers by binary exponent.

    A number is ``(high * 2**26 + low) * 2**(exponent - 53)`` with integers of 27
    and 26 bits; those of one exponent are added up, so no order of the numbers
    changes anything. Up to 2**36 numbers fit; infinite ones count under INFINITE.
    """

    INFINITE = 1_100
    _LOWEST = -1_080

    def __init__(self):
        self.high, self.low = np.zeros((2, self.INFINITE + 1 - self._LOWEST), np.int64)

    def add(self, values: np.ndarray) -> None:
        for first in range(0, len(values), 1 << 20):  # bincount adds up to 2**53 exactly
            some = values[first : first + (1 << 20)]
            finite = np.isfinite(some)
            self.high[-1] += len(some) - np.count_nonzero(finite)
            part, exponent = np.frexp(some[finite])
            whole = np.ldexp(part, 53).astype(np.int64)
            for sums, digits in ((self.high, whole >> 26), (self.low, whole & ((1 << 26) - 1))):
                sums += np.bincount(exponent - self._LOWEST, digits, len(sums)).astype(np.int64)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exponents that occur, and their sums of high and low digits."""
        used = np.flatnonzero(self.high | self.low)
        return used + self._LOWEST, self.high[used], self.low[used]

    def __float__(self) -> float:
        return self.total(*(part.tolist() for part in self.parts()))

    @classmethod
    def total(cls, exponents: list[int], high: list[int], low: list[int]) -> float:
        """The sum of such parts, rounded once."""
        if any(e == cls.INFINITE and h for e, h in zip(exponents, high, strict=True)):
            return float("inf")
        shift = 53 - cls._LOWEST
        units = sum(((int(h) << 26) + int(w)) << (e - cls._LOWEST) for e, h, w in zip(exponents, high, low, strict=True))
        try:
            return units / (1 << shift)
        except OverflowError:
            return float("inf")


def distance_sum(a: np.ndarray, b: np.ndarray, same_block: bool) -> tuple[ExactSum, int]:
    """Sum and number of the distances of two blocks, or within one block."""
    total, pairs = ExactSum(), 0
    for row in range(len(a)):
        others = b[row + 1 :] if same_block else b
        if len(others):
            total.add(distances_to(others, a[row]))
            pairs += len(others)
    return total, pairs
