"""Ratcliff/Obershelp ratios of many pairs of texts at once.

The longest common block of a pair (the first in the left text, then in the right one, among equally long ones) splits both texts, and
what lies before and behind it is searched in turn. Here all open parts of all pairs of an Arrow batch are searched together, round by round: a
round takes one step for each symbol of the longest left part, and a step is a few array operations over all parts of a block.
Parts are dealt into blocks by size, so that short ones are not padded to long ones and memory is bounded by CELLS.

In right texts of 200 symbols and more, symbols that make up over one percent (and one more) start no block; blocks grow over them.
"""

from __future__ import annotations

import pyarrow as pa

#: Cells (parts times symbols of the right text) searched at once.
CELLS = 1 << 18
#: Right texts of this length and more have popular symbols.
POPULAR_FROM = 200


def symbols(texts: pa.Array):
    """Code points of all texts in one array, and where each begins (nulls count as empty)."""
    import numpy as np

    lengths = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    whole = "".join(texts.drop_null().to_pylist())
    return np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def without_popular(right, starts):
    """The right symbols with popular ones as -1, and which texts have any."""
    import numpy as np

    lengths = np.diff(starts)
    plain, has = right.copy(), np.zeros(len(lengths), bool)
    long = np.flatnonzero(lengths >= POPULAR_FROM)
    if len(long):
        rows = np.repeat(np.arange(len(lengths)), lengths)
        at = np.flatnonzero(lengths[rows] >= POPULAR_FROM)
        _, name, count = np.unique(rows[at] << 32 | right[at], return_inverse=True, return_counts=True)
        popular = count[name] > lengths[rows[at]] // 100 + 1
        plain[at[popular]] = -1
        has[np.unique(rows[at[popular]])] = True
    return plain, has


def longest_blocks(left, right, a0, a1, b0, b1):
    """Start in the left, start in the right and size of the longest common block of each part; right symbols of -1 match nothing."""
    import numpy as np

    n, width = len(a0), int((b1 - b0).max())
    place = b0[:, None] + np.arange(width)
    own = np.where(place < b1[:, None], right[np.minimum(place, len(right) - 1)], -1)
    size, at_a, at_b = np.zeros(n, np.int64), a0.copy(), b0.copy()
    run, rows = np.zeros((n, width + 1), np.int32), np.arange(n)
    for step in range(int((a1 - a0).max())):
        # Parts are ordered by the length on the left: those that have ended are at the front.
        first = int(np.searchsorted(a1 - a0, step, "right"))
        symbol = left[a0[first:] + step]
        new = np.zeros((n - first, width + 1), np.int32)
        new[:, 1:] = (run[first - n :, :-1] + 1) * (own[first:] == symbol[:, None])
        top = new.max(axis=1)
        more = np.flatnonzero(top > size[first:])
        if len(more):
            end = new[more].argmax(axis=1)
            k = rows[first:][more]
            size[k] = top[more]
            at_a[k] = a0[k] + step + 1 - top[more]
            at_b[k] = b0[k] + end - top[more]
        run = new
    return at_a, at_b, size


def matched(left, left_starts, right, right_starts):
    """The number of matched symbols of each pair."""
    import numpy as np

    plain, has_popular = without_popular(right, right_starts)
    pairs = len(left_starts) - 1
    total = np.zeros(pairs, np.int64)
    part = (np.arange(pairs), left_starts[:-1], left_starts[1:], right_starts[:-1], right_starts[1:])
    while True:
        pair, a0, a1, b0, b1 = part
        open_ = np.flatnonzero((a1 > a0) & (b1 > b0))
        if not len(open_):
            return total
        # Blocks of parts of alike width on the right, inside a block by length on the left.
        widths = b1[open_] - b0[open_]
        order = open_[np.argsort(widths, kind="stable")]
        widths, left_over, parts = b1[order] - b0[order], len(order), []
        while left_over:
            take = min(left_over, max(1, CELLS // int(widths[left_over - 1])))
            some = order[left_over - take : left_over]
            some = some[np.argsort(a1[some] - a0[some], kind="stable")]
            left_over -= take
            p, w, x, y, z = pair[some], a0[some], a1[some], b0[some], b1[some]
            i, j, size = longest_blocks(left, plain, w, x, y, z)
            grow = np.flatnonzero(has_popular[p])
            for k in grow:  # over popular symbols; such texts are long and rare
                while i[k] > w[k] and j[k] > y[k] and left[i[k] - 1] == right[j[k] - 1]:
                    i[k], j[k], size[k] = i[k] - 1, j[k] - 1, size[k] + 1
                while i[k] + size[k] < x[k] and j[k] + size[k] < z[k] and left[i[k] + size[k]] == right[j[k] + size[k]]:
                    size[k] += 1
            np.add.at(total, p, size)
            hit = size > 0
            p, w, x, y, z, i, j, size = (v[hit] for v in (p, w, x, y, z, i, j, size))
            parts.append((p, w, i, y, j))
            parts.append((p, i + size, x, j + size, z))
        part = tuple(np.concatenate(v) for v in zip(*parts))


def ratios(left: pa.Array, right: pa.Array):
    """Twice the matched symbols over the symbols of both texts, 1 for two empty ones; NaN where either is null."""
    import numpy as np

    (a, a_starts), (b, b_starts) = symbols(left), symbols(right)
    both = np.diff(a_starts) + np.diff(b_starts)
    found = np.where(both > 0, 2.0 * matched(a, a_starts, b, b_starts) / np.maximum(both, 1), 1.0)
    known = pa.compute.and_(pa.compute.is_valid(left), pa.compute.is_valid(right)).to_numpy(zero_copy_only=False)
    return np.where(known, found, np.nan)
