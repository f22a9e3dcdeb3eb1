"""Jaro-Winkler similarity as an Arrow-vectorised function.

Spark has no such built-in. The kernel works on whole Arrow batches: names become matrices
of code points and the greedy matching runs once per character position for all pairs of
the batch, not once per pair. It is defined inside a factory so that it is shipped to the
executors by value and needs no package installed there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The published Jaro-Winkler constants.
PREFIX_LENGTH = 4
PREFIX_SCALE = 0.1
BOOST_ABOVE = 0.7


def jaro_winkler_kernel():
    """A function of two sequences of strings, returning a float64 array."""
    prefix_length, scale, boost_above = PREFIX_LENGTH, PREFIX_SCALE, BOOST_ABOVE
    cells = 4_000_000  # upper bound on the matrix cells held at once

    import numpy as np

    def matrix(names, lengths):
        width = max(int(lengths.max()), 1)
        packed = np.array(names, dtype=f"U{width}")
        return packed.view(np.uint32).reshape(len(names), width)

    def ordered(chars, taken):
        """Matched characters row by row, with the row each belongs to."""
        rows, columns = np.nonzero(taken)
        return rows, chars[rows, columns]

    def score_block(left, right, n_left, n_right):
        a, b = matrix(left, n_left), matrix(right, n_right)
        count = len(left)
        reach = np.maximum(np.maximum(n_left, n_right) // 2 - 1, 0)
        position = np.arange(b.shape[1])
        free = position[None, :] < n_right[:, None]
        taken_a = np.zeros(a.shape, dtype=bool)
        every = np.arange(count)
        for i in range(a.shape[1]):
            fits = (
                (b == a[:, i : i + 1])
                & free
                & (np.abs(position[None, :] - i) <= reach[:, None])
                & (i < n_left)[:, None]
            )
            first = fits.argmax(axis=1)
            hit = fits[every, first]
            taken_a[:, i] = hit
            free[every[hit], first[hit]] = False
        taken_b = (position[None, :] < n_right[:, None]) & ~free

        matches = taken_a.sum(axis=1).astype("float64")
        rows, chars_a = ordered(a, taken_a)
        _, chars_b = ordered(b, taken_b)
        swaps = np.bincount(rows, weights=chars_a != chars_b, minlength=count) // 2

        some = np.maximum(matches, 1.0)
        jaro = np.where(
            matches > 0,
            (matches / n_left.clip(1) + matches / n_right.clip(1) + (matches - swaps) / some) / 3,
            0.0,
        )
        prefix = np.zeros(count)
        running = np.ones(count, dtype=bool)
        for i in range(min(prefix_length, a.shape[1], b.shape[1])):
            running &= (i < n_left) & (i < n_right) & (a[:, i] == b[:, i])
            prefix += running
        return np.where(jaro > boost_above, jaro + prefix * scale * (1.0 - jaro), jaro)

    def score(left, right):
        left, right = list(left), list(right)
        n_left = np.array([len(x) for x in left], dtype="int64")
        n_right = np.array([len(x) for x in right], dtype="int64")
        out = np.empty(len(left))
        longest = np.maximum(n_left, n_right)
        # Similar lengths go together, so one long name does not widen every row.
        order = np.argsort(longest, kind="stable")
        start = 0
        while start < len(order):
            stop = min(start + 8192, len(order))
            while stop - start > 1 and (stop - start) * int(longest[order[stop - 1]]) > cells:
                stop = start + (stop - start) // 2
            block = order[start:stop]
            out[block] = score_block(
                [left[i] for i in block], [right[i] for i in block],
                n_left[block], n_right[block],
            )
            start = stop
        return out

    return score


def score_pairs(pairs: DataFrame, left: str, right: str, threshold: float) -> DataFrame:
    """The pairs whose similarity reaches the threshold, with their `score`.

    Pairs below it never leave the Python worker.
    """
    kernel = jaro_winkler_kernel()

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = batch.column(0), batch.column(1)
            scores = kernel(a.to_pylist(), b.to_pylist())
            keep = pa.array(scores >= threshold)
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(scores, pa.float64())], names=[left, right, "score"]
            ).filter(keep)

    return pairs.select(left, right).mapInArrow(
        score, f"{left} string, {right} string, score double"
    )
