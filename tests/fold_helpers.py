"""The guarded fold row by row, and the tables of its chunks, for the tests."""

import numpy as np

from tidemark.plans import guarded


def coded(deltas, consume):
    """Kinds and amounts of rows that add (delta >= 0), take, or check only (not consume)."""
    d, c = np.asarray(deltas, dtype=np.int64), np.asarray(consume, dtype=bool)
    return np.where(d >= 0, guarded.ADD, np.where(c, guarded.TAKE, guarded.PROBE)), np.abs(d)


def fold_rows(deltas, consume, start):
    """(accepted flags, balance after each row)."""
    b, acc, bal = start, [], []
    for d, c in zip(deltas, consume):
        ok = d >= 0 or b >= -d
        if ok and (d >= 0 or c):
            b += d
        acc.append(ok)
        bal.append(b)
    return acc, bal


def fold_pieces(deltas, consume, most=10**9):
    """(lower ends, offsets) of the ranges of start balances."""
    table = guarded.Ranges(most=most)
    table.work = -(1 << 60)  # no bound here
    assert table.feed(*(x.tolist() for x in coded(deltas, consume)))
    return table.table()


def apply_pieces(low, off, b):
    return b + int(off[int(np.searchsorted(np.asarray(low), b, side="right")) - 1])
