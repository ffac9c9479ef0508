"""Property tests of the guarded fold's pure parts (no Spark): tables of a chunk, and chunks chained."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fold_helpers import apply_pieces, fold_pieces, fold_rows

deltas = st.lists(st.integers(min_value=-30, max_value=20), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(deltas, st.lists(st.booleans(), min_size=40, max_size=40), st.integers(min_value=0, max_value=80))
def test_fold_pieces_equal_direct_fold(ds, cs, top):
    d = np.array(ds, dtype=np.int64)
    c = np.array(cs[: len(ds)], dtype=bool)
    low, off = fold_pieces(d, c)
    for b in [*range(-5, top), 10**9]:
        _, bal = fold_rows(d.tolist(), c.tolist(), b)
        assert apply_pieces(low, off, b) == bal[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(min_value=-9, max_value=4), min_size=2, max_size=60), st.integers(min_value=1, max_value=5),
       st.integers(min_value=0, max_value=40))
def test_chained_chunk_tables_equal_one_fold(ds, parts, start):
    """Cutting one key's rows into chunks and chaining their tables gives the sequential answer."""
    d = np.array(ds, dtype=np.int64)
    c = np.ones(len(ds), dtype=bool)
    cuts = np.linspace(0, len(ds), parts + 1).astype(int)
    b = start
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi <= lo:
            continue
        b = apply_pieces(*fold_pieces(d[lo:hi], c[lo:hi]), b)
    _, bal = fold_rows(d.tolist(), c.tolist(), start)
    assert b == bal[-1]



def test_fold_pieces_through_merges():
    """Long runs of takes, long enough for equal neighbours to be merged."""
    rng = np.random.default_rng(7)
    for n, top in [(100, 300), (250, 1000)]:
        d = -rng.integers(1, 9, size=n).astype(np.int64)
        d[::17] = 5  # some adds in between
        c = rng.random(n) > 0.1
        low, off = fold_pieces(d, c)
        for b in range(top):
            _, bal = fold_rows(d.tolist(), c.tolist(), b)
            assert apply_pieces(low, off, b) == bal[-1]
