"""The lease arithmetic, without Spark, against the sequential rules."""

import numpy as np
from hypothesis import given, settings, strategies as st

from model import Limiter
from tidegate.operators.leased import _lease_runs, _through_window, _unit_step
from tidegate.streaming.leases import serve

charges = st.lists(st.integers(1, 12), min_size=1, max_size=25)
small = st.integers(1, 15)


def replay(n, tokens, used, limit, lease, resets=()):
    limiter = Limiter(limit, lease)
    limiter.tokens["a"], limiter.used[("a", 0)] = tokens, used
    admitted = []
    for i, charge in enumerate(n):
        if i in resets:
            limiter.tokens["a"] = 0
        admitted.append(limiter.allow("a", 0, charge))
    return admitted, limiter.tokens["a"], limiter.used[("a", 0)]


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 40), small, small, st.data())
def test_unit_step(count, limit, lease, data):
    tokens = data.draw(st.integers(0, min(limit, lease) - 1))
    used = data.draw(st.integers(0, limit))
    admitted, left, after = replay([1] * count, tokens, used, limit, lease)
    assert tuple(map(int, _unit_step(count, tokens, used, limit, lease))) == (
        sum(admitted), left, after)


@settings(max_examples=400, deadline=None)
@given(charges, small, small, st.data())
def test_serve(n, limit, lease, data):
    tokens = data.draw(st.integers(0, min(limit, lease) - 1))
    used = data.draw(st.integers(0, limit))
    admitted, left, after = replay(n, tokens, used, limit, lease)
    taken, got_left, got_after = serve(np.array(n), tokens, used, limit, lease)
    assert admitted == [True] * taken + [False] * (len(n) - taken)
    assert (got_left, got_after) == (left, after)


@settings(max_examples=400, deadline=None)
@given(charges, small, small, st.data())
def test_window_table(n, limit, lease, data):
    used = data.draw(st.integers(0, limit))
    resets = data.draw(st.sets(st.integers(0, len(n) - 1), max_size=3))
    size = min(limit, lease)
    fresh = np.isin(np.arange(len(n)), list(resets))
    table = (*_lease_runs(np.array(n), fresh, used, limit, lease, size), used)
    tokens = np.arange(size)
    allowed, left, after = _through_window(tokens, *table)
    for start in range(size):
        admitted, want_left, want_after = replay(n, start, used, limit, lease, resets)
        taken = sum(admitted)
        assert admitted == [True] * taken + [False] * (len(n) - taken)
        assert allowed[start] == sum(n[:taken])
        assert (left[start], after[start]) == (want_left, want_after)
