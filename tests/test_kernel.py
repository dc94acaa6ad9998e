"""The detector against golden vectors, a tick-by-tick loop, and any cut into blocks."""

import numpy as np
import pytest

from seiche.operators.kernel import Detector, Ticks, detect, estimate_memory


def T(p, t=None):
    p = np.array(p, float)
    return Ticks(p, np.array(t if t is not None else range(len(p)), np.int64), np.ones(len(p)), np.ones(len(p), np.int8))


def seen(p, t=None, **k):
    events, d = detect(T(p, t), 0.02, **k)
    return [(e.kind, e.reference_price, e.confirm_price, e.extreme_price, e.change.price.tolist(), e.overshoot.price.tolist()) for e in events], d


@pytest.mark.parametrize(
    ("prices", "times", "want"),
    [
        ([100, 100.5, 101, 102, 103, 104, 105, 103, 101, 99, 98, 97], None, [(1, 100, 102, 105, [100.5, 101, 102], [103, 104, 105]), (-1, 105, 101, -1, [103, 101], [99, 98, 97])]),
        ([100, 102, 103, 100], None, [(1, 100, 102, 103, [102], [103]), (-1, 103, 100, -1, [100], [])]),
        ([100, 102, 99.9], None, [(1, 100, 102, 102, [102], []), (-1, 102, 99.9, -1, [99.9], [])]),
        ([100, 103, 102.5, 99, 104], [0, 1, 1, 1, 2], [(1, 100, 102.5, 99, [103, 102.5, 99], []), (1, 99, 104, -1, [104], [])]),
        ([100, 103, 102.5, 101, 100.4], [0, 1, 1, 1, 2], [(1, 100, 102.5, 101, [103, 102.5, 101], []), (-1, 101, 100.4, -1, [100.4], [])]),
        ([100, 102, 105, 104, 103, 102.5, 101.9], None, [(1, 100, 102, 105, [102], [105]), (-1, 105, 102.5, -1, [104, 103, 102.5], [101.9])]),
        ([100, 102, 104, 106, 108, 110], None, [(1, 100, 102, -1, [102], [104, 106, 108, 110])]),
        ([100, 98, 96, 94, 92, 90], None, [(-1, 100, 98, -1, [98], [96, 94, 92, 90])]),
        ([100] * 5, None, []),
        ([100], None, []),
        ([], None, []),
    ],
)
def test_golden(prices, times, want):
    assert seen(prices, times)[0] == want


def test_carried_state():
    got, d = seen([104, 103, 102.5, 101.9], [3, 4, 5, 6], trend=1, high=104, low=103)
    assert got == [(-1, 104, 101.9, -1, [103, 102.5, 101.9], [])]
    got, d = seen([100, 104, 107, 110, 111], trend=1, high=110, low=100)
    assert got == [(1, 100, 104, -1, [104], [107, 110, 111])]
    _, d = seen([100, 100.5, 101, 102, 103, 104, 105, 103, 101, 99, 98, 97])
    assert (d.trend, d.high, d.low, d.orphan_start(), len(d.orphans())) == (-1, 105, 97, 12, 0)


def slow(p, t, theta):
    n, trend, hp, lp, hi, li, out = len(p), 0, p[0], p[0], 0, 0, []
    for i in range(n):
        if p[i] > hp:
            hp, hi = p[i], i
        if p[i] < lp:
            lp, li = p[i], i
        new = 1 if trend <= 0 and p[i] >= lp * (1 + theta) else -1 if trend >= 0 and p[i] <= hp * (1 - theta) else 0
        if new:
            j = max(k for k in range(i, n) if t[i] == t[k])
            x = li if new == 1 else hi
            c = min(q for q in p[i : j + 1] if q >= lp * (1 + theta)) if new == 1 else max(q for q in p[i : j + 1] if q <= hp * (1 - theta))
            trend = new
            if new == 1:
                hp, hi = c, j
            else:
                lp, li = c, j
            if x < j:
                out.append((new, x, j, c))
    return out, (trend, hp, hi, lp, li)


@pytest.mark.parametrize("seed", range(8))
def test_any_blocks(seed):
    r = np.random.default_rng(seed)
    for _ in range(60):
        n = int(r.integers(1, 90))
        p, t = np.round(100 * np.exp(np.cumsum(r.normal(0, 0.01, n))), 1), np.cumsum(r.random(n) < r.choice([0.3, 0.7, 1]))
        d, got, a = Detector(0.02), [], 0
        while a < n:
            b = a + int(r.integers(1, 20))
            got += d.feed(T(p[a:b], t[a:b]))
            a = b
        got += d.finish()
        assert ([(e.kind, e.reference, e.confirm, e.confirm_price) for e in got], (d.trend, d.high, d.high_at, d.low, d.low_at)) == slow(p, t, 0.02)


def test_scaling_by_a_power_of_two():
    p = 100 * np.exp(np.cumsum(np.random.default_rng(1).normal(0, 0.01, 2000)))
    a, b = detect(T(p), 0.02)[0], detect(T(p * 4), 0.02)[0]
    assert [(e.reference, e.confirm, e.end) for e in a] == [(e.reference, e.confirm, e.end) for e in b] and len(a) > 20


def test_memory_of_a_long_series_is_bounded():
    r, d, most = np.random.default_rng(2), Detector(0.01), 0
    p = 100 * np.exp(np.cumsum(r.normal(0, 0.002, 200_000)))
    for a in range(0, len(p), 5000):
        d.feed(T(p[a : a + 5000], np.arange(a, min(a + 5000, len(p)))))
        most = max(most, len(d.kept))
    assert most < 20_000


def test_estimate():
    assert estimate_memory(1_000_000, 0.005)["input_mb"] == 25
