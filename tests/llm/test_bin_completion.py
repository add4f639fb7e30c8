"""Bin completion against exact optima and against all fillings."""

import random
from itertools import combinations

import numpy as np
import pytest

from eddy.llm import packing


def histogram(sizes, capacity):
    return np.bincount(np.asarray(sizes, int), minlength=capacity + 1)


def optimum(sizes, capacity):
    """Least bins by subsets: (bins, room used in the last one) of every subset."""
    best = [(0, capacity)] * (1 << len(sizes))
    for s in range(1, 1 << len(sizes)):
        tried = []
        for i, x in enumerate(sizes):
            if s >> i & 1:
                n, used = best[s & ~(1 << i)]
                tried.append((n, used + x) if used + x <= capacity else (n + 1, x))
        best[s] = min(tried)
    return best[-1][0]


KNOWN = [([55, 50, 42, 41, 40, 35, 35, 25, 23, 18, 13, 12, 10], 5, 4), ([6, 5, 5, 4, 4, 3, 3], None, 3)]


@pytest.mark.parametrize("sizes,greedy,least", KNOWN)
def test_search_beats_best_fit(sizes, greedy, least):
    capacity = 100 if sizes[0] > 10 else 10
    counts = histogram(sizes, capacity)
    if greedy:
        assert len(packing.best_fit(counts, capacity)) == greedy
    got = packing.complete_bins(counts, capacity, 20_000)
    assert len(got) == least
    assert sorted(x for b in got for x in b) == sorted(sizes) and all(sum(b) <= capacity for b in got)


@pytest.mark.parametrize("kept", [1, packing.KEPT_FRAMES])
def test_search_finds_the_optimum(monkeypatch, kept):
    """Also when frames lose their state at once and begin their fillings again."""
    monkeypatch.setattr(packing, "KEPT_FRAMES", kept)
    r = random.Random(5)
    better = 0
    for k in range(1500):
        sizes = [r.randint(8, 60) for _ in range(r.randint(7, 10))]
        counts = histogram(sizes, 100)
        first, got = packing.best_fit(counts, 100), packing.complete_bins(counts, 100, 20_000)
        assert sorted(x for b in got for x in b) == sorted(sizes) and all(sum(b) <= 100 for b in got)
        if len(first) > -(-sum(sizes) // 100):
            assert len(got) == optimum(sizes, 100), sizes
            better += len(got) < len(first)
    assert better > 0


def replaces(fill, waste, spare):
    """The rule of dominance, subset by subset."""
    for n in range(len(fill) + 1):
        for part in combinations(fill, n):
            for x in spare:
                if sum(part) <= x <= sum(part) + waste and (x > sum(part) or n > 1):
                    return True
    return False


def test_fillings_are_all_undominated_ones():
    r = random.Random(6)
    for _ in range(200):
        sizes, gap = sorted(r.randint(1, 20) for _ in range(r.randint(1, 8))), r.randint(1, 40)
        got = list(packing.completions(histogram(sizes, max(gap, 20)), gap))
        waste = [gap - sum(f) for f in got]
        assert waste == sorted(waste) and len(set(got)) == len(got)
        want = set()
        for n in range(len(sizes) + 1):
            for idx in combinations(range(len(sizes)), n):
                fill, spare = [sizes[i] for i in idx], [x for i, x in enumerate(sizes) if i not in idx]
                if sum(fill) <= gap and not replaces(fill, gap - sum(fill), spare):
                    want.add(tuple(sorted(fill, reverse=True)))
        assert set(got) == ({(gap,)} if gap in sizes else want)


def test_many_lengths_within_the_node_limit():
    r = random.Random(7)
    sizes = [r.randint(1, 4096) for _ in range(3000)]
    counts = histogram(sizes, 4096)
    got = packing.complete_bins(counts, 4096, 300)
    assert sorted(x for b in got for x in b) == sorted(sizes) and all(sum(b) <= 4096 for b in got)
    assert len(got) <= len(packing.best_fit(counts, 4096))
