"""The packing's evolution: hard instances, blocks at their bound, valid bins."""

import random

import pytest

from parcelscope.llm import packing as P

C = P.CAPACITY


def _triplets(n, seed):
    """Pieces of which three each fill a sequence exactly, and no two do."""
    rng, out = random.Random(seed), []
    while len(out) < 3 * n:
        a, b = rng.randint(C // 4 + 1, C // 2 - 1), rng.randint(C // 4 + 1, C // 2 - 1)
        if C // 4 < C - a - b < C // 2:
            out += [a, b, C - a - b]
    rng.shuffle(out)
    return out


def _bins(assigned, size):
    fill = {}
    for b, s in zip(assigned, size):
        fill[b] = fill.get(b, 0) + s
    assert len(assigned) == len(size) and max(fill.values()) <= C and sorted(fill) == list(range(len(fill)))
    return len(fill)


def test_triplets_come_near_their_optimum():
    size = _triplets(1365, 3)
    best_fit = len(P._seeded(size, C, random.Random(1), None).bins)
    islands = [P.evolve(size, C, [], seed) for seed in (1, 2)]
    merged = P.evolve(size, C, islands, 3)
    assert best_fit > 1450 and max(_bins(x, size) for x in islands) < 1400
    assert 1365 <= _bins(merged, size) <= min(_bins(x, size) for x in islands) and _bins(merged, size) <= 1372


def test_a_block_at_its_bound_is_not_evolved(monkeypatch):
    def never(*_):
        raise AssertionError("crossed")
    monkeypatch.setattr(P, "_cross", never)
    size = [1024] * 100 + [512] * 40 + [1] * 7
    assert _bins(P.evolve(size, C, [], 1), size) == -(-sum(size) // C)


@pytest.mark.parametrize("seed", range(6))
def test_any_pieces_stay_whole(seed):
    rng = random.Random(seed)
    size = [rng.choice((1, 2, 3, rng.randint(1, C - 1), rng.randint(600, 1100), 1024, 2047)) for _ in range(rng.choice((1, 2, 50, 400)))]
    a = P.evolve(size, C, [], seed)
    n = _bins(a, size)
    assert n <= len(P._seeded(size, C, rng, None).bins)
    assert _bins(P.evolve(size, C, [a, a], seed + 1), size) <= n
    for noise in (0.0, 0.7):
        assert sorted(i for b in P._completed(list(range(len(size))), size, C, rng, noise) for i in b) == list(range(len(size)))
