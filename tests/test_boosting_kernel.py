"""The arrays behind a boosting pass: bins lie feature by feature."""

import pickle

import numpy as np

from shiplens.operators import boosting as bo
from shiplens.operators.boosting import MOST_ROWS, _node, _partitions


def test_places_in_a_level_by_brute_force():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 64, (5, 300)).astype(np.uint8)
    tree = (rng.integers(0, 5, 15), np.where(rng.random(15) < 0.2, 255, rng.integers(0, 64, 15)))
    for depth in range(5):
        want = []
        for row in bins.T:
            node = 0
            for _ in range(depth):
                node = 2 * node + 1 + int(row[tree[0][node]] > tree[1][node])
            want.append(node - (2 ** depth - 1))
        assert _node(bins, tree, depth).tolist() == want


def test_one_partition_a_core():
    """Passes are short: a task a core, more only where a partition would hold too many rows."""
    assert [_partitions(n, 12) for n in (0, 10, 16_000, 100_000, 3_600_000, 36_000_000, 216_000_000)] == [1, 1, 1, 7, 12, 24, 108]
    assert all(-(-n // _partitions(n, c)) <= MOST_ROWS for n in (1, 5_000_000, 99_000_001) for c in (1, 8, 12))


def test_small_chunks_are_joined(monkeypatch):
    """A pass has a cost for each block, so Arrow's batches of 10,000 rows are joined; no row is lost."""
    monkeypatch.setattr(bo, "BLOCK", 25)
    sizes, at, rows = [10, 10, 10, 25, 3, 22, 1], 0, []
    for n in sizes:
        x = np.arange(at, at + n)
        rows.append((pickle.dumps({"bins": np.stack([x, x + 1]), "valid": x % 2 == 0}),))
        at += n
    got = list(bo._blocks(iter(rows)))
    assert [len(c["valid"]) for c in got] == [20, 10, 25, 25, 1]
    assert np.concatenate([c["bins"][1] for c in got]).tolist() == list(range(1, at + 1))
    assert np.concatenate([c["valid"] for c in got]).tolist() == [i % 2 == 0 for i in range(at)]


def test_moves_add_up():
    """The trees since a partition was last kept give what one tree after the other gives."""
    rng = np.random.default_rng(3)
    c = {"bins": rng.integers(0, 64, (4, 200)).astype(np.uint8), "pred": rng.random((2, 200))}
    moves = [({i: (rng.integers(0, 4, 7), rng.integers(0, 64, 7)) for i in (0, 1)}, {i: rng.random(8) for i in who}) for who in ((0, 1), (1,), (0,))]
    want = c
    for m in moves:
        want = bo._moved(want, [m], 3)
    assert np.array_equal(bo._moved(c, moves, 3)["pred"], want["pred"]) and not np.array_equal(c["pred"], want["pred"])


def test_gradient_sums_are_exact():
    """Rows and gradients come from one sum, to the last row of a full block."""
    rng = np.random.default_rng(4)
    for sign in (rng.integers(-1, 2, bo.BLOCK), np.ones(bo.BLOCK, int), -np.ones(bo.BLOCK, int)):
        cell = rng.integers(0, 3, len(sign)) if sign.min() < sign.max() else np.zeros(len(sign), int)
        sums = np.bincount(cell, bo.WEIGHT[sign + 1], 3)
        n, up, down = (np.bincount(cell[k], minlength=3) for k in (sign < 2, sign > 0, sign < 0))
        for q in (None, 0.1, 0.9):
            want = up - down if q is None else (10 * q * up - round(10 - 10 * q) * down) / 10
            got = bo._unpacked(sums, q)
            assert np.allclose(got[0], want, rtol=1e-12, atol=1e-9) and got[1].tolist() == n.tolist()


def test_histograms_by_brute_force():
    """Sums by group, feature and bin, where pairs of features are counted at once (many rows) and where they are not."""
    rng = np.random.default_rng(5)
    for n, groups, picks in ((30_000, 1, [0, 2, 3]), (30_000, 4, [1, 2, 3, 4]), (300, 4, [0, 1, 4]), (0, 2, [1, 2])):
        bins = [rng.integers(0, bo.BINS, n).astype(np.uint8) for _ in range(5)]
        weight, group = bo.WEIGHT.take(rng.integers(0, 3, n)), rng.integers(0, groups, n).astype(np.uint8)
        some = np.flatnonzero(rng.random(n) < 0.5)
        for rows, args in ((np.arange(n), ()), (some, (some, group, groups))):
            want = np.zeros((groups if args else 1, len(picks), bo.BINS))
            for j, f in enumerate(picks):
                np.add.at(want, (group[rows] if args else 0, j, bins[f][rows]), weight[rows])
            assert np.array_equal(bo._histograms(bins, picks, weight, *args), want)


def test_places_in_slices(monkeypatch):
    """Slices of the rows, features as separate arrays, unsplit nodes: every row ends where its own splits send it."""
    monkeypatch.setattr(bo, "SLICE", 64)
    rng = np.random.default_rng(6)
    bins = [rng.integers(0, 64, 150).astype(np.uint8) for _ in range(3)]
    tree = rng.integers(0, 3, 15), np.where(rng.random(15) < 0.3, 255, rng.integers(0, 64, 15))
    want = []
    for row in zip(*bins):
        node = 0
        while node < 15:
            node = 2 * node + 1 + int(row[tree[0][node]] > tree[1][node])
        want.append(node - 15)
    assert _node(bins, tree, 4).tolist() == want and len(_node([b[:0] for b in bins], tree, 4)) == 0


def test_arranged_rows_draw_what_their_keys_say():
    """Drawn rows first, then other training rows, then those to judge by; a second bag draws from all training rows
    again, and pieces give back the chunk."""
    rng = np.random.default_rng(7)
    n, limit = 500, np.uint64(int(0.8 * 2 ** 53))
    x = np.arange(n)
    c = {"bins": np.stack([x % 64, x % 7]).astype(np.uint8), "valid": rng.random(n) < 0.2, "key": rng.integers(0, 2 ** 63, n).astype(np.uint64),
         "y": np.stack([x, -x]).astype(float), "pred": np.stack([x / 2])}
    for bag in (3, 4):
        inside = (bo._mixed(c["key"] ^ bo._mixed(np.array([bag], np.uint64))) >> np.uint64(11)) < limit
        got = bo._arranged(c if bag == 3 else got, bag, limit)
        d, t = got["drawn"], got["train"]
        row = got["y"][0].astype(int)
        assert sorted(row[:d]) == x[~c["valid"] & inside].tolist() and sorted(row[d:t]) == x[~c["valid"] & ~inside].tolist()
        assert row[t:].tolist() == x[c["valid"]].tolist()
        assert all(np.array_equal(a, b[row]) for k in ("bins", "y", "pred") for a, b in zip(got[k], c[k])) and np.array_equal(got["key"], c["key"][row])
    pieces = [*bo._pieces(got), *bo._pieces(got)]
    assert max(len(p) for k, p in pieces if k) == n and len(pieces) == 12
    back = list(bo._whole(iter(pieces)))
    assert len(back) == 2 and all(np.array_equal(b[k], got[k]) for b in back for k in got)


def test_bins_by_search_and_by_comparison():
    """A value equal to a cut is not above it, a missing one is above none; either way of counting."""
    rng = np.random.default_rng(8)
    v = np.where(rng.random(400) < 0.1, np.nan, rng.integers(0, 40, 400).astype(float))
    v[:2] = np.inf, -np.inf
    for n in (0, 1, bo.FEW_CUTS, bo.FEW_CUTS + 1, 40):
        cuts = np.sort(rng.choice(40, n, replace=False)).astype(float)
        assert bo._binned(v, cuts).tolist() == [int((cuts < x).sum()) for x in v]
