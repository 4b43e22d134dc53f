"""E8 lattice near-dedup against brute force."""
import math

import numpy as np
import pytest

from hirelake.llm import lattice


def brute(rows, least=0.98):
    """rows of (id, vector, label) -> sorted (id, n_links, component_id, kept)."""
    n = len(rows)
    ok = [v is not None and len(v) > 0 and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    near = [set() for _ in rows]
    for a in range(n):
        for b in range(a + 1, n):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y >= least * math.sqrt(x @ x) * math.sqrt(y @ y):
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        head = min(ids) if ids else None
        out.append((rows[a][0], len(near[a]), head, rows[a][0] == head))
    return sorted(out, key=str)


def got(spark, rows, ddl="vec_id bigint, embedding array<double>, label int", **more):
    df = lattice.near_vectors(spark.createDataFrame(rows, ddl), **more)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def near_copies(rng, dim, n, spread):
    centre = rng.normal(size=dim)
    return [(centre + rng.normal(size=dim) * spread).tolist() for _ in range(n)]


def test_decoding_is_the_nearest_lattice_point():
    rng = np.random.default_rng(0)
    roots = lattice.e8_roots()
    around = np.concatenate((roots, lattice.e8_second(roots)))
    assert len(roots) == 240 and len(around) == 2400
    x = rng.normal(size=(500, 8)) * 3
    p = lattice.e8_decode(x)
    assert np.all(np.isin(np.mod(p, 1), (0, 0.5))) and np.all(p.sum(axis=1) % 2 == 0)
    best = (((x - p)[:, None] - around[None]) ** 2).sum(axis=2).min(axis=1)
    assert np.all(((x - p) ** 2).sum(axis=1) <= best + 1e-9)


def test_asked_cells_are_those_within_the_margin():
    rng = np.random.default_rng(1)
    h = lattice.Hasher(64, 1, 0.35, 0.2)
    x = rng.normal(size=(50, 8)) * 2
    factors = h.factors[0, 0]
    own, row, key, gap = h._around(x, factors)
    assert np.array_equal(own, h.keys(lattice.e8_decode(x), factors))
    asked = {(r, k) for r, k in zip(row.tolist(), key.tolist())}
    for _ in range(400):  # whatever lies nearer than the margin falls into an own or asked cell
        step = rng.normal(size=x.shape)
        moved = h.keys(lattice.e8_decode(x + step / np.linalg.norm(step, axis=1)[:, None] * 0.199), factors)
        assert all(o == m or (r, m) in asked for r, (o, m) in enumerate(zip(own.tolist(), moved.tolist())))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    h = lattice.Hasher(64, lattice.TABLES, lattice.CELL, lattice.MARGIN)
    for cos, floor in ((0.98, 0.995), (0.985, 0.998), (0.99, 1.0)):
        y, met = cos * x + math.sqrt(1 - cos * cos) * z, np.zeros(len(x), bool)
        for t in range(lattice.TABLES):
            (a, ar, ak), (b, br, bk) = h.cells(x, t), h.cells(y, t)
            met |= a == b
            met[ar[ak == b[ar]]] = True
            met[br[bk == a[br]]] = True
        assert met.mean() >= floor


def test_components_and_link_counts(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).tolist(), i % 3) for i in range(150)]
    for size, spread in ((2, 0.01), (40, 0.05), (60, 0.1), (30, 0.13)):
        rows += [(1000 + len(rows) + k, v, 1) for k, v in enumerate(near_copies(rng, 64, size, spread))]
    rows += [(5000 + k, rows[0][1], 0) for k in range(30)] + [(6000, rows[0][1], 1)]
    want = brute(rows)
    assert any(0 < r[1] < 29 for r in want)
    assert got(spark, rows) == want


def test_tiles_of_one_component(spark, monkeypatch):
    monkeypatch.setattr(lattice, "TILE", 8)
    rng = np.random.default_rng(4)
    rows = [(k, v, 0) for k, v in enumerate(near_copies(rng, 16, 70, 0.08))]
    rows += [(100 + k, rng.normal(size=16).tolist(), 0) for k in range(30)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (None, v, 0), (3, v, None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [nan, 1.0, 1.0], 0),
            (7, [inf, 1.0, 1.0], 0), (8, [None, 1.0, 1.0], 0), (9, [], 0), (10, [], 0), (11, [1.0, 2.0, 3.0, 0.0], 0), (12, [-1.0, -2.0, -3.0], 0),
            (13, [1e200, 2e200, 3e200], 0), (14, [1e-200, 2e-200, 3e-200], 0), (None, None, None), (None, [9.0, 0.0, 1.0], 1), (15, [0.0, -0.0, 4.0], 2),
            (16, [0.0, 0.0, 4.0], 2), (17, [5.0], 2), (18, [6.0], 2)]
    assert got(spark, rows) == brute(rows)
    rows = [(a, b, c, "x", 1.5) for a, b, c in rows]
    assert got(spark, rows, "vec_id bigint, embedding array<double>, label int, n_links string, cls double") == brute([r[:3] for r in rows])
    named = [(str(a), b, str(c)) for a, b, c, *_ in rows[:3]]
    assert got(spark, named, "vec_id string, embedding array<float>, label string") == brute(named)
    assert got(spark, []) == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_brute_force(spark, sf):
    t = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    df = lattice.op13_lattice(spark, f"/root/testdata/{sf}")
    assert sorted([tuple(r) for r in df.collect()], key=str) == brute([tuple(r) for r in t])
