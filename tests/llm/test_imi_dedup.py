"""Links, components and the traversal against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from shelfwise.llm import imi_dedup as I


def brute(rows):
    whole = [k for k, (_, v, label) in enumerate(rows) if label is not None and v
             and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups, part, links = defaultdict(list), list(range(len(rows))), [0] * len(rows)

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for k in whole:
        groups[rows[k][2], len(rows[k][1])].append(k)
    for ks in groups.values():
        x = np.array([rows[k][1] for k in ks], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.98
        np.fill_diagonal(near, False)
        for a, k in enumerate(ks):
            links[k] = int(near[a].sum())
            for b in np.flatnonzero(near[a]):
                i, j = root(k), root(ks[b])
                part[max(i, j)] = min(i, j)
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        ids[root(k)].append(r[0])
    least = {c: min((i for i in x if i is not None), default=None) for c, x in ids.items()}
    return sorted(((r[0], links[k], None if r[0] is None else least[root(k)]) for k, r in enumerate(rows)), key=str)


def vectors():
    draw, rows = np.random.RandomState(2), []
    add = lambda v, label: rows.append((len(rows), [float(np.float32(x)) for x in v], label))
    for b in range(40):
        c = draw.randn(12)
        for _ in range(draw.choice([1, 2, 8, 25])):
            add((c + draw.randn(12) * draw.choice([0, .05, .1, .16])) * draw.choice([1, 3, .001]), int(b % 3))
    c = draw.randn(12)
    for _ in range(300):
        add(c + draw.randn(12) * .08, 1)
    for _ in range(100):
        add(c, 1)
    odd = [None, [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [1.0] * 5, [1.0] * 5, [], [1.0, None], [2.0], [3.0]]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(2000, [1.0] * 12, None), (None, [1.0] * 5, 1)]
    return rows


@pytest.mark.parametrize("tile", [1024, 16])
def test_links_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(I, "TILE", tile)
    monkeypatch.setattr(I, "VISITORS", 2 * tile)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, n int").repartition(3)
    out = I.link_vectors(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)


def test_empty_table(spark):
    assert I.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_bounds_and_traversal():
    draw = np.random.RandomState(1)
    x = I.unit(draw.randn(300, 8))
    halves = x[:, :4], x[:, 4:]
    books = [I.codebook(np.ascontiguousarray(h), 6, 5) for h in halves]
    owner = [I.nearest(h, b).argmin(1) for h, b in zip(halves, books)]
    radius = [np.array([max(np.linalg.norm(h[o == c] - b[c], axis=1), default=0) for c in range(len(b))])
              for h, b, o in zip(halves, books, owner)]
    low = [I.bounds(h, b, r) for h, b, r in zip(halves, books, radius)]
    for q in range(0, 300, 29):
        cells = list(I.traverse(low[0][q], low[1][q], 0.5))
        assert [c[0] for c in cells] == sorted(c[0] for c in cells)
        visited = {(i, j) for _, i, j in cells}
        near = np.flatnonzero(((x - x[q]) ** 2).sum(1) <= 0.5)
        assert all((owner[0][p], owner[1][p]) in visited for p in near)
