"""Near-duplicate embeddings against all pairs."""

import numpy as np
import pytest

from tessella.llm import embedding_dups as ED

SCHEMA = "vec_id long, label int, embedding array<{}>, n_links string, root int"


def expected(rows, threshold=ED.THRESHOLD):
    """Per row: links, smallest reachable vec_id, kept."""
    def vector(v):
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v, float) if ok else None
    vs = [vector(r[2]) for r in rows]
    near = [[] for _ in rows]
    for i, a in enumerate(vs):
        for j in range(i):
            b = vs[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][1] is not None and rows[i][1] == rows[j][1]:
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        comp = min(ids) if ids else None
        out.append((r[0], len(near[i]), comp, r[0] == comp))
    return sorted(out, key=repr)


def check(spark, rows, kind="float"):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA.format(kind))
    got = sorted((tuple(r) for r in ED.near_vectors(frame).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)
    assert got == expected(rows)


def cloud(rng, n, dim, labels=3):
    """Random vectors, some of them near or exact copies of earlier ones."""
    vs = []
    for _ in range(n):
        v = rng.standard_normal(dim)
        if vs and rng.random() < 0.5:
            v = vs[rng.integers(len(vs))] * rng.uniform(0.5, 2) + v * rng.choice([0, 0.03, 0.05, 0.3])
        vs.append(v)
    return [(i, int(rng.integers(labels)), np.float32(v).astype(float).tolist()) for i, v in enumerate(vs)]


@pytest.mark.parametrize(("kind", "dim"), [("float", 16), ("double", 5), ("float", 1)])
def test_links_match_all_pairs(spark, kind, dim):
    check(spark, cloud(np.random.default_rng(dim), 240, dim), kind)


def test_many_tiles_and_cuts(spark, monkeypatch):
    monkeypatch.setattr(ED, "TILE_ROWS", 32)
    monkeypatch.setattr(ED, "STRIP", 7)
    check(spark, cloud(np.random.default_rng(2), 500, 12, 2))


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, 0, one), (2, 0, one), (2, 0, one), (2, 1, one), (3, None, one), (4, 0, None), (5, 0, []), (6, 0, [0.0, 0.0, 0.0]), (7, 0, [1.0, None, 1.0]),
            (8, 0, [float("nan"), 1.0, 1.0]), (9, 0, [float("inf"), 1.0, 1.0]), (None, 0, one), (None, 5, one), (10, 0, [2.0, 4.0]), (11, 0, [1.0, 2.0]),
            (12, 2, [1e-30, 2e-30, 3e-30]), (13, 2, one), (0, 0, [2.0, 4.0, 6.0])]
    check(spark, rows)


def test_doubles_beyond_the_range_of_floats(spark):
    rows = [(1, 0, [1e100, 1e100]), (2, 0, [1.0, 1.0]), (3, 0, [1e-100, 1e-100]), (4, 0, [-1e100, 1e100])]
    check(spark, rows, "double")


def test_no_rows(spark):
    assert ED.near_vectors(spark.createDataFrame([], SCHEMA.format("float"))).count() == 0


def test_far_boxes_never_meet(spark, monkeypatch):
    """Two far groups in one label: no pair of tiles across them."""
    monkeypatch.setattr(ED, "TILE_ROWS", 64)
    rng = np.random.default_rng(9)
    a, b = np.zeros(8), np.zeros(8)
    a[0], b[1] = 1, 1
    rows = [(i, 0, (c + 0.01 * rng.standard_normal(8)).tolist()) for i, c in enumerate([a, b] * 200)]
    held = []
    pairs = ED.tile_pairs
    monkeypatch.setattr(ED, "tile_pairs", lambda t, x: held.append((t, x)) or pairs(t, x))
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = ED.near_vectors(frame).groupBy("component_id").count().collect()
    assert sorted(r["count"] for r in got) == [200, 200]
    tiles, n = held[0][0], held[0][0].count()
    assert n >= 6 and pairs(tiles, 0.93).count() <= n * (n + 1) // 2 - (n // 2 - 1) ** 2


def test_pairs_are_given_up_only_below_the_threshold():
    rng = np.random.default_rng(4)
    x = ED._unit(np.repeat(rng.standard_normal((60, 32)), 4, 0) + 0.25 * rng.standard_normal((240, 32)))
    t = (x @ ED.Axes(x).basis).astype(np.float32)
    found = {(int(i), int(j)) for a, b in ED.close_pairs(t, t, 0.93, upper=True) for i, j in zip(a, b, strict=True)}
    true = {(i, j) for i in range(240) for j in range(i + 1, 240) if x[i] @ x[j] >= 0.93}
    assert true and true <= found and len(found) <= len(true) + 3
