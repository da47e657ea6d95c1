import numpy as np
import pytest

from tidewatch.llm import embedding_dedup as ed


def brute(rows, threshold=0.93):
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    distinct = sorted({(i, tuple(v) if v is not None else None, label) for i, v, label in rows}, key=repr)
    links, name = [0] * len(distinct), list(range(len(distinct)))
    for a, (_, v, x) in enumerate(distinct):
        for b in range(a):
            _, w, y = distinct[b]
            if x == y and usable(v, x) and usable(w, y) and len(v) == len(w):
                p, q = np.array(v, np.float64), np.array(w, np.float64)
                if p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    one, two = name[a], name[b]
                    name = [min(one, two) if n in (one, two) else n for n in name]
    low = {}
    for (i, _, _), n in zip(distinct, name, strict=True):
        low[n] = min(low.get(n, i), i)
    return {(i, v): (k, low[n], i == low[n]) for (i, v, _), n, k in zip(distinct, name, links, strict=True)}


def cloud(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    spread = rng.choice([0.02, 0.1, 0.3, 1.0], n)
    x = centres[rng.integers(6, size=n)] + rng.normal(size=(n, dims)) * spread[:, None]
    return [(i, [float(v) for v in np.float32(row)], int(rng.integers(3))) for i, row in enumerate(x)]


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [None] + [1.0] * 15, 1), (904, [float("nan")] + [1.0] * 15, 1), (905, [float("inf")] + [1.0] * 15, 1),
    (906, [1.0] * 16, None), (907, [1.0] * 16, 1), (908, [2.0] * 16, 1), (909, [1.0] * 16, 2), (910, [1.0] * 15, 1), (907, [1.0] * 16, 1), (911, [-0.0] + [1.0] * 15, 1), (912, [0.0] + [1.0] * 15, 1),
    (913, [1.0] * 16, 1),
]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    return {(r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.similar(df, **options).collect()}


@pytest.mark.parametrize("cell_size", [2000, 20])
def test_against_brute_force(spark, cell_size):
    rows = [*cloud(300, 1), *ODD]
    expected = {(i, *x) for (i, _), x in brute(rows).items()}
    assert sum(x[1] for x in expected) > 500
    assert found(spark, rows, cell_size=cell_size) == expected


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(3000)] + [(5000, [1.0, 2.0, 3.01], 0), (5001, [3.0, -2.0, 1.0], 0)]
    got = {x[0]: x[1:] for x in found(spark, rows)}
    assert got[7] == (3000, 0, False) and got[0] == (3000, 0, True) and got[5000] == (3000, 0, False) and got[5001] == (0, 5001, True)


def test_close_pairs_at_every_scale():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=8) + rng.normal(size=(40, 8)) * s for s in (0.001, 0.05, 0.2, 1.0)])
    y = x[::3] + rng.normal(size=x[::3].shape) * 0.05
    for threshold in (0.5, 0.93, 0.999999, 1.0):
        cosine = ed.units(x) @ ed.units(x).T
        i, j = ed.close_pairs(x, None, threshold)
        near = {(a, b) for a, b in zip(*np.nonzero(np.triu(cosine, 1) >= threshold), strict=True)}
        assert {*zip(i.tolist(), j.tolist(), strict=True)} >= {p for p in near if cosine[p] > threshold + 1e-12}
        assert all(cosine[a, b] >= threshold - 1e-12 for a, b in zip(i, j, strict=True))
        i, j = ed.close_pairs(x, y, threshold)
        assert len(i) == (ed.units(x) @ ed.units(y).T >= threshold).sum()


def test_the_levels_are_nested():
    x = ed.units(np.random.default_rng(5).normal(size=(200, 4)))
    tree = ed.CoverTree(x, 0.1)
    radius = 2.0
    for (centres, _, _), (below, parents, covering) in zip(tree.levels, tree.levels[1:], strict=False):
        radius /= 2
        assert set(centres) <= set(below) and (np.linalg.norm(x[below] - x[centres[parents]], axis=1) <= 2 * radius + 1e-9).all()
        assert (covering <= radius + 1e-9).all()


def test_no_vectors(spark):
    assert found(spark, [ODD[0]]) == {(900, 0, 900, True)}
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ed.similar(df).collect() == []
