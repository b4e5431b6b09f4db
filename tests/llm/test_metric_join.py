import math

import numpy as np

from filmgraph.llm import metric_join as J
from tests.llm.test_common import brute_components


def frame(llm, rows):
    return llm.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(rows):
    ok = [i for i, (vid, v) in enumerate(rows) if vid is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    links = []
    for x, a in enumerate(ok):
        for b in ok[x + 1:]:
            u, w = (np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in (a, b))
            if len(u) == len(w) and u @ w / (np.linalg.norm(u) * np.linalg.norm(w)) >= 0.9:
                links.append((a, b))
    comp = brute_components(links)
    least = {}
    for i, r in comp.items():
        least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    degree = np.bincount(np.array(links, dtype=int).ravel(), minlength=len(rows))
    return sorted((vid, int(degree[i]), least[comp[i]] if i in comp else vid)
                  for i, (vid, _) in enumerate(rows) if vid is not None)


def got(df, join=None):
    return sorted((r["vec_id"], r["n_links"], r["component_id"])
                  for r in J.near_duplicates(df, join).collect() if r["vec_id"] is not None)


def test_clustered_and_random_vectors_in_many_cells(llm):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        if i % 3:
            v = rng.normal(size=6)
        else:
            v = np.eye(6)[i % 5] + rng.normal(0, 0.12, 6)
        rows.append((i, v.tolist()))
    rows += [(700 + i, rows[3][1]) for i in range(40)]
    df = frame(llm, rows)
    want = brute(rows)
    assert got(df) == want
    assert got(df, J.RangeJoin(members=40, pivots=16)) == want


def test_chain_over_cells(llm):
    rows = [(i, [math.cos(i * 0.3), math.sin(i * 0.3)]) for i in range(21)]
    assert got(frame(llm, rows), J.RangeJoin(members=2, pivots=8)) == brute(rows)


def test_unusable_vectors_and_ids(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]),
            (7, [1.0, 0.0]), (8, [1e-200, 0.0]), (9, [1e200, 1e199]), (10, [1.0, 0.0, 0.0]),
            (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0]), (12, [1.0, 0.0]),
            (12, [0.0, -1.0]), (13, [0.01, -1.0])]
    df = frame(llm, rows)
    assert got(df) == brute(rows)
    alone = [r for r in J.near_duplicates(df).collect() if r["vec_id"] is None]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in alone] == [(0, None, True)]


def test_empty_and_clashing_columns(llm):
    df = llm.createDataFrame([(1, [1.0], 5, "k")],
                             "vec_id long, embedding array<float>, n_links int, cls string")
    assert J.near_duplicates(df).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert J.near_duplicates(df).first()["kept"]
    assert J.near_duplicates(df.limit(0)).count() == 0


def test_cells_cover_every_pair_in_range():
    rng = np.random.default_rng(9)
    x = J.unit(list(rng.normal(size=(300, 3))))
    join = J.RangeJoin()
    pivots = x[:12]
    own, visits = J._cells(x, pivots, join)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert visits[b, own[a]].all() and visits.mean() < 0.9


def test_tiles_stripes_and_balls_on_clusters(llm):
    """Well separated clusters, a crowd of near vectors, loose ones; many blocks, stripes and cells."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(12, 40))
    rows = [centres[i % 12] + rng.normal(0, 0.15 * (i % 4), 40) for i in range(500)]
    rows += [rng.normal(size=40) for _ in range(100)]
    rows += [centres[0] * 3 + rng.normal(0, 0.01, 40) for _ in range(200)]
    rows = [(i, v.tolist()) for i, v in enumerate(rows)]
    df = frame(llm, rows).repartition(4)
    want = brute(rows)
    for join in (None, J.RangeJoin(members=50, pivots=64, stripe=2),
                 J.RangeJoin(members=200, pivots=5, stripe=1), J.RangeJoin(members=1000, pivots=1)):
        assert got(df, join) == want


def test_leading_components_never_drop_a_near_pair():
    rng = np.random.default_rng(3)
    for size in (20, 64, 200):
        x = J.unit(list(rng.normal(size=(400, size))))
        x = np.concatenate([x, J.unit(list(x[:200] + rng.normal(0, 0.5 / size ** 0.5, (200, size))))])
        basis, lead = J._basis(x, 0.9)
        none = np.zeros(0, dtype=int)
        layout = J.Layout(x[:1], none, none, none, none, 1, basis, lead)
        a = layout.leading(x)
        bound = a @ a.T >= np.float32(0.9 - layout.rounding())
        assert bound[x @ x.T >= 0.9].all()
        if lead < size:
            assert bound.mean() < 0.05
    assert any(J._basis(J.unit(list(rng.normal(size=(400, 64)))), 0.9)[1] == k for k in J.LEADING)


def test_blocks_hold_about_their_members_and_rows_few_copies(llm):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(3000, 16)).tolist())]
    join = J.RangeJoin(members=1500)
    classes = frame(llm, rows).selectExpr("vec_id AS cls", "1L AS copies", "embedding AS v")
    layout = J._laid_out(classes, 3000, 16, join)
    assert len(layout.entry_start) <= 4 and layout.stripes == 1
    dealt = J._dealt(classes, layout, join)
    assert dealt.filter("role = 0").count() == 3000
    assert dealt.count() <= 5 * 3000
    assert dealt.filter("role = 0").groupBy("tile").count().agg({"count": "max"}).first()[0] <= 1700
