import random

import pytest

from rillstone.operators import hierarchy as H
from rillstone.operators import network
from rillstone.plans import data_quality


def brute(rows):
    nodes = {i for i, _ in rows if i is not None}
    down = {n: set() for n in nodes}
    for i, ups in rows:
        for u in ups or []:
            if u in nodes and i is not None:
                down[u].add(i)
    far = {}
    for n in nodes:
        d, todo = {n: 0}, [n]
        for x in todo:
            for y in down[x]:
                if y not in d:
                    d[y] = d[x] + 1
                    todo.append(y)
        far[n] = d
    named = {u for ups in ([*(u for u in nodes if i in down[u])] for i in nodes) for u in ups}
    roots = {n for n in nodes if not down[n]}
    del named
    paths = {(n, r, far[n][r]) for n in nodes for r in roots if r in far[n]}
    cyc = set()
    for n in nodes:
        part = {m for m in far[n] if n in far[m]}
        if len(part) > 1 or n in down[n]:
            cyc.add((n, min(part), len(part)))
    return nodes, down, far, paths, cyc


def table(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1) for i, u in rows], "id long, upstream_ids array<long>, top string, size int")


CASES = {
    "chain": [(1, []), (2, [1]), (3, [2]), (4, [3])],
    "diamond": [(1, None), (2, [1]), (3, [1]), (4, [2, 3, 3, None, 0, 99])],
    "ring with tail": [(1, [3]), (2, [1]), (3, [2]), (9, []), (2, [9])],
    "own entry": [(1, [1]), (2, [1, 2]), (3, [2]), (None, [1])],
    "cycle through a branch": [(1, [3]), (2, [1]), (3, [2]), (4, [2]), (5, [4])],
}


def together():
    """All cases as parts of one graph, that don't touch: ids of each in a hundred of their own."""
    move = lambda i, k: i and i + 100 * k
    return [(move(i, k), ups and [move(u, k) for u in ups]) for k, rows in enumerate(CASES.values()) for i, ups in rows]


def test_cases(spark):
    check(spark, together())


def test_random(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(i + 1, 70) for _ in range(rng.choice([0, 1, 1, 2]))] if i < 60 else []) for i in range(1, 70)]
    rows += [(rng.randrange(1, 70), [rng.randrange(1, 70)]) for _ in range(6)] + rows[:5]
    check(spark, rows)


def check(spark, rows):
    nodes, down, far, paths, cyc = brute(rows)
    h = H.build(table(spark, rows))
    assert {tuple(r) for r in H.outlets(h).collect()} == paths
    assert {tuple(r) for r in H.cycles(h).collect()} == cyc
    bad = {c for c, _, _ in cyc}
    assert {r.id for r in network.blocked(h).collect()} == {m for n in bad for m in far[n]}
    a = {r.id: r for r in h.atoms.collect()}
    assert set(a) == nodes
    for r in a.values():
        if r.top is not None:
            inside = {x.id for x in a.values() if x.top == r.top and r.lft <= x.lft <= r.rgt}
            assert len(inside) == r.size and r.id in inside
            assert all(x == r.id or len(down[x] - {x}) == 1 for x in inside)
    up = {(n, m) for n in nodes for m in nodes if n in far[m]}
    got = [(r.query_id, r.id) for r in network.upstream(h, h.atoms.select("id")).collect()]
    assert len(got) == len(set(got)) and set(got) == up
    totals = {r.query_id: (r.n_atoms, int(r.total)) for r in network.upstream_totals(h, h.atoms.select("id"), h.atoms.selectExpr("id", "id as v"), "v").collect()}
    assert totals == {n: (sum(q == n for q, _ in up), sum(m for q, m in up if q == n)) for n in nodes}
    found = {(r.atom_id, r.root_id): r for r in H.paths(h, h.atoms.select("id")).collect()}
    assert {(q, r, x.steps) for (q, r), x in found.items()} == paths
    for (q, r), x in found.items():
        step = q
        for k, y in enumerate(x.path):
            assert y == step
            left = far[y][r]
            step = min((z for z in down[y] if far[z].get(r) == left - 1), default=None)
        assert step is None and len(x.path) == x.steps + 1


def test_empty(spark):
    h = H.build(table(spark, [(1, [])]).limit(0))
    assert H.outlets(h).count() == 0 and H.cycles(h).count() == 0


@pytest.mark.parametrize("case", ["together", "random"])
def test_all_above_and_below(spark, tmp_path, case):
    """The queries' whole answer, through branches and round rings; ids are multiples of 50, so every atom is queried."""
    rng = random.Random(5)
    rows = together() if case == "together" else [(i, [rng.randrange(1, 40) for _ in range(rng.choice([0, 1, 1, 2]))]) for i in range(1, 40)]
    rows = [(i and 50 * i, ups and [u and 50 * u for u in ups]) for i, ups in rows]
    table(spark, rows).write.parquet(f"{tmp_path}/graph_arrow.parquet")
    nodes, _, far, _, _ = brute(rows)
    up = [(r.query_id, r.id) for r in data_quality.p5_descendants(spark, str(tmp_path)).collect()]
    assert len(up) == len(set(up)) and set(up) == {(n, m) for n in nodes for m in nodes if n in far[m] and n != m}
    down = [(r.query_id, r.id) for r in data_quality.p5_way_down(spark, str(tmp_path)).collect()]
    assert len(down) == len(set(down)) and set(down) == {(n, m) for n in nodes for m in far[n]}
