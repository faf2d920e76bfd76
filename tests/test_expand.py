"""Expansion against a plain breadth-first search, and its budget over batches."""

import random

import pytest

from provgraph.operators.expand import Expansion, closure


def _levels(edges, roots, depth=None):
    found = {r: 0 for r in roots}
    frontier = set(roots)
    level = 0
    while frontier and (depth is None or level < depth):
        level += 1
        frontier = {d for p, d in edges if p in frontier and d} - set(found)
        found |= dict.fromkeys(frontier, level)
    return found


@pytest.fixture(scope="module")
def graph(spark):
    rng = random.Random(1)
    edges = [(f"p{rng.randrange(120)}", f"p{rng.randrange(150)}") for _ in range(300)]  # cycles, and packages that state nothing
    edges += [edges[0], ("p1", None), (None, "p2"), ("p3", "p3")]
    return edges, spark.createDataFrame(edges, "purl string, dep string")


def _roots(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "purl string")


@pytest.mark.parametrize("depth", [None, 0, 2])
def test_levels_agree_with_a_plain_search(spark, graph, depth):
    edges, table = graph
    found, _ = closure(table, _roots(spark, "p5", "p5", "p9", None, "nobody"), depth)
    assert dict(map(tuple, found.collect())) == _levels([e for e in edges if e[0]], {"p5", "p9", "nobody"}, depth)


def test_one_budget_over_batches(spark, graph):
    edges, table = graph
    stating = {p for p, d in edges if p and d}
    bad = _roots(spark, "p7", "p11")
    run = Expansion(table, 40, bad, depth=2)
    batches, seen, used = (("p5", "p9"), ("p5", "p20", "p30", "p40", "p50"), ("p60",)), set(), 0
    for roots in batches:
        level = _levels([e for e in edges if e[0]], set(roots), 2)
        due = sorted(((n, p) for p, n in level.items() if p in stating and p not in seen))
        want = {p for _, p in due[: 40 - used]}
        got = run.expand(_roots(spark, *roots))
        assert {r["purl"] for r in got.documents.collect()} == want and (got.taken, got.overflow) == (len(want), len(due) - len(want))
        seen |= want
        used += len(want)
    assert (run.used, used, run.exhausted) == (40, 40, True) and run.overflow > 0
    assert {r["purl"] for r in run.skipped().collect()} == seen & {"p7", "p11"}
    stated = {(p, d) for p, d in edges if p in seen - {"p7", "p11"} and d}
    assert {tuple(r) for r in run.dependencies().collect()} == stated
    run.close()
    with pytest.raises(ValueError):
        Expansion(table, -1)


def test_odd_budgets(spark, graph):
    _, table = graph
    none = Expansion(table, 0)
    assert none.expand(_roots(spark, "p5")).taken == 0 and none.exhausted
    ample = Expansion(table, 10**6)
    assert ample.expand(_roots(spark)).taken == 0 and not ample.exhausted
    assert ample.expand(_roots(spark, "p5")).overflow == 0 and not ample.exhausted and ample.taken().count() == ample.used
