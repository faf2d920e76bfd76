"""Top-k against all products in Python integers and against SQL; bounds hold, and prune where they can."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from provgraph.llm import block_topk as bt

SCHEMA = "vec_id long, embedding array<float>, label int, block string, v int, rank int"
FIFTIETH = "vec_id % 50 = 0"


def _plain(rows, k=5):
    kept = [(i, [int(np.floor(256.0 * x)) for x in np.array(e, np.float32).astype(float)]) for i, e in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    found = []
    for a, (i, x) in enumerate(kept):
        if i is not None and i % 50 == 0:
            scores = [(-sum(p * q for p, q in zip(x, y, strict=False)), j is None, j) for b, (j, y) in enumerate(kept) if a != b]
            found += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(sorted(scores, key=lambda t: (t[0], t[1], t[2] or 0))[:k])]
    return sorted(found, key=repr)


def _got(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "clash", 2, 3) for r in rows], SCHEMA)
    return sorted(map(tuple, bt.top_k(table.repartition(3), F.expr(FIFTIETH), **options).collect()), key=repr)


def _rows(seed, n=700, wide=8):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(n, wide)) * 2) / 256)]


@pytest.mark.parametrize("seed", range(2))
def test_results_agree_with_all_products(spark, seed):
    rows = _rows(seed)  # components of a few whole numbers: many ties
    rows += [(1000, None), (1050, [None, 1.0]), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8), (None, rows[50][1]), (None, [1.0] * 8), rows[100], rows[100], (1200, []), (1250, [0.5]), (-50, [1.0] * 12)]
    assert _got(spark, rows) == _plain(rows)


@pytest.mark.parametrize("rows", [[], [(50, None)], [(50, [1.0])], [(0, [1.0]), (1, [-1.0])], [(50 * k, [0.5, 0.5]) for k in range(9)], [(7, [1.0]), (8, [2.0])], [(0, []), (0, [])]])
def test_odd_tables(spark, rows):
    assert _got(spark, rows) == _plain(rows)


def test_many_batches_and_packs(spark, monkeypatch):
    monkeypatch.setattr(bt, "BATCH", 3)
    monkeypatch.setattr(bt, "PACK", 2)
    rows = _rows(4)
    assert _got(spark, rows, k=3) == _plain(rows, 3)


def test_results_agree_with_sql(spark):
    rows = _rows(8, n=400, wide=16)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, 0)", rows)
    want = con.sql(f"SELECT query_id, rank, vec_id, score FROM ({bt.ORACLE_SQL})").fetchall()
    assert _got(spark, rows) == sorted(want, key=repr)


def _blocks(rng, near):
    """Blocks of rows about a centre each, queries near some centres."""
    centres = rng.integers(-300, 300, (12, 16))
    blocks = [(b, np.arange(40) + 40 * b, c + rng.integers(-near, near + 1, (40, 16))) for b, c in enumerate(centres)]
    queries = centres[rng.integers(0, 12, 30)] + rng.integers(-near, near + 1, (30, 16))
    bound = bt.bounds(queries, np.stack([x.max(0) for *_, x in blocks]), np.stack([x.min(0) for *_, x in blocks]))
    return blocks, queries, bound


@pytest.mark.parametrize("near", [5, 40, 600])
def test_bounds_hold_and_prune(near):
    rng = np.random.default_rng(near)
    blocks, queries, bound = _blocks(rng, near)
    for b, (_, _, x) in enumerate(blocks):
        assert (queries @ x.T <= bound[:, b, None]).all()
    q, b = (x.ravel() for x in np.indices(bound.shape))
    best, scored = bt.visit(queries, [(-1, 0)] * 30, np.full(30, bt.LOWEST), (q, b, bound.ravel()), blocks, 5)
    every = queries @ np.concatenate([x for *_, x in blocks]).T
    for i in range(30):
        want = sorted((-s, j) for j, s in enumerate(every[i].tolist()))[:5]
        assert list(zip((-best.scores[i]).tolist(), best.ids[i].tolist(), strict=True)) == want
    assert scored <= (0.3 if near == 5 else 1.0) * bound.size


def test_large_components_are_exact():
    a = np.array([[2**24, -(2**24), 3], [1, 2, 3]])
    assert bt.products(a, a).tolist() == [[2**49 + 9, 2**24 - 2**25 + 9], [2**24 - 2**25 + 9, 14]]
