"""Codes against a plain Lloyd loop in Python integers and against SQL; moves add up to whole sums."""

import hashlib

import duckdb
import numpy as np
import pytest

from provgraph.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def _plain(rows, parts=8, entries=16, rounds=6):
    """Every round from all rows, by Python integers."""
    kept = [(i, [int(np.floor(4096.0 * x)) for x in np.array(e, np.float32).astype(float)], lab) for i, e, lab in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    wide = max((len(v) for _, v, _ in kept), default=0)
    w = max(1, -(-wide // parts))
    kept = [(i, v + [0] * (parts * w - len(v)), lab) for i, v, lab in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w : p * w + w] for _, v, _ in order] for p in range(parts)]

    def nearest(v, p):
        x = v[p * w : p * w + w]
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p * w : p * w + w] for (_, v, _), a in zip(kept, at, strict=True) if a[p] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [(i, [nearest(v, p) for p in range(parts)], lab) for i, v, lab in kept]
    total = {}
    for _, d, lab in found:
        total[lab] = total.get(lab, 0) + sum(x for x, _ in d)
    digest = hashlib.sha256(",".join(str(x) for part in books for c in part for x in c).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in d), sum(x for x, _ in d), total[lab], digest) for i, d, lab in found), key=repr)


def _rows(seed, n=120, wide=16):
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(size=(n, wide)) * 2) / 4  # many ties
    rows = [(int(i), [float(x) for x in v], [None, 1, 2][i % 3]) for i, v in enumerate(vectors)]
    rows[3:3] = [(200, None, 1), (201, [None] + [0.5] * (wide - 1), 1), (202, [float("nan")] + [0.0] * (wide - 1), 2), (203, [float("-inf")] * wide, 2), (None, [0.25] * wide, 1), rows[5], rows[5]]
    return rows


def _table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(2))
def test_codes_agree_with_plain_rounds(spark, seed):
    rows = _rows(seed)
    got = sorted(map(tuple, vc.vector_codes(_table(spark, rows).repartition(5)).collect()), key=repr)
    assert got == _plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, [], 0), (2, [0.5], 0), (2, [0.5], None)], [(k, [1.0, 2.0, float(k)] * 3, 5) for k in range(5)], [(-k, [-0.001 * k] * (k % 11), k % 2) for k in range(40)]])
def test_odd_tables(spark, rows):
    got = sorted(map(tuple, vc.vector_codes(_table(spark, rows)).collect()), key=repr)
    assert got == _plain(rows)


def test_codes_agree_with_sql(spark):
    rows = [r for r in _rows(5, wide=64, n=80) if r[0] is not None and r != _rows(5, wide=64, n=80)[5]]
    rows = list({r[0]: r for r in rows}.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    found = vc.vector_codes(_table(spark, rows))
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({vc.oracle_sql()})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_moves_keep_the_sums():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (300, 16))
    before, after = rng.integers(0, 4, (2, 300, 4)).astype(np.uint8)
    whole = lambda codes, p, e: x[codes[:, p] == e, 4 * p : 4 * p + 4].sum(0)
    moves = {(m["part"], m["entry"]): m for m in vc.contributions(x, before, after, 4)}
    for p in range(4):
        for e in range(4):
            m = moves.get((p, e), {"n": 0, "sums": [0] * 4})
            assert (whole(before, p, e) + m["sums"]).tolist() == whole(after, p, e).tolist()
            assert m["n"] == (after[:, p] == e).sum() - (before[:, p] == e).sum()
    assert vc.contributions(x, after, after, 4) == []  # nothing moved, nothing is shuffled


def test_only_the_result_stays_stored(spark):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    known = set(folder.iterdir())
    rows = vc.vector_codes(_table(spark, _rows(2)))
    assert sorted(p.name.split("-")[0] for p in set(folder.iterdir()) - known) == ["codes", "errors"]
    assert rows.count() == 123


def test_large_components_and_decoding():
    books = vc.Codebooks(np.array([[[2**24, -(2**24)], [0, 0]]]))
    x = np.array([[-(2**24), 2**24], [2**24, -(2**24)]])
    codes, errors = books.assign(x)
    assert codes.ravel().tolist() == [1, 0] and errors.ravel().tolist() == [2**49, 0]
    assert books.decode("00") == [4096.0, -4096.0]
