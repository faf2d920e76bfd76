"""Near duplicates in dense groups: no link is lost, degrees are exact, and the number of runs counts every miss."""

from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from provgraph.llm import chosen_path


def _rows(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in chosen_path.near_duplicates(docs).collect()}


def _changed(words, places, mark):
    return [f"{mark}x{i}" if i in places else w for i, w in enumerate(words)]


def _sets(texts):
    return [set(chosen_path.shingles(chosen_path.words_list(t)).tolist()) for t in texts]


def _linked(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def test_chains_at_a_dense_group_stay_whole(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(_changed(base, {i}, f"p{i}")) for i in range(40)]
    for i in range(60):  # C is near the group, D near C only
        c = _changed(base, {40, 41, 42, 43 + i % 50}, f"c{i}")
        texts += [" ".join(c), " ".join(_changed(c, {150, 160, 170}, f"d{i}"))]
    sets = _sets(texts)
    assert all(_linked(sets[c], sets[c + 1]) and not any(_linked(sets[c + 1], s) for s in sets[:40]) for c in range(40, 160, 2))
    got = _rows(spark, texts)
    assert {r["class_id"] for r in got.values()} == {0}


@pytest.mark.parametrize("blocks", [False, True])
def test_degrees_in_a_dense_group_are_exact(spark, monkeypatch, blocks):
    if blocks:  # as in groups of many blocks; with spark's workers the constants of the driver only deal the blocks
        monkeypatch.setattr(chosen_path, "TEXTS", 16)
        monkeypatch.setattr(chosen_path, "SKETCHES", 32)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(_changed(base, set(rng.integers(0, 200, rng.integers(1, 4)).tolist()), f"t{i}")) for i in range(120)]
    texts += texts[:3] + ["alone in the world of texts here"]
    sets = _sets(texts[:120])
    want = [sum(_linked(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]
    assert max(want) > 16 and len(set(want)) > 5
    got = _rows(spark, texts)
    assert [got[i]["n_links"] for i in range(124)] == [*want, *want[:3], 0]


def test_common_shingles_agree_with_sets(monkeypatch):
    monkeypatch.setattr(chosen_path, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    draw = lambda n: [np.unique(rng.integers(0, 60, 25).astype(np.uint64)) for _ in range(n)]
    a, b = draw(9), draw(5)
    assert chosen_path._common(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
    assert chosen_path._common(a, [np.array([99], np.uint64)]).sum() == 0


def test_runs_count_every_miss():
    n, p = chosen_path.SKETCH, chosen_path.THRESHOLD
    chance = [comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
    least = chosen_path.likely_from()
    assert sum(chance[:least]) <= 0.001 < sum(chance[: least + 1])
    miss = sum(chance[:least]) + sum(c * (1 - chosen_path.survival(k / n, chosen_path.DEPTH)) ** chosen_path.runs_for() for k, c in enumerate(chance) if k >= least)
    assert miss <= 1 - chosen_path.RECALL


def test_siblings_in_a_dense_group_are_found(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(150):  # families lie at about 0.75, the two of a family at about 0.81
        family = _changed(base, set(rng.choice(200, 3, replace=False).tolist()), f"f{k}")
        texts += [" ".join(family), " ".join(_changed(family, set(rng.choice(200, 4, replace=False).tolist()), f"s{k}"))]
    sets = _sets(texts)
    want = [(i, j) for i in range(300) for j in range(i) if _linked(sets[i], sets[j])]
    degree = [sum(i in pair for pair in want) for i in range(300)]
    got = _rows(spark, texts)
    assert sum(got[i]["class_id"] == got[j]["class_id"] for i, j in want) >= 0.99 * len(want) > 0
    assert sum(got[i]["n_links"] for i in range(300)) >= 0.99 * sum(degree)


def test_one_row_of_each_class_stays(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(5, text("p"), "x"), (5, text("q"), "x"), (3, text("q"), "y"), (7, text("z"), "x"), (7, text("z"), "x"), (None, text("n"), "x"), (None, text("z") + " end", "x"), (8, "", "x"), (9, None, "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    got = sorted(((r["doc_id"], r["text"]) for r in chosen_path.deduplicated(docs).collect()), key=repr)
    assert got == sorted([(5, text("p")), (3, text("q")), (7, text("z")), (None, text("n")), (8, ""), (9, None), (None, None)], key=repr)
    assert chosen_path.deduplicated(docs.limit(0)).collect() == []
    big = 2**62 + 1  # ids pass through unharmed beside nulls
    assert {r["doc_id"] for r in chosen_path.near_duplicates(spark.createDataFrame([(big, "a b"), (None, "c")], "doc_id long, text string")).collect()} == {big, None}


def test_unmet_targets_are_refused():
    assert chosen_path.runs_for() == 18 and chosen_path.likely_from() == 18
    for threshold in (0.6, 0.5):
        with pytest.raises(ValueError, match="coordinates find less"):
            chosen_path.runs_for(threshold)
    assert chosen_path.runs_for(0.95) < chosen_path.runs_for(0.85) < 18
    sure, extra = chosen_path.children(0.7)
    assert sure == 2 and 0.9 < extra < 1  # as many children as pairs at the threshold need


def test_rows_without_an_id_do_not_meet(spark):
    """5,000 rows that share a missing id: work in proportion to the rows, and the links of rows with ids."""
    rng = np.random.default_rng(4)
    base = [[f"b{k}x{i}" for i in range(60)] for k in range(25)]
    texts = [" ".join(_changed(base[i % 25], {int(rng.integers(0, 60))} if i % 2 else set(), f"t{i}")) for i in range(5000)]
    known = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    without = known.select(F.lit(None).cast("long").alias("doc_id"), "text")
    joined = []
    plain = chosen_path._verified

    def watched(pairs, rows, docs, threshold):
        joined.append(docs.join(rows.select(*chosen_path.KEY), [*chosen_path.KEY]).count())
        return plain(pairs, rows, docs, threshold)

    chosen_path._verified = watched
    try:
        tally = lambda docs: sorted(map(tuple, chosen_path.near_duplicates(docs).groupBy("class_size", "n_copies", "n_links").count().collect()))
        assert tally(without) == tally(known)
    finally:
        chosen_path._verified = plain
    assert max(joined) <= 2 * len(texts)
