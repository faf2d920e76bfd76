"""The language model: words and counts against plain Python, probabilities that sum to 1, gradients that are right on average, and a gain on held-out texts."""

import re
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from provgraph.llm import common, maxent

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text):
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbZ é漢😀\n\t\x0b.", max_size=40), min_size=1, max_size=4))
def test_words_agree_with_plain_python(texts):
    words, want = maxent.words_in(texts), [_plain(t) for t in texts]
    assert words.sizes.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    key, leaf = {}, {}
    for w, k, x in zip(flat, words.keys.tolist(), words.leaves.tolist(), strict=True):
        assert key.setdefault(w, k) == k
        assert leaf.setdefault(w.decode("utf-8", "surrogatepass")[-2:], x // maxent.PARTS) == x // maxent.PARTS
    assert len(set(key.values())) == len(key)


def test_probabilities_of_all_words_sum_to_one():
    """P(word | history) over the end, all known words and the place for unknown words of every part."""
    rng = np.random.default_rng(0)
    rows = 1 << maxent.LEAST_BITS
    vocabulary = [f"w{i}x{i % 7}" for i in range(400)]
    words = maxent.words_in([" ".join(vocabulary)])
    n = np.sort(rng.integers(1, 50, 400))[::-1]
    heads, end = 5, 3
    size = np.ones(maxent.LEAVES)
    np.add.at(size, words.leaves[heads:], n[heads:] + 1)
    weights = tuple(rng.normal(size=(rows, c)).astype(np.float32) for c in (maxent.CLASSES, maxent.PARTS))
    model = maxent.Model(words.keys, np.log10(n + 1), heads, weights, np.log10(size), end)
    known = maxent.Known(words.keys)
    texts = [f"w3x3 w9x2 {w}" for w in vocabulary] + ["w3x3 w9x2"]
    t, logs, factors = model.token_logs(texts, known)
    last = np.concatenate([np.flatnonzero(np.diff(t.owner)) - 1, [len(t.owner) - 1]])  # the third word; the end of the last text
    total = (10 ** (logs[last] + factors[last])).sum()
    # Unknown words: one place in each part, of which a model sees one word at least.
    spare = [f"{a}{b}{i}" for i in range(40) for a in "qz" for b in "abcdefghijklmnopqrstuvwxyz"]
    leaves = maxent.words_in([" ".join(spare)]).leaves
    first = {x: w for w, x in zip(spare, leaves.tolist(), strict=True)}
    missing = 0.0
    base = maxent.batch_tokens(["w3x3 w9x2 zz"], known, heads, rows)
    row = base.first[:, 2:3]
    mass = np.exp(maxent.raw_scores(weights[0], row))[0]
    chance = mass / mass.sum()
    for leaf in range((1 + maxent.HEADS) * maxent.PARTS, maxent.LEAVES):
        c, part = divmod(leaf, maxent.PARTS)
        if leaf in first:
            t, logs, factors = model.token_logs([f"w3x3 w9x2 {first[leaf]}"], known)
            assert np.isnan(logs[2])
            missing += 10 ** factors[2]
        else:
            h = maxent.words_in(["w3x3 w9x2"]).keys[::-1]
            code = np.array([c], np.uint64)
            feats = np.stack([np.array([c]), *(maxent._mixed(rows, maxent.CLASSES, s, code, *x) for s, x in ((6, (h[:1],)), (7, (h[:1], h[1:])), (8, (h[1:],))))])
            inner = np.exp(maxent.raw_scores(weights[1], feats))[0]
            missing += chance[c] * inner[part] / inner.sum() / size[leaf]
    unused = chance[1 + heads : 1 + maxent.HEADS].sum()  # heads that this small vocabulary doesn't have
    assert np.isclose(total + missing + unused, 1, atol=1e-3)


def test_drawn_gradients_are_right_on_average():
    rng = np.random.default_rng(4)
    mass = np.exp(rng.normal(size=(1, 64)).astype(np.float32) * 2)
    drawn = maxent.drawn_classes(np.repeat(mass, 200_000, axis=0), np.random.default_rng(1))
    assert np.allclose(np.bincount(drawn, minlength=64) / 200_000, mass[0] / mass.sum(), atol=4e-3)


def test_held_out_texts_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = maxent.score(docs, ~held).join(docs.where(held).select("doc_id"), "doc_id").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    counts = {r["key"]: r["n"] for r in maxent.count_words(docs).collect()}
    want = Counter(w for r in docs.collect() for w in _plain(r["text"]))
    assert sorted(counts.values()) == sorted([*want.values(), docs.count()]) and counts[maxent.END] == docs.count()


def _plain_classes(mass, draws):
    n, rows = len(mass), np.arange(len(mass))
    groups = mass.reshape(n, -1, maxent.GROUP)
    before = np.cumsum(groups @ np.ones(maxent.GROUP, np.float32), axis=1)
    at = draws.random(n, np.float32) * before[:, -1]
    group = np.minimum((before <= at[:, None]).sum(1), groups.shape[1] - 1)
    inner = np.cumsum(groups[rows, group], axis=1)
    at = draws.random(n, np.float32) * inner[:, -1]
    return group * maxent.GROUP + np.minimum((inner <= at[:, None]).sum(1), maxent.GROUP - 1)


def _plain_steps(weights, squares, draws, feats, target):
    """The steps of `Descent.over`, written plainly: a row of the batch after the other in memory, one draw after the other."""
    flat, classes = weights.reshape(-1), weights.shape[1]
    for i in range(0, len(target), maxent.STEP):
        f, y = feats[:, i : i + maxent.STEP], target[i : i + maxent.STEP]
        z = weights[f[0]]
        for x in f[1:]:
            z += weights[x]
        mass = np.exp(np.minimum(z, np.float32(80)))
        cells, parts = [y], [mass[np.arange(len(y)), y] / (mass @ np.ones(classes, np.float32) + np.float32(1e-30)) - 1]
        for _ in range(maxent.DRAWS):
            cells.append(_plain_classes(mass, draws))
            parts.append((cells[-1] != y).astype(np.float32) / maxent.DRAWS)
        at = (f[1:, None, :] * classes + np.stack(cells)).ravel()
        np.add.at(squares, at, np.tile(np.stack(parts).astype(np.complex64).ravel(), len(f) - 1))
        found = squares[at]
        gradient = found.real
        square = found.imag + gradient * gradient
        flat[at] -= np.float32(maxent.RATE) * gradient / np.sqrt(square)
        found.real, found.imag = 0, square
        squares[at] = found


def test_steps_equal_plain_ones_in_less_time():
    rng = np.random.default_rng(7)
    rows, n = 1 << maxent.LEAST_BITS, 20 * maxent.STEP + 5
    start = rng.normal(size=(rows, maxent.CLASSES)).astype(np.float32) * np.float32(0.3)
    start[5, 3] = 200  # above what exponentials hold
    feats = np.concatenate([np.zeros((1, n), np.int64), np.minimum(rng.zipf(1.3, (5, n)), rows - 1)])
    target = rng.integers(0, maxent.CLASSES, n)
    spent, plain = [], []
    for _ in range(5):
        descent = maxent.Descent(start.copy())
        begun = time.process_time()
        descent.over(feats, target)
        spent.append(time.process_time() - begun)
        weights, squares = start.copy(), np.full(start.size, 1e-2j, np.complex64)
        begun = time.process_time()
        _plain_steps(weights, squares, np.random.default_rng(20), feats, target)
        plain.append(time.process_time() - begun)
    assert np.isfinite(descent.weights).all() and not np.array_equal(descent.weights, start)
    # A sum may round another way on another machine, which can turn a draw at its border.
    assert np.isclose(descent.weights, weights, rtol=1e-4, atol=1e-5).mean() > 0.999
    assert min(spent) < 0.8 * min(plain)


def test_words_keep_their_keys_anywhere_in_a_text():
    """Running sums are taken over parts: words beside their borders and words longer than a part."""
    few = ["a", "é", "word", "漢字", "😀x", "y" * 300, "z" * 100_000]
    rng = np.random.default_rng(3)
    order = np.minimum(rng.geometric(0.4, 40_000) - 1, 5)
    order[[20_000, 39_999]] = 6
    words = maxent.words_in([" ".join(few[i] for i in order[:30_000]), " ".join(few[i] for i in order[30_000:])])
    alone = maxent.words_in(few)
    assert words.sizes.tolist() == [30_000, 10_000] and len(set(alone.keys.tolist())) == len(few)
    assert (words.keys == alone.keys[order]).all() and (words.leaves == alone.leaves[order]).all()


def test_changes_reach_the_driver_part_by_part(spark, monkeypatch):
    kind = type(spark.range(0))
    whole = []
    monkeypatch.setattr(kind, "collect", lambda self, collect=kind.collect: whole.append(self.columns) or collect(self))
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(9)], "fold int, text string").withColumn("fold", F.col("fold") % maxent.ROUNDS)
    starts = tuple(np.zeros((1 << maxent.LEAST_BITS, n), np.float32) for n in (maxent.CLASSES, maxent.PARTS))
    weights = maxent.train(docs, np.zeros(0, np.uint64), starts)
    assert all(np.isfinite(w).all() and w.any() for w in weights)
    assert not any("change" in columns for columns in whole)
    assert not any("changes-" in path for path in common._STORED)
