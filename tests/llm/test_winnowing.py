import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from provgraph.llm import winnowing as W


def brute(hashes, window):
    """Minimum of every window, rightmost of equal ones."""
    n = len(hashes)
    window = min(window, n)
    found = []
    for i in range(n - window + 1 if n else 0):
        low = min(hashes[i : i + window])
        at = max(j for j in range(i, i + window) if hashes[j] == low)
        if not found or found[-1] != at:
            found.append(at)
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 20))
def test_minima_take_the_rightmost_of_equal_hashes(values, window):
    assert W.winnow(np.array(values, np.uint64), window).tolist() == brute(values, window)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é𝄞", max_size=80), st.integers(1, 8))
def test_rolling_hashes_agree_exactly_with_equal_grams(text, k):
    hashes = W.gram_hashes(W.points_of(text), k)
    k = min(k, len(text))
    grams = [text[i : i + k] for i in range(len(text) - k + 1)] if text else []
    assert len(hashes) == len(grams)
    by_gram = {}
    for h, g in zip(hashes.tolist(), grams, strict=True):
        assert by_gram.setdefault(g, h) == h
    assert len(set(by_gram.values())) == len(by_gram)


def test_shared_passage_is_guaranteed_a_common_fingerprint():
    rng = np.random.default_rng(1)
    passage = "".join(rng.choice(list("abcdefgh "), W.K + W.WINDOW - 1))
    for size in (0, 10, 300):
        a = "".join(rng.choice(list("mnop"), size)) + passage + "xyz" * size
        assert set(W.fingerprint(a)[0].tolist()) & set(W.fingerprint("q" * 77 + passage + "r" * 99)[0].tolist())


def test_next_documents_close_a_circle_over_ranges(spark):
    texts = {i: f"text {i} " * (i % 50) for i in range(0, 200, 3)}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, part string")
    got = {r["doc_id"]: r for r in W.with_next(docs).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        new = W.edited(texts[i], texts[after])
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got[i]["edited_fingerprint"] == W.digest(*W.fingerprint(new))
        assert got[i]["near_next"] == W.likeness(np.unique(W.fingerprint(texts[i])[0]), np.unique(W.fingerprint(texts[after])[0]))


def test_nulls_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "abc"), (3, "z" * 100_000)], "doc_id long, text string")
    rows = W.with_next(docs).collect()
    assert len(rows) == 5
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 0}) == 1
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    assert W.with_next(docs.limit(0)).count() == 0
    assert W.with_next(docs.limit(1)).collect()[0]["near_next"] == 1.0
