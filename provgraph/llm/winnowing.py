"""Document fingerprints by winnowing.

Every k-gram of code points has a rolling hash; in each window of `WINDOW`
hashes the smallest is chosen, the rightmost of equal ones, and kept with its
position. Any passage of `K + WINDOW - 1` code points that two texts share gives
them at least one common (hash) fingerprint.

Defined results: null text counts as empty and has no hash; a text shorter than
`K` has one hash, of all its characters; a text with fewer k-grams than a window
is one window. Two empty fingerprints have likeness 1, an empty and another 0.
Equal ids are ordered by a hash of their texts; rows with a null id come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import stored, text_of

K = 25
WINDOW = 40
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n, BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_TABLES: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def tables(n: int) -> list[np.ndarray]:
    global _TABLES
    if len(_TABLES[0]) < n:
        _TABLES = list(_powers(max(n, 1 << 16, 2 * len(_TABLES[0]))))
    return _TABLES


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all k-grams of code points: differences of one running sum, moved to a common power and mixed."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    up, down = tables(n + 1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:n], out=run[1:])
    h = (run[k:] - run[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of each window's minimum, the rightmost of equal ones, every position once.

    Minima of windows of 1, 2, 4, ... hashes are combined until two overlapping
    ones cover the window.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    window = min(window, n)
    low, place, size = hashes, np.arange(n), 1
    while size < window:
        step = min(size, window - size)
        right = low[step:] <= low[:-step]
        low, place = np.where(right, low[step:], low[:-step]), np.where(right, place[step:], place[:-step])
        size += step
    return place[np.concatenate(([True], place[1:] != place[:-1]))]


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprint(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text."""
    hashes = gram_hashes(points_of(text))
    at = winnow(hashes)
    return hashes[at], at


def digest(hashes: np.ndarray, at: np.ndarray) -> str:
    return hashlib.sha256(np.concatenate([hashes, at.astype(np.uint64)]).tobytes()).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted sets of hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def edited(text: str, after: str) -> str:
    """`text` with its last quarter replaced by as much of the beginning of the next document."""
    part = len(text) // 4
    return text[: len(text) - part] + after[:part]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The operator: doc_id with arrays `hashes` and `positions`."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [fingerprint(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "hashes": [h.view(np.int64) for h, _ in found], "positions": [p for _, p in found]})

    return rows.mapInPandas(run, f"doc_id {kind}, hashes array<long>, positions array<long>")


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_hashes"]


def _measured(doc_id: object, text: str, own: tuple, after: str, other: np.ndarray) -> list:
    new = edited(text, after)
    hashes, at = own
    changed, places = fingerprint(new)
    mine = np.unique(hashes)
    return [doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), digest(hashes, at), digest(changed, places), likeness(mine, np.unique(changed)), likeness(mine, other), len(hashes)]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside the next one in the order of ids.

    Documents are dealt once by ranges of ids and sorted there, so that the next
    document is the next row. Only the first and the last document of a range
    need another range: those two are passed on with their texts, and a second,
    small pass over one row for each range closes the gaps (and the circle).
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # Salted by a hash of the text, a third of all rows with one id still spreads over ranges.
    ordered = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id()).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_hashes long, part int, first_text string, last_text string"
    edge = ["part", "first_text", "last_text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = first = None
        part = -1
        for pdf in batches:
            out = []
            for i, t, part in zip(pdf["doc_id"], pdf["text"], pdf["part"], strict=True):
                own = fingerprint(t)
                if before is None:
                    first = t
                else:
                    out.append([*_measured(*before, t, np.unique(own[0])), -1, None, None])
                before = (i, t, own)
            yield pd.DataFrame(out, columns=[*COLUMNS, *edge])
        if before is not None:
            yield pd.DataFrame([[before[0], len(before[1]), None, None, None, None, None, 0, part, first, before[1]]], columns=[*COLUMNS, *edge])

    done = stored(ordered.mapInPandas(run, schema), "winnow")
    ends = done.where("part >= 0").select("doc_id", *edge)
    # One row for each range, so as many as partitions: their order fits one task.
    numbers = ends.select("part").orderBy("part").toPandas()["part"].tolist()
    after = dict(zip(numbers, numbers[1:] + numbers[:1], strict=True))
    if not numbers:
        return done.select(*COLUMNS)
    follows = docs.sparkSession.createDataFrame([(int(a), int(b)) for a, b in after.items()], "part int, at int")
    pairs = ends.select("doc_id", "last_text", "part").join(follows, "part").join(ends.select(F.col("part").alias("at"), F.col("first_text").alias("after")), "at")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([_measured(i, t, fingerprint(t), n, np.unique(fingerprint(n)[0])) for i, t, n in zip(pdf["doc_id"], pdf["last_text"], pdf["after"], strict=True)], columns=COLUMNS)

    closed = pairs.select("doc_id", "last_text", "after").mapInPandas(close, schema.split(", part")[0])
    return done.where("part < 0").select(*COLUMNS).unionByName(closed)
