"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles. Each run puts a set into the bucket of a token
it samples from itself, so that sets share a bucket with the probability of
their Jaccard similarity; sampling takes the smallest shingle under a random
order (a coordinate of the set's sketch). Small buckets are compared pair by
pair. Large ones are split again on further sampled tokens: each bucket draws
1 / threshold coordinates on average, by its own name, so that similar sets stay
together in one child on average while others part. Runs are repeated until the
target recall: `runs_for` takes their number from the survival of such a path
and from what the comparison of sketches passes.

A large bucket of near copies never parts. What is still large after the last
level is cut into blocks, and every two blocks are compared: no member leaves and
none is passed over. Pairs of similar sketches only join texts into groups; then
all pairs of a group are compared exactly, on all shingles, again block by block.
A block comparison returns each text's number of links and one text that it is
connected to, so that no group's pairs are written out and degrees are exact.

Classes are the connected components of verified links. Equal texts (equal word
lists) are one vertex from the start. Joins whose keys may be hot (a frequent
shingle's bucket, a component, a group of exact copies) move rows of a few
numbers only and have plain exchanges on both sides, so that adaptive execution
splits their hot partitions.

Defined results: words are lower-case runs of anything but ASCII white space; a
text of fewer words than a shingle is one shingle; null or blank texts have
none and stand alone, by id (rows without an id together); class ids are the smallest doc_id of a class
(nulls aside); repeated rows are members like any other. Vertices are 64-bit
text hashes: among 10^9 different texts the chance of one clash is 3 in 100.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import checkpointed, map_texts, stored, text_of

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.995
#: Coordinates of a sketch.
SKETCH = 32
#: Largest bucket that is compared pair by pair.
SMALL = 16
#: Levels of splitting; what is large after the last is compared as it is.
DEPTH = 2
#: Tokens that one split samples: a child bucket shares them all.
TOKENS = 3
#: Share of the allowed misses that the comparison of sketches may take.
SKETCH_MISSES = 0.2
#: Texts of a block whose sketches are compared, and whose shingles are; shingles that a block of long texts holds.
SKETCHES, TEXTS, GRAMS = 1024, 256, 1 << 20
#: Shingles that one matrix product counts.
COLUMNS = 4096

_A, _B = (np.random.default_rng(7).integers(1, 1 << 63, size=(2, SKETCH), dtype=np.uint64) | np.uint64(1))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def likely_from(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Equal coordinates from which two texts join a group: as many as leave hardly any pair at the threshold below."""
    below = 0.0
    for k in range(SKETCH + 1):
        below += math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k)
        if below > SKETCH_MISSES * (1 - recall):
            return k
    return SKETCH


def children(threshold: float = THRESHOLD) -> tuple[int, float]:
    """Child buckets that a split makes for sure, and the chance of a further one: on average a pair at the threshold stays together in one."""
    most = 1 / threshold**TOKENS
    return int(most), most - int(most)


def survival(similarity: float, depth: int, threshold: float = THRESHOLD) -> float:
    """Chance that a pair of that similarity still shares a bucket after a root token and `depth` splits."""
    stay = similarity**TOKENS
    sure, extra = children(threshold)
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - stay * alive) ** sure * (1 - extra * stay * alive)
    return similarity * alive


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is found with the target probability after all splits.

    All runs draw from one sketch, so the miss is a mean over the numbers of
    coordinates that agree; a pair below `likely_from` of them counts as missed.
    A threshold whose target the sketch's coordinates can't meet is refused.
    """
    chance = [math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k) for k in range(SKETCH + 1)]
    seen = [(c, survival(k / SKETCH, depth, threshold)) for k, c in enumerate(chance) if k >= likely_from(threshold, recall)]
    for runs in range(1, SKETCH + 1):
        if sum(c * (1 - (1 - s) ** runs) for c, s in seen) >= recall:
            return runs
    raise ValueError(f"{SKETCH} coordinates find less than {recall} of the pairs at {threshold}; take a higher threshold or a lower recall")


class _Hashes(dict):
    """Word hashes, each computed once."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()
_SPACES = str.maketrans("\t\n\x0b\x0c\r", "     ")


def words_list(text: str) -> list[str]:
    return [w for w in text.lower().translate(_SPACES).split(" ") if w]


def shingles(words: list[str], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    g = np.full(n, size, np.uint64)
    for i in range(size):
        g = (g ^ h[i : i + n]) * _STEP
        g ^= g >> np.uint64(29)
    return np.unique(g)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Smallest value of the shingles under each of SKETCH random orders."""
    low = np.empty(SKETCH, np.uint64)
    for i in range(SKETCH):
        low[i] = (((grams ^ _B[i]) * _A[i]) >> np.uint64(20)).min()
    return low.astype(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / max(1, len(a) + len(b) - common)


def _vertex(name: str) -> np.int64:
    return np.uint64(xxhash.xxh64_intdigest(name, seed=11)).astype(np.int64)


def _measured() -> Callable[[list[str]], dict]:
    """Vertex, number of shingles and sketch of texts; all null for blank ones."""

    def work(texts: list[str]) -> dict:
        v, size, mins = [], [], []
        for text in texts:
            words = words_list(text)
            grams = shingles(words)
            v.append(int(_vertex(" ".join(words))) if words else None)
            size.append(len(grams))
            mins.append(sketch(grams) if words else None)
        return {"v": v, "size": size, "mins": mins}

    return work


def _sketches(rows: DataFrame) -> DataFrame:
    """`rows` (with doc_id and text) with vertex, shingles and sketch in place of the text; blank texts have no sketch and stand for their id."""
    found = map_texts(rows, "v long, size long, mins array<long>", _measured)
    return found.withColumn("v", F.coalesce("v", F.xxhash64(F.lit("blank"), F.col("doc_id"))))


def _agreement(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _child(number: int) -> Column:
    """A child bucket's name: that of its parent and the tokens at coordinates which the parent's name draws."""
    start, step = F.xxhash64("b", F.lit(number)), F.xxhash64("b", F.lit(number), F.lit("step"))
    # Odd steps meet different coordinates, as their number is a power of two.
    at = [F.pmod(F.pmod(start, F.lit(SKETCH)) + j * (2 * F.pmod(step, F.lit(SKETCH // 2)) + 1), F.lit(SKETCH)).cast("int") for j in range(TOKENS)]
    return F.xxhash64("b", F.lit(number), *[F.get(F.col("mins"), c) for c in at])


def _dealt(members: DataFrame, name: str) -> DataFrame:
    """Members once for each pair of blocks they meet in: `k` is the number of blocks of their `name`; `other` tells the second block's."""
    x = F.pmod(F.xxhash64("v", F.lit("block")), F.col("k"))
    each = members.withColumn("x", x).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    return each.withColumns({"block": F.xxhash64(name, F.least("x", "y"), F.greatest("x", "y")), "other": F.col("x") > F.col("y")}).drop("x", "y", "k", name)


def _sorted(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("block").sortWithinPartitions("block", "v")


def _by_block(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of one block pair at a time; rows come in the order of blocks."""
    held: list[dict] = []

    def whole() -> dict[str, np.ndarray]:
        return {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for pdf in batches:
        columns = {c: pdf[c].to_numpy() for c in pdf}
        block = columns["block"]
        for start, end in pairwise([0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]):
            if held and start < end and held[0]["block"][0] != block[start]:
                yield whole()
                held = []
            if start < end:
                held.append({c: x[start:end] for c, x in columns.items()})
    if held:
        yield whole()


def _sides(other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two blocks that are compared; a block by itself is both."""
    first, second = np.flatnonzero(~other), np.flatnonzero(other)
    return first, second if len(second) else first


def _roots(linked: np.ndarray, first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """For each of n places one place of its component; `linked` is the matrix of links between the two sides."""
    near = np.zeros((n, n), bool)
    near[np.ix_(first, second)] = linked
    near |= near.T
    root, fresh = np.arange(n), near.any(1)
    while fresh.any():
        seed = int(fresh.argmax())
        edge = np.array([seed])
        fresh[seed] = False
        while len(edge):
            root[edge] = seed
            edge = np.flatnonzero(near[edge].any(0) & fresh)
            fresh[edge] = False
    return root


def _common(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of every set of the one list and every set of the other."""
    both = np.intersect1d(np.concatenate(first), np.concatenate(second))

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(both, flat), max(0, len(both) - 1))
        kept = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        at, owner = at[kept], owner[kept]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    sides = [(*placed(first), len(first)), (*placed(second), len(second))]
    counts = np.zeros((len(first), len(second)), np.float64)
    for low in range(0, len(both), COLUMNS):
        parts = []
        for at, owner, n in sides:
            s, e = np.searchsorted(at, [low, low + COLUMNS])
            part = np.zeros((n, min(COLUMNS, len(both) - low)), np.float32)
            part[owner[s:e], at[s:e] - low] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts


def _candidates(texts: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(a, b) edges that connect all vertices which share a bucket and have similar sketches; texts has v, size, mins."""
    runs, likely_at = runs_for(threshold, recall), likely_from(threshold, recall)
    own = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.xxhash64(r, F.get(F.col("mins"), r)))
    level = texts.select("v", F.explode(own).alias("b"))
    few, crowded = None, []
    sure, extra = children(threshold)
    for depth in range(DEPTH + 1):
        # Counted with partial sums and stored, so that both sides of the join are plain exchanges, whose hot buckets Spark splits at run time.
        sizes = stored(level.groupBy("b").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        level = stored(level.join(sizes, "b"), "paths")
        large = level.where(F.col("n") > SMALL)
        few = level.where(F.col("n") <= SMALL).select("b", "v") if depth == 0 else few
        # What a large bucket parted into may still be one dense group, so its small parts aren't joined pair by pair either.
        if depth == DEPTH or large.isEmpty():
            crowded.append(level if depth else large)
            break
        if depth:
            crowded.append(level.where(F.col("n") <= SMALL))
        # The bucket's name draws whether there is a further child.
        more = F.pmod(F.xxhash64("b", F.lit("twice")), F.lit(10_000)) < int(extra * 10_000)
        each = [_child(i) for i in range(sure + 1)]
        level = large.join(texts.select("v", "mins"), "v").select("v", F.explode(F.when(more, F.array(*each)).otherwise(F.array(*each[:sure]))).alias("b"))
    within = few.select("b", F.col("v").alias("a")).join(few.select("b", F.col("v").alias("c")), "b").where("a < c").select("a", F.col("c").alias("b")).distinct()
    side = texts.select("v", "size", "mins")
    likely = (
        within.join(side.toDF("a", "size_a", "mins_a"), "a").join(side.toDF("b", "size_b", "mins_b"), "b")
        .where((F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b")) & (_agreement(F.col("mins_a"), F.col("mins_b")) >= likely_at))
        .select("a", "b")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_block(batches):
            first, second = _sides(rows["other"])
            # In the order of vertices a component's root is its smallest, so that many buckets name the same one.
            mins, size, v = np.stack(rows["mins"]), rows["size"], rows["v"]
            equal = np.zeros((len(first), len(second)), np.uint8)
            for c in range(SKETCH):
                equal += mins[first, c, None] == mins[None, second, c]
            x, y = size[first, None], size[None, second]
            root = _roots((equal >= likely_at) & (np.minimum(x, y) >= threshold * np.maximum(x, y)) & (v[first, None] != v[None, second]), first, second, len(v))
            moved = root != np.arange(len(v))
            yield pd.DataFrame({"a": v[moved], "b": v[root[moved]]})

    blocks = F.ceil(F.col("n") / SKETCHES).cast("long")
    dealt = _dealt(reduce(DataFrame.unionByName, crowded).select("b", "v", blocks.alias("k")), "b").join(side, "v")
    return likely.unionByName(_sorted(dealt).mapInPandas(compare, "a long, b long").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(v, near, n): v has n links, counted in one pair of blocks, and is connected by links to near (or is it); the rows' n add up to its degree.

    Groups are the components of the pairs; all pairs of a group are compared.
    """
    groups = components(pairs).join(texts.select("v", *KEY, "size"), "v")
    sizes = groups.groupBy("label").agg(F.count("*").alias("n"), F.max("size").alias("most"))
    per = F.least(F.lit(TEXTS), F.greatest(F.lit(8), (F.lit(GRAMS) / F.col("most")).cast("long")))
    groups = stored(groups.join(sizes.select("label", F.ceil(F.col("n") / per).cast("long").alias("k")), "label"), "groups")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = [words_list(t) for t in pdf["text"]]
            # Keys are hashes.
            own = np.array([_vertex(" ".join(w)) for w in words], np.int64) == pdf["v"].to_numpy()
            yield pd.DataFrame({"v": pdf["v"].to_numpy(), "grams": [shingles(w).tobytes() for w in words]})[own]

    # One row stands for a text, told by its key: rows that share an id, or have none, don't meet.
    # The side grows with the documents, so it is never sent to all tasks, not even while it is small.
    whole = docs.join(groups.select("v", *KEY).hint("merge"), [*KEY]).select("v", "text").mapInPandas(cut, "v long, grams binary").dropDuplicates(["v"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_block(batches):
            first, second = _sides(rows["other"])
            grams, v = [np.frombuffer(x, np.uint64) for x in rows["grams"]], rows["v"]
            size = np.array([len(x) for x in grams])
            if len(first) == 2 and second is first:
                value = np.array([[0.0, x := jaccard(grams[0], grams[1])], [x, 0.0]])
            else:
                common = _common([grams[i] for i in first], [grams[i] for i in second])
                value = common / np.maximum(1, size[first, None] + size[None, second] - common)
            linked = (value >= threshold) & (v[first, None] != v[None, second])
            root = _roots(linked, first, second, len(v))
            n = np.zeros(len(v), np.int64)
            n[first] += linked.sum(1)
            if second is not first:
                n[second] += linked.sum(0)
            yield pd.DataFrame({"v": v, "near": v[root], "n": n})[n > 0]

    dealt = _dealt(groups.select("label", "v", "k"), "label").join(whole, "v")
    return _sorted(dealt).mapInPandas(compare, "v long, near long, n long")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every vertex of the edges (a, b): the smallest vertex of its component.

    Each round takes the smallest label among the neighbours and then the label
    of the label, until nothing changes; every round is checkpointed.
    """
    ways = edges.select("a", "b").union(edges.select("b", "a")).toDF("v", "u").distinct()
    ways = checkpointed(ways)
    labels = checkpointed(ways.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("label")))
    while True:
        near = ways.join(labels.toDF("u", "near"), "u").groupBy("v").agg(F.min("near").alias("near"))
        lower = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("next"))
        jump = lower.select(F.col("v").alias("next"), F.col("next").alias("far"))
        after = checkpointed(lower.join(jump, "next").select("v", "label", F.least("next", "far").alias("next")))
        moved = after.where("next <> label").isEmpty()
        labels = after.select("v", F.col("next").alias("label"))
        if moved:
            return labels


#: A 128-bit hash of id and text tells rows apart.
KEY = ("key0", "key1")


def _keyed(doc_id: str, text: str) -> list[Column]:
    return [F.xxhash64(F.lit(i), F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text)).alias(k) for i, k in enumerate(KEY)]


def links(rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(members, links) of rows with doc_id, text and the columns of KEY: the rows with their vertex for the text; counted links between different texts as `_verified` returns them."""
    members = stored(_sketches(rows), "sketches")
    texts = members.where("mins IS NOT NULL").groupBy("v").agg(F.min(F.struct(*KEY)).alias("key"), F.first("size").alias("size"), F.first("mins").alias("mins")).select("v", *[f"key.{k}" for k in KEY], "size", "mins")
    texts = stored(texts, "texts")
    found = stored(_verified(_candidates(texts, threshold, recall), texts, rows.select(*KEY, "text"), threshold), "links")
    return members.drop("size", "mins"), found


def _labels(found: DataFrame) -> DataFrame:
    return components(found.where("v <> near").select(F.col("v").alias("a"), F.col("near").alias("b")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each document: doc_id, class_id, class_size, n_copies (documents of its text) and n_links (different texts linked to its text)."""
    members, found = links(docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), *_keyed(doc_id, text)), threshold, recall)
    degree = found.groupBy("v").agg(F.sum("n").alias("n_links"))
    copies = members.groupBy("v").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("low"))
    vertices = checkpointed(copies.join(_labels(found), "v", "left").join(degree, "v", "left").select("v", "n_copies", "low", F.coalesce("label", "v").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    classes = vertices.groupBy("label").agg(F.min("low").alias("class_id"), F.sum("n_copies").alias("class_size"))
    # Stored before the last join, so that one group of exact copies with many rows is a skewed side that Spark can split.
    named = checkpointed(vertices.join(classes, "label").select("v", "class_id", "class_size", "n_copies", "n_links"))
    return members.join(named, "v").select("doc_id", "class_id", "class_size", "n_copies", "n_links")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """`docs` with one row of each class, that of the smallest id (nulls last); of rows that share it, the one whose text's hash is smallest.

    Ids need not be unique: a row's key is a 128-bit hash of its id and text.
    The decision is made on narrow rows, and texts are dealt out by their keys
    once. Rows of one key are united before they are dealt; of those, which
    differ in other columns at most, any one may stay.
    """
    key, names = _keyed(doc_id, text), [*KEY]
    members, found = links(docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"), *key), threshold, recall)
    first = members.groupBy("v").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *names)).alias("row"))
    left = first.join(_labels(found), "v", "left").groupBy(F.coalesce("label", "v").alias("label")).agg(F.min("row").alias("row")).select("row.key0", "row.key1")
    once = docs.select(*key, F.struct(*[F.col(c) for c in docs.columns]).alias("doc")).groupBy(*names).agg(F.first("doc").alias("doc"))
    return once.join(left, names).select("doc.*")
