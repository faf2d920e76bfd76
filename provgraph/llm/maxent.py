"""Language-model scoring with a hashed maximum-entropy model.

P(word | history) = P(class | history) x P(part | class, history) x P(word | part).
Both first factors are softmaxes over hashed features of the history: n-grams
(the last word, the last two), skips over one and two words, and the classes of
the last three; those of the second factor are hashed together with the class.
The most frequent words and the end of a text are classes of their own; other
words fall into classes by their last two characters, and those into parts by a
hash. P(word | part) takes add-one counts of the words of a part, a hundredth of
a thousandth of the vocabulary or so, with one place for unknown words: all
probabilities sum to 1.

Training passes over the training texts once, in rounds. In a round every task
runs gradient steps (AdaGrad) on its own texts, from the weights of the round
before; the changes are summed by blocks of rows and averaged over the tasks
that met a feature. The number of hashed rows grows with the counted vocabulary
between bounds. Counts cover all training texts and all words, by 64-bit hashes
(among 10^8 words the chance of one clash is 3 in 10,000). Those of the
`FREQUENT` most frequent travel with the tasks; rarer ones, which have no hot
keys, are joined to the table of counts.

Texts are handled as arrays of UTF-8 bytes: words are found, lower-cased and
hashed a batch at a time.

Defined results: null text counts as empty and has its end token only; without
training texts every token is unknown; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import map_texts, removed, span_keys, stored, stored_at, text_of

#: Words that travel with the tasks.
FREQUENT = 200_000
CLASSES, HEADS, ENDINGS = 64, 31, 32
#: Parts of a class; heads and the end have one word and need none.
PARTS = 64
LEAVES = CLASSES * PARTS
#: Hashed rows of weights: one for about 512 words, within these powers of two.
LEAST_BITS, MOST_BITS = 14, 16
ROUNDS = 3
RATE = 0.2
#: Classes drawn for the gradient of a token.
DRAWS = 2
GROUP = 8
#: Tokens of a gradient step and of a scored batch.
STEP = 2048
#: Rows of weights whose changes are sent and summed together.
BLOCK = 256
#: Words that a task counts before it merges equal ones.
COUNTED = 1 << 21
#: The key of a text's end.
END = 0


@dataclass
class Words:
    """Words of a batch of texts in their order: hashes, leaves (class x PARTS + part) by the ending and the hash, and the number of each text's."""

    keys: np.ndarray
    leaves: np.ndarray
    sizes: np.ndarray


def words_in(texts: list[str]) -> Words:
    """Words between ASCII white space, A to Z lowered."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    codes = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    codes = codes + (codes - np.uint8(65) < 26) * np.uint8(32)
    blank = np.concatenate([[True], (codes == 32) | (codes - np.uint8(9) < 5)])
    # Every text ends with a blank, so that beginnings and ends take turns.
    begins, ends = np.flatnonzero(blank[:-1] != blank[1:]).reshape(-1, 2).T.copy()
    offsets = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    keys = np.maximum(span_keys(codes, begins, ends), np.uint64(1))
    # The last two characters: back from the end to the second byte that starts one.
    one = _started(codes, ends - 1)
    two = np.where(one > begins, _started(codes, np.maximum(one - 1, 0)), begins)
    ending = codes[ends - 1] * np.uint64(0x100000001B3)
    back = 2
    rest = np.flatnonzero(ends - back >= two)
    while len(rest):
        at = ends[rest] - back
        ending[rest] = (ending[rest] ^ codes[at]) * np.uint64(0x100000001B3)
        back += 1
        rest = rest[at > two[rest]]
    groups = 1 + HEADS + (_stirred(ending) % np.uint64(ENDINGS)).view(np.int64)
    return Words(keys, groups * PARTS + (keys % np.uint64(PARTS)).view(np.int64), np.diff(np.searchsorted(begins, offsets)))


def _started(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the characters begin that these bytes belong to."""
    rest = np.flatnonzero((codes[at] & 0xC0) == 0x80)
    while len(rest):
        at[rest] -= 1
        rest = rest[(codes[at[rest]] & 0xC0) == 0x80]
    return at


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Known:
    """Places of hashes in a list: a table of slots finds most, the others are searched."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(8, (4 * len(keys)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        slot = (keys >> self.shift).view(np.int64)
        self.slots[slot[::-1]] = np.arange(len(keys))[::-1]
        lost = np.flatnonzero(self.slots[slot] != np.arange(len(keys)))
        self.lost = lost[np.argsort(keys[lost])]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each, -1 for what isn't in the list."""
        found = self.slots[(keys >> self.shift).view(np.int64)]
        if not len(self.keys):
            return found
        found[self.keys[found] != keys] = -1
        if len(self.lost):
            rest = np.flatnonzero(found < 0)
            sorted_keys = self.keys[self.lost]
            at = np.minimum(np.searchsorted(sorted_keys, keys[rest]), len(self.lost) - 1)
            found[rest] = np.where(sorted_keys[at] == keys[rest], self.lost[at], -1)
        return found


def _mixed(rows: int, reserved: int, seed: int, *parts: np.ndarray) -> np.ndarray:
    """Row of a feature among `rows`, a power of two; the first `reserved` rows are left to the constants."""
    h = np.full(len(parts[0]), seed * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.maximum((h >> np.uint64(65 - rows.bit_length())).view(np.int64), reserved)


@dataclass
class Tokens:
    """All tokens of a batch, each text's end included: features of both softmaxes, classes, parts, owners, places in the list of known words; `inner` are the tokens with a part."""

    first: np.ndarray
    second: np.ndarray
    classes: np.ndarray
    leaves: np.ndarray
    owner: np.ndarray
    inner: np.ndarray
    word: np.ndarray
    keys: np.ndarray
    place: np.ndarray


def batch_tokens(texts: list[str], known: Known, heads: int, rows: int) -> Tokens:
    """The first `heads` of the known words are classes of their own."""
    words = words_in(texts)
    place = known.find(words.keys)
    sizes = words.sizes
    is_head = (place >= 0) & (place < heads)
    leaves = np.where(is_head, (1 + place) * PARTS, words.leaves)
    # Every text stands behind three empty places, which are its history at the start, and before its end.
    starts = np.concatenate([[0], np.cumsum(sizes + 4)])[:-1] + 3
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes) + np.arange(len(place))
    total = int((sizes + 4).sum())
    hashes, groups, leaf = np.zeros(total, np.uint64), np.full(total, CLASSES, np.uint64), np.zeros(total, np.int64)
    hashes[at], groups[at], leaf[at] = words.keys, (leaves // PARTS).view(np.uint64), leaves
    kept, word = np.ones(total, bool), np.zeros(total, bool)
    kept[np.concatenate([starts - 1, starts - 2, starts - 3])] = False
    word[at] = True
    now = np.flatnonzero(kept)
    h1, h2, h3 = hashes[now - 1], hashes[now - 2], hashes[now - 3]
    g = [groups[now - i] for i in (1, 2, 3)]
    classes = leaf[now] // PARTS
    inner = np.flatnonzero(classes > HEADS)
    c = classes[inner].view(np.uint64)
    first = np.stack([np.zeros(len(now), np.int64), _mixed(rows, 1, 1, h1), _mixed(rows, 1, 2, h1, h2), _mixed(rows, 1, 3, h2), _mixed(rows, 1, 4, h3), _mixed(rows, 1, 5, *g)])
    h1, h2 = h1[inner], h2[inner]
    second = np.stack([classes[inner], _mixed(rows, CLASSES, 6, c, h1), _mixed(rows, CLASSES, 7, c, h1, h2), _mixed(rows, CLASSES, 8, c, h2)])
    return Tokens(first, second, classes, leaf[now], np.repeat(np.arange(len(texts)), sizes + 1), inner, word[now], words.keys, place)


def raw_scores(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Sums of the features' weights, class by class; held below where their exponentials would overflow."""
    z = np.take(weights, feats[0], axis=0)
    part = np.empty_like(z)
    for f in feats[1:]:
        z += np.take(weights, f, axis=0, out=part, mode="clip")
    # The largest is found sooner than all are compared and written, and hardly ever is too large.
    return np.minimum(z, np.float32(80), out=z) if z.size and not z.max() <= 80 else z


def chosen_logs(weights: np.ndarray, feats: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logarithm of the softmax's probability of each target, STEP tokens at a time."""
    out = np.empty(len(target))
    ones = np.ones(weights.shape[1], np.float32)
    for i in range(0, len(target), STEP):
        y = target[i : i + STEP]
        z = raw_scores(weights, feats[:, i : i + STEP])
        own = z[np.arange(len(y)), y]
        out[i : i + STEP] = own - np.log(np.exp(z, out=z) @ ones + np.float32(1e-30))
    return out


def drawn_classes(mass: np.ndarray, draws: np.random.Generator, times: int = 1) -> np.ndarray:
    """`times` classes for each row, one after the other, by the row's masses: first a group of GROUP classes, then one of its classes."""
    n, classes = mass.shape
    at = draws.random((2 * times, n), np.float32)
    # Places run along the second axis from here on, so that sums and comparisons go over long rows.
    before = _running((mass.reshape(-1, GROUP) @ np.ones(GROUP, np.float32)).reshape(n, -1))
    at[::2] *= before[-1]
    group = _places(before[:, None], at[::2])
    firsts = np.arange(n) * (classes // GROUP) + group
    inner = _running(np.take(mass.reshape(-1, GROUP), firsts.ravel(), axis=0)).reshape(GROUP, times, n)
    at[1::2] *= inner[-1]
    return (group * GROUP + _places(inner, at[1::2])).ravel()


def _running(sizes: np.ndarray) -> np.ndarray:
    """Running sums of each row, turned to columns."""
    sums = np.ascontiguousarray(sizes.T)
    for k in range(1, len(sums)):
        sums[k] += sums[k - 1]
    return sums


def _places(sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the running sums but the last lie at or below each value."""
    return np.add.reduce((sums[:-1] <= at).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64)


class Descent:
    """AdaGrad steps on one softmax, STEP tokens at a time, in place. The first feature's rows hold logarithms of shares and stay.

    The gradient's part at the target class is exact; the parts of the other
    classes are drawn: DRAWS classes by their probabilities stand for all, which
    is right on average and leaves a few cells a feature to change.
    """

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        # A cell's sum and its squares are one complex number, so that memory is visited once for both.
        self.cells = np.full(weights.size, 1e-2j, np.complex64)
        self.draws = np.random.default_rng(20)

    def over(self, feats: np.ndarray, target: np.ndarray) -> None:
        flat, classes = self.weights.reshape(-1), self.weights.shape[1]
        sums = self.cells.view(np.float32)
        ones = np.ones(classes, np.float32)
        for i in range(0, len(target), STEP):
            f, y = feats[:, i : i + STEP], target[i : i + STEP]
            n = len(y)
            mass = raw_scores(self.weights, f)
            np.exp(mass, out=mass)
            cells, parts = np.empty((1 + DRAWS, n), np.int64), np.empty((1 + DRAWS, n), np.float32)
            cells[0], cells[1:] = y, drawn_classes(mass, self.draws, DRAWS).reshape(DRAWS, n)
            parts[0] = mass.ravel()[np.arange(n) * classes + y] / (mass @ ones + np.float32(1e-30)) - 1
            np.multiply(cells[1:] != y, np.float32(1 / DRAWS), out=parts[1:])
            at = (f[1:, None, :] * classes + cells).ravel()
            np.add.at(sums, 2 * at, np.tile(parts.ravel(), len(f) - 1))
            # Equal cells have equal sums, so that it doesn't matter which of them is written last.
            found = self.cells.take(at)
            gradient = found.real
            square = found.imag + gradient * gradient
            flat[at] = flat.take(at) - np.float32(RATE) * gradient / np.sqrt(square)
            found.real, found.imag = 0, square
            self.cells[at] = found


def _merged(keys: np.ndarray, leaves: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], leaves[order][first], np.add.reduceat(n[order], first) if len(first) else n


def count_words(docs: DataFrame) -> DataFrame:
    """(key, leaf, n) over all texts; tasks count before they send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = ends = 0

        def sent() -> pa.RecordBatch:
            keys, leaves, n = _merged(*[np.concatenate(x) for x in zip(*held, strict=True)])
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(leaves.astype(np.int32)), pa.array(n)], names=["key", "leaf", "n"])

        for batch in batches:
            words = words_in(batch.column(0).to_pylist())
            ends += batch.num_rows
            held.append(_merged(words.keys, words.leaves, np.ones(len(words.keys), np.int64)))
            size += len(held[-1][0])
            if size > COUNTED:
                held = [_merged(*[np.concatenate(x) for x in zip(*held, strict=True)])]
                if (size := len(held[0][0])) > COUNTED // 2:
                    yield sent()
                    held, size = [], 0
        held.append((np.full(min(ends, 1), END, np.uint64), np.zeros(min(ends, 1), np.int64), np.full(min(ends, 1), ends)))
        yield sent()

    return docs.select("text").mapInArrow(run, "key long, leaf int, n long").groupBy("key").agg(F.first("leaf").alias("leaf"), F.sum("n").alias("n"))


def train(docs: DataFrame, heads: np.ndarray, starts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both softmaxes after ROUNDS rounds, each over the texts whose `fold` is its number; `starts` are the weights before and are overwritten."""
    spark = docs.sparkSession
    rows = len(starts[0])
    for k in range(ROUNDS):
        start = spark.sparkContext.broadcast(starts)

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own = [w.copy() for w in start.value]
            descents = [Descent(w) for w in own]
            touched = np.zeros((2, rows), bool)
            known = Known(heads)
            for batch in batches:
                t = batch_tokens(batch.column(0).to_pylist(), known, len(heads), rows)
                for i, (feats, target) in enumerate([(t.first, t.classes), (t.second, t.leaves[t.inner] % PARTS)]):
                    descents[i].over(feats, target)
                    touched[i][feats.ravel()] = True
            if not touched.any():
                return
            # Changes travel as half-precision numbers, with a column that tells which rows were met.
            blocks = []
            for i in range(2):
                change = np.empty((rows, own[i].shape[1] + 1), np.float16)
                change[:, :-1] = np.clip(own[i] - start.value[i], -6e4, 6e4)
                change[:, -1] = touched[i]
                blocks += [(i * rows + r, change[r : r + BLOCK].tobytes()) for r in range(0, rows, BLOCK) if touched[i][r : r + BLOCK].any()]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["block", "change"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, change in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    sums[block] = sums.get(block, 0) + np.frombuffer(change, np.float16).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "change"])

        sent = docs.where(F.col("fold") == k).select("text").mapInArrow(run, "block int, change binary")
        # The driver holds the weights once and takes the sums part by part; tasks have what was broadcast before.
        sums, path = stored_at(sent.repartition("block").mapInArrow(add, "block int, change binary"), "changes")
        for r in sums.toLocalIterator():
            i, first = divmod(r["block"], rows)
            change = np.frombuffer(r["change"], np.float32).reshape(BLOCK, -1)
            starts[i][first : first + BLOCK] += change[:, :-1] / np.maximum(change[:, -1:], 1)
        start.destroy()
        removed(spark, path)
    return starts


@dataclass
class Model:
    """What scoring needs: known words with log10(count + 1), heads, weights, and log10 of what the words of a leaf are divided by."""

    keys: np.ndarray
    logs: np.ndarray
    heads: int
    weights: tuple[np.ndarray, np.ndarray]
    below: np.ndarray
    end: int

    def token_logs(self, texts: list[str], known: Known) -> tuple[Tokens, np.ndarray, np.ndarray]:
        """(tokens, log10 of count + 1 or NaN for words that aren't known here, log10 of the factors beside the count) of texts."""
        t = batch_tokens(texts, known, self.heads, len(self.weights[0]))
        model = chosen_logs(self.weights[0], t.first, t.classes)
        model[t.inner] += chosen_logs(self.weights[1], t.second, t.leaves[t.inner] % PARTS)
        model /= math.log(10)
        logs = np.full(len(model), math.log10(self.end + 1))
        logs[t.word] = np.where(t.place >= 0, self.logs[t.place], np.nan) if len(self.logs) else np.nan
        # The end and the heads are certain in their classes.
        model -= np.where(t.classes > HEADS, self.below[t.leaves], logs)
        return t, logs, model


def fitted(docs: DataFrame, counts: DataFrame) -> tuple[Model, int, int]:
    """(model, training tokens, distinct ones) of texts (with `text` and `fold`) and their counts."""
    words = F.col("key") != END
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where(words).orderBy(F.desc("n"), "key").limit(FREQUENT).select("key", "leaf", "n").toArrow()
    keys, n, leaf = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy(), top["leaf"].to_numpy()
    heads = min(HEADS, len(keys))
    size = np.ones(LEAVES)
    for r in counts.where(words).groupBy("leaf").agg((F.sum("n") + F.count("*")).alias("size")).collect():
        size[r["leaf"]] += r["size"]
    np.subtract.at(size, leaf[:heads], n[:heads] + 1)
    end = counts.where(~words).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    by_class = size.reshape(CLASSES, PARTS)
    shares = by_class.sum(1) * (np.arange(CLASSES) > HEADS)
    shares[0] = end + 1
    shares[1 : 1 + HEADS] = 1
    shares[1 : 1 + heads] = n[:heads]
    rows = 1 << min(MOST_BITS, max(LEAST_BITS, int(kinds).bit_length() - 9))
    starts = np.zeros((rows, CLASSES), np.float32), np.zeros((rows, PARTS), np.float32)
    starts[0][0] = np.log(shares / shares.sum())
    starts[1][:CLASSES] = np.log(by_class / by_class.sum(1, keepdims=True))
    weights = train(docs, keys[:heads], starts) if total else starts
    return Model(keys, np.log10(n + 1), heads, weights, np.log10(size), end), total, kinds


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", fold: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document; `training` tells which texts teach."""
    spark = docs.sparkSession
    fold = F.pmod(F.xxhash64(F.lit("round"), F.col(doc_id), F.col(text)), F.lit(ROUNDS)) if fold is None else fold
    teaching = docs.where(training).select(text_of(text).alias("text"), fold.alias("fold"))
    counts = stored(count_words(teaching), "counts")
    model, total, kinds = fitted(teaching, counts)
    # Bounded by FREQUENT and MOST_BITS: 3.2 MB of words and 2 x 16 MB of weights at most.
    shared = spark.sparkContext.broadcast(model)
    base_below = math.log10(total + kinds + 1)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def begin() -> Callable[[list[str]], dict]:
        model = shared.value
        known = Known(model.keys)
        numbers = iter(range(TaskContext.get().partitionId() << 34, 1 << 62))

        def work(texts: list[str]) -> dict:
            t, logs, factors = model.token_logs(texts, known)
            n, rare = len(texts), np.isnan(logs)
            counted = ~rare & (t.word | (model.end > 0))
            # Rare words in the order of texts.
            spelled = pa.array(t.keys[t.place < 0].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(t.owner[rare], minlength=n))])
            return {
                "number": [next(numbers) for _ in texts], "n_tokens": np.bincount(t.owner, minlength=n), "n_frequent": np.bincount(t.owner[counted], minlength=n),
                "logs": np.bincount(t.owner, np.where(rare, 0.0, logs), n), "model": np.bincount(t.owner, factors, n), "rare": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spelled),
            }

        return work

    first = stored(map_texts(rows, "number long, n_tokens long, n_frequent long, logs double, model double, rare array<long>", begin), "scores")
    rest = first.select("number", F.explode("rare").alias("key")).join(counts.select("key", "n"), "key").groupBy("number").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("rare_logs"))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return first.drop("rare").join(rest, "number", "left").select(
        "doc_id", "n_tokens", (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(base_below)).alias("base_score"), (logs + F.col("model")).alias("score"),
    )
