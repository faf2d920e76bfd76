"""Language identification by hyperdimensional profiles.

Every letter has a random +-1 vector of its own, drawn from its code point. An
n-gram vector binds its letters' vectors, each permuted by its place (a cyclic
shift), by multiplication; a document bundles (adds) its n-gram vectors, and a
language prototype bundles the documents known to be in that language, each
scaled to the same length. A document takes the language whose prototype has the
largest cosine. Tasks bundle their documents and send one vector a language.

Defined results: null text, or text without a letter, gives `und` with score 0;
so does every text where no language was learned. Equal cosines go to the first
language in byte order. Null and empty languages teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import map_texts, text_of

DIMENSIONS = 1024
GRAM = 3
SEED = 20240
UNDETERMINED = "und"
#: Documents and characters bundled together, n-grams multiplied at once.
BLOCK, CHARACTERS, GRAMS = 64, 1_000_000, 4096
#: Prototypes are summed as whole numbers, so that the order of tasks cannot change them.
SCALE = 1 << 20
#: A code point takes this many bits of an n-gram's code.
BITS = 21

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(cp).isalpha() for cp in range(0x110000)), bool, 0x110000)
    return _LETTERS


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The +-1 vector of each code point: bits of a mixed counter."""
    h = (points.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS // 64) + np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(31)
    return np.unpackbits(h.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Vectors of n-gram codes: permuted letter vectors, bound by multiplication."""
    out = np.ones((len(codes), DIMENSIONS), np.int8)
    for place in range(GRAM):
        shift = GRAM - 1 - place
        points, back = np.unique(codes >> (BITS * shift) & ((1 << BITS) - 1), return_inverse=True)
        out *= np.roll(letter_vectors(points), shift, axis=1)[back]
    return out.astype(np.float32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, code) of every n-gram of letters; runs of other characters count as one boundary."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lowered])
    chars = np.where(letters()[points], points, 0).astype(np.int64)
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 0) | (chars[:-1] != 0)
    chars, owner = chars[keep], owner[keep]
    n = len(chars) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = sum(chars[i : i + n] << (BITS * (GRAM - 1 - i)) for i in range(GRAM))
    inside = (owner[:n] == owner[GRAM - 1 :]) & (chars[1 : n + 1] != 0)
    return owner[:n][inside], code[inside]


def bundles(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, bundles of the documents between, zero without a letter) of each block; long texts make a block end sooner."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and last - first < BLOCK and size < CHARACTERS:
            size += len(texts[last])
            last += 1
        owner, code = grams([f" {t} " for t in texts[first:last]])
        used, place = np.unique(code, return_inverse=True)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        out = np.zeros((last - first, DIMENSIONS), np.float32)
        for low in range(0, len(used), GRAMS):
            s, e = np.searchsorted(place, [low, low + GRAMS])
            n = min(GRAMS, len(used) - low)
            counts = np.bincount(owner[s:e] * n + place[s:e] - low, minlength=(last - first) * n).reshape(-1, n)
            out += counts.astype(np.float32) @ gram_vectors(used[low : low + n])
        yield first, last, out
        first = last


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language. A task holds and sends DIMENSIONS numbers a language; the driver gets as many, whatever the documents."""
    rows = docs.where(F.col(lang).isNotNull() & (F.col(lang) != "")).select(text_of(text).alias("text"), F.col(lang).cast("string").alias("lang"))

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            langs = pdf["lang"].to_numpy()
            for first, last, bundle in bundles(pdf["text"].tolist()):
                norm = np.linalg.norm(bundle.astype(np.float64), axis=1, keepdims=True)
                unit = np.rint(bundle / np.maximum(norm, 1e-9) * SCALE).astype(np.int64)
                for one in set(langs[first:last]):
                    total.setdefault(one, np.zeros(DIMENSIONS, np.int64))
                    total[one] += unit[langs[first:last] == one].sum(0)
        for one, vector in total.items():
            yield pd.DataFrame({"lang": one, "place": np.arange(DIMENSIONS), "share": vector})

    sums = rows.mapInPandas(profile, "lang string, place int, share long").groupBy("lang", "place").agg(F.sum("share").alias("share")).toPandas()
    out = {}
    for one, part in sums.groupby("lang"):
        vector = np.zeros(DIMENSIONS)
        vector[part["place"]] = part["share"]
        if norm := np.linalg.norm(vector):
            out[str(one)] = (vector / norm).astype(np.float32)
    return dict(sorted(out.items(), key=lambda x: x[0].encode()))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (the cosine, 0 at least) of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    names = np.array([*prototypes, UNDETERMINED], object)
    matrix = np.stack(list(prototypes.values())) if prototypes else np.zeros((0, DIMENSIONS), np.float32)

    def work(texts: list[str]) -> dict:
        best, value = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
        for first, last, bundle in bundles(texts) if len(matrix) else ():
            norm = np.linalg.norm(bundle, axis=1)
            cosine = (bundle @ matrix.T) / np.maximum(norm, 1e-9)[:, None]
            top = cosine.argmax(1)
            best[first:last] = np.where(norm > 0, top, len(names) - 1)
            value[first:last] = np.where(norm > 0, np.clip(cosine[np.arange(last - first), top], 0, 1), 0)
        return {"lang_pred": names[best], "score": value}

    return map_texts(rows, "lang_pred string, score double", lambda: work)
