"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported speech, other)
with weights. Five weighted transducers read a clause's symbols and pass them on
with factors; they are composed once, into one machine whose arcs carry the
products, and every clause is run through that machine: a denied or reported
insult counts less, one aimed at a target more, one without a target half, and a
threat without a target nothing. Whether a clause has a target is known at its
end only, so the machine is nondeterministic: it has one path for each case, and
only the right one is accepted. Documents are scored by their matched clauses.

The grammar's insult lexicon is fixed words plus word beginnings learned from
labelled documents; a logistic curve turns clause weights into a score. It is
fitted to the labelled documents of each half by a lexicon of the other half,
which has not seen them. Learning takes at
most `SAMPLE` labelled documents, by the order of a hash of their ids; its
tables are bounded by `LEXICON`.

Defined results: null text counts as empty; a text without matched clauses has
the curve's value at zero. Where no labels of both kinds exist, the fixed words
and a fixed curve are used. Repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import map_texts, stored, text_of

SAMPLE = 12_000
LEXICON = 3_000
#: Lengths of learned word beginnings; 0 stands for whole words.
BEGINNINGS = (4, 5, 6)
LEAST_DOCUMENTS = 3
LEAST_ODDS = 3.0

#: Fixed words of each symbol, with weights.
INSULTS = {"idiot": 3.0, "idiots": 3.0, "moron": 3.0, "morons": 3.0, "stupid": 2.5, "pathetic": 2.5, "worthless": 2.5, "disgusting": 2.5, "scum": 3.0, "trash": 2.5, "loser": 2.5, "losers": 2.5, "clown": 2.0, "imbecile": 3.0, "dumb": 2.0, "vermin": 3.0}
THREATS = {"kill": 2.0, "hurt": 1.5, "destroy": 1.5, "strangle": 2.5, "stab": 2.5, "shoot": 2.0, "beat": 1.0, "murder": 2.0, "hang": 1.0}
TARGETS = frozenset("you your yours yourself u he him she her they them their those these people everyone woman women man men tu vous toi te vos du dich dir ihr sie euch usted ustedes ellos ellas".split())
NEGATIONS = frozenset("not no never none nobody isn't aren't wasn't don't doesn't didn't won't cannot can't without kein keine nicht nie pas jamais aucun ni nunca".split())
REPORTS = frozenset("said says say called calls quoted quote wrote writes claimed claims reported alleged allegedly told asked sagte schrieb dit écrit dijo escribió".split())

SYMBOLS = 6
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(SYMBOLS)
#: How far a negation reaches, in words.
REACH = 3
CLAUSE_END = re.compile(r"[.!?;\n]")
#: Line ends are words of their own, which end clauses.
SPACES = {"\t": " ", "\n": " \n ", "\x0b": " ", "\x0c": " ", "\r": " "}
EDGES = ".,;:!?\"'()[]{}<>|#*$%&«»“”¡¿-_=/\\~`"


class Lexicon:
    """Symbols and weights of words; what was looked up once is kept."""

    def __init__(self, learned: dict[str, float] | None = None):
        self.learned = learned or {}
        self.seen: dict[str, tuple[int, float, bool]] = {}

    def __getitem__(self, raw: str) -> tuple[int, float, bool]:
        """Symbol, weight, and whether the word ends a clause."""
        if (found := self.seen.get(raw)) is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            found = self.seen[raw] = (*self._symbol(raw.lower().strip(EDGES)), CLAUSE_END.search(raw) is not None)
        return found

    def _symbol(self, word: str) -> tuple[int, float]:
        if word in THREATS:
            return THREAT, THREATS[word]
        if word in TARGETS:
            return TARGET, 0.0
        if word in NEGATIONS:
            return NEGATION, 0.0
        if word in REPORTS:
            return REPORT, 0.0
        weight = max([INSULTS.get(word, 0.0), *(self.learned.get(k, 0.0) for k in keys_of(word))])
        return (INSULT, weight) if weight else (OTHER, 0.0)


def keys_of(word: str) -> list[str]:
    """The whole word, marked, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


@dataclass(frozen=True)
class Machine:
    """A weighted transducer over symbols: arcs[state][symbol] is (next state, factor), or None where a path ends."""

    starts: tuple[int, ...]
    arcs: tuple[tuple[tuple[int, float] | None, ...], ...]
    finals: frozenset[int]


def machine(starts: tuple[int, ...], finals: set[int], states: int, arc: Callable[[int, int], tuple[int, float] | None]) -> Machine:
    return Machine(starts, tuple(tuple(arc(q, s) for s in range(SYMBOLS)) for q in range(states)), frozenset(finals))


def compose(a: Machine, b: Machine) -> Machine:
    """The machine that passes a symbol through both; only pairs of states that can be reached are made."""
    pairs = [(p, q) for p in a.starts for q in b.starts]
    number = {pair: i for i, pair in enumerate(pairs)}
    arcs, starts = [], tuple(range(len(pairs)))
    for p, q in pairs:  # grows while it is read
        row = []
        for x, y in zip(a.arcs[p], b.arcs[q], strict=True):
            if x is None or y is None:
                row.append(None)
                continue
            to = (x[0], y[0])
            if to not in number:
                number[to] = len(pairs)
                pairs.append(to)
            row.append((number[to], x[1] * y[1]))
        arcs.append(tuple(row))
    return Machine(starts, tuple(arcs), frozenset(i for i, (p, q) in enumerate(pairs) if p in a.finals and q in b.finals))


#: States of a machine that must know whether the clause has a target: it has none, it has one ahead, it has had one.
NONE, AHEAD, HAD = range(3)


def _aimed(symbol: int, without: float, with_: float) -> Machine:
    def arc(q: int, s: int) -> tuple[int, float] | None:
        if s == TARGET:
            return None if q == NONE else (HAD, 1.0)
        return q, (without if q == NONE else with_) if s == symbol else 1.0

    return machine((NONE, AHEAD), {NONE, HAD}, 3, arc)


#: Repeats of an insult within a clause count half each time, an eighth at least.
INSULT_MACHINE = machine((0,), {0, 1, 2, 3}, 4, lambda q, s: (min(q + 1, 3), 0.5**q) if s == INSULT else (q, 1.0))
#: A threat needs a target within its clause.
THREAT_MACHINE = _aimed(THREAT, 0.0, 1.0)
#: An insult with a target weighs half as much again, one without half.
TARGET_MACHINE = _aimed(INSULT, 0.5, 1.5)
#: States: words left in which a negation holds. What it reaches keeps a third.
NEGATION_MACHINE = machine((0,), set(range(REACH + 1)), REACH + 1, lambda q, s: (REACH, 1.0) if s == NEGATION else (max(q - 1, 0), 1 / 3 if q else 1.0))
#: States: plain, then reporting until the clause ends. Reported speech keeps half.
REPORT_MACHINE = machine((0,), {0, 1}, 2, lambda q, s: (int(q or s == REPORT), 0.5 if q or s == REPORT else 1.0))
GRAMMAR = reduce(compose, (INSULT_MACHINE, THREAT_MACHINE, TARGET_MACHINE, NEGATION_MACHINE, REPORT_MACHINE))

Tape = list[tuple[int, float]]  # symbol, weight


def clause_weight(tape: Tape, grammar: Machine = GRAMMAR) -> float:
    """Weights times factors, summed along the paths that the machine accepts."""
    total = 0.0
    for q in grammar.starts:
        weight = 0.0
        for symbol, w in tape:
            arc = grammar.arcs[q][symbol]
            if arc is None:
                break
            q = arc[0]
            weight += w * arc[1]
        else:
            total += weight if q in grammar.finals else 0.0
    return total


def clauses(text: str, lexicon: Lexicon) -> Iterator[tuple[int, float]]:
    """(number of the clause, weight) of each clause that holds a weighted symbol."""
    tape: Tape = []
    heavy = False
    number = gap = 0
    for mark, space in SPACES.items():
        text = text.replace(mark, space)
    for raw in text.split(" "):
        if not raw:
            continue
        symbol, weight, last = lexicon[raw]
        if symbol:
            # Other words only make a negation's reach shorter, so that no more than that of them matter.
            tape += [(OTHER, 0.0)] * min(gap, REACH)
            tape.append((symbol, weight))
            heavy = heavy or weight > 0
            gap = 0
        else:
            gap += 1
        if last:
            if heavy:
                yield number, clause_weight(tape)
            tape, heavy, gap = [], False, 0
            number += 1
    if heavy:
        yield number, clause_weight(tape)


def features(text: str, lexicon: Lexicon) -> tuple[float, float, float]:
    """Largest clause weight, total weight and matched clauses, the last two on a log scale."""
    weights = [w for _, w in clauses(text, lexicon)]
    return max(weights, default=0.0), math.log1p(sum(weights)), math.log1p(sum(w > 0 for w in weights))


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled texts, at most about SAMPLE of them, those with the smallest hashes; a document with two labels counts by the larger."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    place = F.xxhash64(F.lit("toxicity"), F.col("doc_id")) / F.lit(2.0**64) + 0.5
    share = min(1.0, SAMPLE / max(1, marks.count()))
    chosen = marks.where(place < share).withColumn("half", F.pmod(F.xxhash64(F.lit("lexicon"), "doc_id"), F.lit(2)).cast("int"))
    # Several passes read these few texts.
    return stored(docs.join(chosen, "doc_id").select("text", "toxic", "half"), "labelled")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Word beginnings that toxic documents hold far more often than others, weighted by their log odds."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                words = {w.lower().strip(EDGES) for w in set(text.split())}
                counts[toxic > 0].update({k for w in words if w for k in keys_of(w)})
        rows = [(k, n, counts[0][k]) for k, n in counts[1].items()] + [(k, 0, n) for k, n in counts[0].items() if k not in counts[1]]
        yield pd.DataFrame(rows, columns=["key", "toxic", "clean"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return {}
    odds = F.log((F.col("toxic") + 0.1) / (totals[True] + 0.2)) - F.log((F.col("clean") + 0.1) / (totals[False] + 0.2))
    found = (
        rows.mapInPandas(tally, "key string, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= max(LEAST_DOCUMENTS, totals[True] // 100)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("toxic"), "key").limit(LEXICON).select("key", "odds").collect()
    )
    return {r["key"]: round(min(r["odds"], 6.0), 3) for r in found}


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method; the constant comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
    return beta


FIXED_CURVE = (-4.0, 1.0, 1.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[dict[str, float], np.ndarray]:
    """(learned lexicon, curve) from labelled documents; labels has doc_id and toxic."""
    rows = _sampled(docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")), labels.select("doc_id", "toxic"))
    learned = learn_lexicon(rows)
    # The curve meets each text with the lexicon of the other half, as it will meet new texts.
    halves = [learn_lexicon(rows.where(F.col("half") != i)) for i in range(2)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicons = [Lexicon(x) for x in halves]
        for pdf in batches:
            yield pd.DataFrame([features(t, lexicons[i]) for t, i in zip(pdf["text"], pdf["half"], strict=True)], columns=["top", "total", "matched"]).assign(toxic=pdf["toxic"].to_numpy())

    points = rows.mapInPandas(measure, "top double, total double, matched double, toxic int").groupBy("top", "total", "matched", "toxic").count().toPandas()
    if points["toxic"].nunique() < 2:
        return learned, np.array(FIXED_CURVE)
    points = points.loc[points.index.repeat(points["count"])].sort_values(["top", "total", "matched", "toxic"])
    return learned, fit_curve(points[["top", "total", "matched"]].to_numpy(), (points["toxic"] > 0).to_numpy(float))


def score(docs: DataFrame, learned: dict[str, float], curve: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted, matched clauses and the weight of the heaviest."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def begin() -> Callable[[list[str]], dict]:
        lexicon = Lexicon(learned)

        def work(texts: list[str]) -> dict:
            x = np.array([features(t, lexicon) for t in texts]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(curve[0] + x @ curve[1:], -30, 30)))
            return {"score": p, "predicted": (p >= 0.5).astype("int32"), "clauses": np.rint(np.expm1(x[:, 2])).astype("int64"), "top_weight": x[:, 0]}

        return work

    return map_texts(rows, "score double, predicted int, clauses long, top_weight double", begin)
