"""Mixing sources to target weights by iterative proportional fitting.

Token totals of all documents fill a table of cells (source, language, topic).
Raking scales the cells until their source, language and topic shares meet the
targets; a cell's factor, times one scale for the whole, is the probability with
which its documents are kept. Each document's draw is a hash of its id (without one, of its text) and the
seed, so a lost task draws the same documents again.

Targets name the values they weigh; all other values share the cell `*`, so the
table has at most (sources + 1) x (languages + 1) x (topics + 1) cells and may
go to the driver. A target value without tokens is left out and the others are
scaled up; `*` without a target keeps its observed share.

Defined results: null text counts as empty (no tokens); null source or language
falls under `*`; a document without tokens has its cell's probability like any
other. Rows with one id share their draw, as do rows without one that have one text. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import stored, text_of, words_of

OTHER = "*"
DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Targets:
    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]


def default_topic(text: Column) -> Column:
    """A register for a topic, from the whole text: `listing` (pipes or bullets), `reference` (digits), `dialogue` (quotes, questions), else `prose`, by marks for each hundred characters."""
    size = F.greatest(F.length(text), F.lit(1))

    def share(marks: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, marks, ""))) * 100 / size

    return F.when(share("[|•*#]") >= 1, "listing").when(share("[0-9]") >= 1, "reference").when(share(r"[?!\x22]") >= 1, "dialogue").otherwise("prose")


def _grouped(column: Column, target: dict[str, float]) -> Column:
    return F.when(column.isin(list(target)), column).otherwise(F.lit(OTHER))


def classified(targets: Targets, doc_id: str, text: str, source: str, lang: str, topic: Column | None, seed: int) -> list[Column]:
    """Columns for the id, the draw (0 to 1, by the id, or by the text of a row without one), the tokens and the cell of a document."""
    t = text_of(text)
    parts = {"source": F.col(source).cast("string"), "lang": F.col(lang).cast("string"), "topic": topic if topic is not None else default_topic(t)}
    draw = F.xxhash64(F.lit(seed), F.col(doc_id), F.when(F.col(doc_id).isNull(), t)) / F.lit(2.0**64) + 0.5
    return [F.col(doc_id).alias("mix_id"), draw.alias("mix_draw"), F.size(words_of(t)).cast("long").alias("tokens"), *[_grouped(parts[d], getattr(targets, d)).alias(f"mix_{d}") for d in DIMENSIONS]]


def rake(cells: np.ndarray, shares: list[np.ndarray], tolerance: float = 1e-10, rounds: int = 500) -> np.ndarray:
    """Cells scaled in turn along each axis until every marginal has its share of the total.

    `cells` has one axis for each list of shares. Values without mass keep none;
    their shares go to the others in proportion.
    """
    fitted = cells / max(cells.sum(), 1e-300)
    wanted = []
    for axis, share in enumerate(shares):
        mass = fitted.sum(tuple(i for i in range(fitted.ndim) if i != axis))
        share = np.where(mass > 0, share, 0.0)
        wanted.append(share / share.sum() if share.sum() else mass)
    for _ in range(rounds):
        worst = 0.0
        for axis, share in enumerate(wanted):
            mass = fitted.sum(tuple(i for i in range(fitted.ndim) if i != axis))
            factor = np.divide(share, mass, out=np.ones_like(mass), where=mass > 0)
            worst = max(worst, np.abs(mass - share).max(initial=0.0))
            fitted = fitted * factor.reshape([-1 if i == axis else 1 for i in range(fitted.ndim)])
        if worst < tolerance:
            break
    return fitted


def cell_probabilities(totals: list, targets: Targets, keep: float) -> list[tuple]:
    """(source, lang, topic, weight, probability, residuals of its three groups) of each cell: `keep` is the wanted share of all tokens.

    Probabilities stop at 1; what a full cell can't give is spread over the
    others by one common scale, found by halving. A group's residual is its
    expected share of the drawn tokens less its target; residuals other than 0
    tell that targets contradict each other or that a group is too scarce.
    """
    # A target for the other values is theirs alone, and not one of a named value.
    names = [[*sorted(v for v in getattr(targets, d) if v != OTHER), OTHER] for d in DIMENSIONS]
    cells = np.zeros([len(n) for n in names])
    for row in totals:
        cells[tuple(n.index(row[d]) for n, d in zip(names, DIMENSIONS, strict=True))] += row["tokens"]
    if not cells.sum():
        return [(row["source"], row["lang"], row["topic"], 0.0, 1.0, 0.0, 0.0, 0.0) for row in totals]
    shares = []
    for axis, (d, values) in enumerate(zip(DIMENSIONS, names, strict=True)):
        target = getattr(targets, d)
        observed = cells.sum(tuple(i for i in range(3) if i != axis)) / cells.sum()
        rest = target.get(OTHER, observed[-1])
        named = np.array([target[v] for v in values[:-1]])
        shares.append(np.append(named / max(named.sum(), 1e-300) * (1 - rest), rest))
    fitted = rake(cells, shares)
    ratio = np.divide(fitted * cells.sum(), cells, out=np.zeros_like(cells), where=cells > 0)
    low, high = 0.0, 1.0 / max(ratio[cells > 0].min(), 1e-12)
    for _ in range(200):
        middle = (low + high) / 2
        if (np.minimum(1.0, ratio * middle) * cells).sum() < keep * cells.sum():
            low = middle
        else:
            high = middle
    chance = np.minimum(1.0, ratio * high)
    expected = chance * cells
    residuals = [expected.sum(tuple(i for i in range(3) if i != axis)) / max(expected.sum(), 1e-300) - share for axis, share in enumerate(shares)]
    found = []
    for row in totals:
        at = tuple(n.index(row[d]) for n, d in zip(names, DIMENSIONS, strict=True))
        # Documents without tokens in a cell without tokens: nothing to balance, so all stay.
        found.append((row["source"], row["lang"], row["topic"], float(fitted[at]), float(chance[at]) if cells[at] else 1.0, *[float(r[i]) for r, i in zip(residuals, at, strict=True)]))
    return found


def _drawn(rows: DataFrame, targets: Targets, keep: float) -> DataFrame:
    """`rows` (with tokens, the draw and the cell's columns, prefixed) with weight, probability, residuals and selected."""
    names = [f"mix_{d}" for d in DIMENSIONS]
    totals = [dict(zip([*DIMENSIONS, "tokens"], r, strict=True)) for r in rows.groupBy(*names).agg(F.sum("tokens")).orderBy(*names).collect()]
    schema = "mix_source string, mix_lang string, mix_topic string, weight double, probability double, source_residual double, lang_residual double, topic_residual double"
    cells = rows.sparkSession.createDataFrame(cell_probabilities(totals, targets, keep) if totals else [], schema)
    # Cells are bounded by the targets, so this side is always small.
    return rows.join(F.broadcast(cells), names).withColumn("selected", F.col("mix_draw") < F.col("probability"))


def mix(docs: DataFrame, targets: Targets, keep: float, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None) -> DataFrame:
    """doc_id, tokens, source, lang and topic group, weight (the cell's share of the mixture), probability, selected and the groups' residuals.

    Texts are read once; the few numbers of each row are stored."""
    rows = stored(docs.select(*classified(targets, doc_id, text, source, lang, topic, seed)), "mixture")
    return _drawn(rows, targets, keep).select(F.col("mix_id").alias("doc_id"), "tokens", *[F.col(f"mix_{d}").alias(d) for d in DIMENSIONS], "weight", "probability", "selected", *[f"{d}_residual" for d in DIMENSIONS])


def drawn(docs: DataFrame, targets: Targets, keep: float, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None) -> DataFrame:
    """The rows of `docs` that the mixture keeps, with all their columns. Texts are read twice, which costs less than to store or shuffle them."""
    inner = [F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), *classified(targets, doc_id, text, source, lang, topic, seed)]
    return _drawn(docs.select(*inner), targets, keep).where("selected").select("doc.*")
