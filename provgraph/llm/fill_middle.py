"""Fill-in-middle transformation with DataFrame functions only.

A text is an array of code points (units), two cuts drawn from a hash of its id
part it into prefix, middle and suffix, and sentinels mark the parts in their
new order: prefix, suffix, middle (psm) or suffix, prefix, middle (spm). What the
sentinels part is split again to restore the text.

The array of units has two levels, so that a very long text needs no object for
each of its code points: runs of RUN units, and the single units of the two runs
that a cut falls in. Both come from `regexp_extract_all`, whose dot takes whole
code points.

Defined results: null text counts as empty; a null id hashes as an empty text;
empty texts and texts that hold a sentinel stay plain; rows that share an id
share their draws (the cuts follow from these and the length); other columns are
ignored. Sentinels must not overlap one another, otherwise parsing could go wrong.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import text_of

#: Units of one run of the array's upper level.
RUN = 256


@dataclass(frozen=True)
class Plan:
    """How texts are arranged: percentages of texts that are (at most), and of those that come suffix first; seed and sentinels."""

    arranged: int = 90
    spm: int = 20
    seed: int = 1
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) < len(marks):
            raise ValueError("sentinels must differ")
        for a, b in [*permutations(marks, 2), *zip(marks, marks, strict=True)]:
            if not a or (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    @property
    def pattern(self) -> str:
        return "|".join(rf"\Q{m}\E" for m in self.marks)


def _draw(doc_id: str, seed: int, group: int) -> Column:
    """One of the 8-digit groups of the hash of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def _pieces(text: Column, units: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{units}"), F.lit(0))


def _joined(*parts: Column) -> Column:
    return F.array_join(F.concat(*parts), "")


def arranged(docs: DataFrame, plan: Plan = Plan(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, n (code points), form, prefix_chars, middle_chars (null if plain) and output, one row for each of `docs`."""
    t = text_of(text)
    n = F.length("text").cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), *[_draw(doc_id, plan.seed, g).alias(f"h{g}") for g in (1, 2, 3, 4)]).withColumn("n", n)
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    marked = F.lit(False)
    for mark in plan.marks:
        marked |= F.col("text").contains(mark)
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= plan.arranged)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < plan.spm, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(first, second).alias("low"), F.greatest(first, second).alias("high"))
    cut = F.col("form") != "plain"
    rows = rows.withColumn("runs", F.when(cut, _pieces(F.col("text"), f"{{1,{RUN}}}")))
    at = {c: ((F.col(c) / RUN).cast("int"), (F.col(c) % RUN).cast("int")) for c in ("low", "high")}
    # A cut at the end of the last run is in no run: nothing is left of it there.
    rows = rows.withColumns({f"{c}_units": F.when(cut, _pieces(F.coalesce(F.get("runs", at[c][0]), F.lit("")), "")) for c in at})
    (i, a), (j, b) = at["low"], at["high"]
    parts = {
        "prefix": _joined(F.slice("runs", F.lit(1), i), F.slice("low_units", F.lit(1), a)),
        "middle": F.when(i == j, F.array_join(F.slice("low_units", a + 1, b - a), "")).otherwise(
            _joined(F.slice("low_units", a + 1, F.lit(RUN)), F.slice("runs", i + 2, j - i - 1), F.slice("high_units", F.lit(1), b))
        ),
        "suffix": _joined(F.slice("high_units", b + 1, F.lit(RUN)), F.slice("runs", j + 2, F.size("runs"))),
    }
    rows = rows.withColumns({k: F.when(cut, p) for k, p in parts.items()})
    part = {k: (F.lit(getattr(plan, k)), F.col(k)) for k in parts}
    psm, spm = ([*part[x], *part[y], *part["middle"]] for x, y in (("prefix", "suffix"), ("suffix", "prefix")))
    output = F.when(F.col("form") == "psm", F.concat(*psm)).when(F.col("form") == "spm", F.concat(*spm)).otherwise(F.col("text"))
    return rows.select("doc_id", "text", "n", "form", F.when(cut, F.col("low")).alias("prefix_chars"), F.when(cut, F.col("high") - F.col("low")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text that an output was made from: what the sentinels part, in its first order."""
    parts = F.split(output, plan.pattern, -1)

    def ordered(prefix: int, suffix: int) -> Column:
        return F.concat(*[F.coalesce(F.get(parts, F.lit(k)), F.lit("")) for k in (prefix, 3, suffix)])

    return F.when(form == "psm", ordered(1, 2)).when(form == "spm", ordered(2, 1)).otherwise(output)


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of the output and of the text rebuilt from it."""
    rows = arranged(docs, plan, doc_id, text).withColumn("restored", restored(F.col("output"), F.col("form"), plan))
    hashes = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


ORACLE_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    [CAST('0x' || substring(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), g, 8) AS BIGINT) FOR g IN [1, 9, 17, 25]] AS h
  FROM documents
), cut AS (
  SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), laid AS (
  SELECT *, '<P>' || substring(t, 1, low) AS p, '<S>' || substring(t, high + 1) AS s, '<M>' || substring(t, low + 1, high - low) AS m FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(low AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(high - low AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM laid
"""
