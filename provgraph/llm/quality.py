"""Quality rules: line-first cleaning with DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed, and a document that loses more than `MOST_LOST` of its word
characters is rejected. Base counts of repetition reject documents beforehand.

Defined results: null text counts as empty; a text without words has no lines
that count, fails the base rule (fewer than `LEAST_WORDS` words) and is
rejected. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import SPACE, let, text_of, words_of

LEAST_WORDS = 50
MOST_REPEATED = 0.5
MOST_LOST = 0.5
SYMBOLS = "[#*$%&|<>]"
SEPARATORS = "[|>»›·•]"
#: Fixed phrases of page furniture.
BOILERPLATE = (
    "javascript",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "lorem ipsum",
    "click here",
    "sign up for",
    "subscribe to our",
    "powered by",
    "skip to content",
    "back to top",
)
WORD = r"[^\x20\x09-\x0D]"


def _times(text: Column, marks: str) -> Column:
    """How many characters of `text` are in the class `marks`; texts without any are only searched."""
    return F.when(text.rlike(marks), F.length(text) - F.length(F.regexp_replace(text, marks, ""))).otherwise(F.lit(0))


def _solid(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, ""))


def line_fails(line: Column) -> Column:
    """Punctuation: a long line without any mark, shouting marks, or mostly symbols.
    Navigation: three or more separators, one for every 30 characters at least.
    Boilerplate: a fixed phrase in a line of up to 200 characters. Lines without a word never fail.

    Counting is left to the few lines that hold a mark at all."""
    size = F.length(line)
    unmarked = (size >= 80) & ~line.rlike(r"[.!?:;,\x22')\]|]")
    doubled = (size - F.length(F.replace(line, F.lit("!!"), F.lit("!")))) * 20 >= size
    shouted = (line.contains("!!") & doubled) | (~line.rlike("[a-z]") & line.rlike("[A-Z]{4}.*[A-Z]{4}.*[A-Z]{4}"))
    symbols = line.rlike(SYMBOLS) & (_times(line, SYMBOLS) * 8 >= _solid(line))
    separators = _times(line, SEPARATORS)
    navigation = line.rlike(SEPARATORS) & (separators >= 3) & (separators * 30 >= size)
    boilerplate = (size <= 200) & let(F.lower(line), lambda low: reduce(or_, (low.contains(x) for x in BOILERPLATE)))
    return line.rlike(WORD) & (unmarked | shouted | symbols | navigation | boilerplate)


def _repeated(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more.

    Windows are compared by 64-bit hashes. Only texts that repeat one sort them:
    equal hashes are then neighbours, and the positions they cover are united.
    """

    def windows(w: Column) -> Column:
        n = F.size(w)
        return F.when(n >= 4, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def covered(s: Column) -> Column:
        def twin(k: Column) -> Column:
            own = F.get(s, k)["h"]
            return F.coalesce(F.get(s, k - 1)["h"] == own, F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == own, F.lit(False))

        hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), twin)
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda k: F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda d: F.get(s, k)["i"] + d)))))

    def count(h: Column) -> Column:
        again = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(again, let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)).otherwise(F.lit(0))

    return let(let(words, windows), count)


def measure(docs: DataFrame, text: str = "text", rest: bool = False) -> DataFrame:
    """`docs` with a struct column `quality`: the base counts and the verdicts; with `rest`, also the text without its failing lines."""
    t = text_of(text)

    def judged(x: Column) -> Column:
        def counted(flags: Column) -> Column:
            some = F.array_contains(flags, True)
            parts = [
                let(F.filter(x, lambda y: y.rlike(WORD)), lambda y: F.size(y) - F.size(F.array_distinct(y))).alias("dup"),
                F.when(some, _solid(F.array_join(F.filter(x, lambda y, i: F.get(flags, i)), ""))).otherwise(F.lit(0)).alias("lost"),
            ]
            if rest:
                parts.append(F.when(some, F.array_join(F.filter(x, lambda y, i: ~F.get(flags, i)), "\n")).alias("rest"))
            return F.struct(*parts)

        return let(F.transform(x, line_fails), counted)

    base = F.struct(
        let(words_of(t), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r"), F.length(F.array_join(w, "")).alias("chars"))).alias("w"),
        _times(t, SYMBOLS).alias("n_symbols"),
        let(F.split(t, "\n", -1), judged).alias("l"),
    )

    def verdict(b: Column) -> Column:
        n, r, total, lost = b["w"]["n"], b["w"]["r"], b["w"]["chars"], b["l"]["lost"]
        failed = (n < LEAST_WORDS) | (r > MOST_REPEATED * n)
        return F.struct(
            n.cast("long").alias("n_words"),
            total.cast("long").alias("word_chars"),
            b["n_symbols"].cast("long").alias("n_symbols"),
            b["l"]["dup"].cast("long").alias("n_dup_lines"),
            r.cast("long").alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (lost <= MOST_LOST * total)).alias("kept"),
            lost.cast("long").alias("lost_chars"),
            *([b["l"]["rest"].alias("rest")] if rest else []),
        )

    return docs.withColumn("quality", let(base, verdict))


def cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, without their failing lines; other columns as they are.

    The verdict passes through a generator of one row, so that the filter on it
    doesn't evaluate the rules a second time.
    """
    measured = measure(docs, text, rest=True).withColumn("quality", F.explode(F.array("quality")))
    return measured.where("quality.kept").withColumn(text, F.coalesce("quality.rest", F.col(text))).drop("quality")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base counts, base_failed, kept and lost_chars (word characters of removed lines)."""
    return measure(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "quality.*")


SPACE_SQL = r"[\x20\x09-\x0D]"
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '{SPACE_SQL}+'), lambda x: x <> '') AS ws FROM d),
p AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c FROM p),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat FROM g, range(0, 3) AS o(k) WHERE c >= 2 GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT rid, line, length(line) AS n, length(regexp_replace(line, '{SPACE_SQL}', '', 'g')) AS solid,
        length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
        length(line) - length(regexp_replace(line, '[|>»›·•]', '', 'g')) AS separators,
        length(line) - length(replace(line, '!!', '!')) AS shouts
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
v AS (SELECT rid, line, solid, ((n >= 80 AND NOT regexp_matches(line, '[.!?:;,\x22\x27)\]|]'))
        OR shouts * 20 >= n
        OR (NOT regexp_matches(line, '[a-z]') AND regexp_matches(line, '[A-Z]{{4}}.*[A-Z]{{4}}.*[A-Z]{{4}}'))
        OR symbols * 8 >= solid
        OR (separators >= 3 AND separators * 30 >= n)
        OR (n <= 200 AND regexp_matches(lower(line), '{"|".join(BOILERPLATE)}'))) AS fails FROM f),
s AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup, coalesce(sum(solid) FILTER (WHERE fails), 0) AS lost FROM v GROUP BY rid),
b AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{SPACE_SQL}', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
      FROM d JOIN w USING (rid) LEFT JOIN r USING (rid) LEFT JOIN s USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= {MOST_LOST} * word_chars AS kept,
  lost_chars
FROM b
"""
