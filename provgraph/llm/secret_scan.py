"""Secret scans by assignment-aware lexing.

Base patterns find assignments to sensitive names, access ids and long hex
runs. The lexer adds what they miss: it reads every operator of source and
configuration syntax as a name-literal pair, carries constants from one name to
the next, and scores each literal by the sensitivity of the names it reaches.
Names above a nested mapping (JSON braces, YAML indentation) lend theirs, and so
does the name of a call to its literal arguments. Assignments form a graph in
which a literal is one node however often it is repeated, so that the work is in
proportion to the text.

Spans are code points, end exclusive. Defined results: null text counts as
empty and has no spans; texts of any length are read whole; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import map_texts, text_of

KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Sensitivity of the parts of a name; the most sensitive part or pair of parts counts.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "pwd": 0.9,
    "passphrase": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.8,
    "authorization": 0.8,
    "auth": 0.6,
    "private key": 1.0,
    "api key": 1.0,
    "access key": 1.0,
    "signing key": 0.9,
    "encryption key": 0.9,
    "connection string": 0.7,
}
#: Parts that say that a literal only describes a secret.
DULL = {"name", "file", "path", "url", "type", "length", "count", "field", "id", "label", "hint", "policy"}
PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|<.*>|\{\{?.*\}?\}|%.*%|change_?me|example.*|your[_-].*|dummy|test|none|null|true|false|todo|redacted)$", re.IGNORECASE)
OPERATOR = re.compile(r"=>|:=|(?<![=!<>])=(?!=)|:(?!:)")
NAME_CHARS = re.compile(r"[\w.$-]")
LITERAL = re.compile(r"""[ \t]*+(?:(?P<q>["'`])(?P<s>(?:\\.|(?!(?P=q))[^\\\n])*+)(?P=q)|(?=[^\s"'`,;<>(){}\[\]#]))""")
BARE_END = re.compile(r"""[\s"'`,;<>(){}\[\]#]|$(?!\n)""")
MORE = re.compile(r"[ \t]*+(?:\+|\.\.?+)[ \t]*+(?=[\"'`\w$])")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: What may follow the operator of a nested mapping: a brace, a comment, or the end of the line. Runs here and below are possessive, and a name is read from its beginning only, so that no text makes the search go over a run twice.
OPENS = re.compile(r"[ \t]*+(?:(?P<brace>\{(?!\{))|#|\r?(?:\n|$))")
#: A call with a literal as its only or second argument, after the name of what it sets.
CALL = re.compile(r"""(?<![\w.])(?P<name>[\w.]++)(?:\([ \t]*+["'](?P<key>[\w.-]{1,80}+)["'][ \t]*+,)?[ \t]*+(?:\([ \t]*+)?(?P<q>["'])(?P<s>[^"'\\\n]{6,400}+)(?P=q)[ \t]*+\)""")
LEAST_SCORE = 0.5
#: Characters of a joint value by which its strength is judged.
JUDGED = 256


def _parts(name: str) -> list[str]:
    return [p.lower() for p in PART.findall(name)]


def name_weight(name: str) -> float:
    """Sensitivity of a target name: the most sensitive part or pair, halved by a dull last part."""
    parts = _parts(name)
    if not parts:
        return 0.0
    keys = parts + [f"{a} {b}" for a, b in zip(parts, parts[1:], strict=False)]
    weight = max(SENSITIVE.get(k, 0.0) for k in keys)
    return weight * (0.4 if parts[-1] in DULL else 1.0)


def literal_strength(value: str) -> float:
    """0 for placeholders and short literals, up to 1 for long ones of many different characters."""
    if len(value) < 6 or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, entropy / 3.0) * min(1.0, 0.5 + n / 16)


def _name_before(text: str, at: int) -> str:
    """The identifier that ends before `at`, quotes and spaces aside."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    if end and text[end - 1] in "\"'`":
        end -= 1
    start = end
    while start and NAME_CHARS.match(text[start - 1]):
        start -= 1
    return text[start:end].strip(".-")


class _Node:
    """What one assignment gives its name: literals and other assignments, in order, and the beginning of their joint value."""

    __slots__ = ("parts", "seen", "value")

    def __init__(self, parts: list, value: str):
        self.parts, self.value, self.seen = parts, value, False


class _Bare:
    """Ends of bare literals, and what adjoins another to them; places come in ascending order, and one run of characters is searched once."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.last = text, 0, -1, -1
        self.asked, self.more = -1, None

    def end_of(self, start: int) -> int:
        if not self.start <= start < self.end:
            self.start, self.end = start, BARE_END.search(self.text, start).start()
            self.last = self.end
            while self.last > start and self.text[self.last - 1] == ".":
                self.last -= 1
        return max(start, self.last)

    def more_at(self, at: int) -> int | None:
        """Where the literal begins that is joined to one ending at `at`."""
        if at != self.asked:
            found = MORE.match(self.text, at)
            self.asked, self.more = at, found and found.end()
        return self.more


def _expression(text: str, at: int, known: dict, runs: _Bare) -> _Node | None:
    """What reaches the target of an operator ending at `at`: adjoined literals as spans, names by what they hold."""
    parts: dict = {}
    value = ""
    while m := LITERAL.match(text, at):
        if m["q"] is not None:
            part, held = (m.start("s"), m.end("s")), text[m.start("s") : min(m.end("s"), m.start("s") + JUDGED)]
            at = m.end()
        else:
            start, end = m.end(), runs.end_of(m.end())
            part, held = (start, end), text[start : min(end, start + JUDGED)]
            if end - start < JUDGED and (node := known.get(held.strip("${}%"))) is not None:
                part, held = node, node.value
            at = runs.end
        if part not in parts:
            parts[part] = None
            if len(value) < JUDGED:
                value = (value + held)[:JUDGED]
        if (more := runs.more_at(at)) is None:
            break
        at = more
    return _Node(list(parts), value) if parts else None


def _literals(node: _Node) -> Iterator[tuple[int, int]]:
    """Spans that reach a node, those of nodes seen before left out."""
    todo = [node]
    while todo:
        part = todo.pop()
        if isinstance(part, tuple):
            yield part
        elif not part.seen:
            part.seen = True
            todo += part.parts


class _Nesting:
    """The largest sensitivity among the names above a place of the text, which is read forwards."""

    def __init__(self, text: str):
        self.text, self.at, self.line, self.depth = text, 0, 0, 0
        self.above: list[tuple[bool, int, float]] = []  # by braces, depth or indentation, weight

    def weight(self, place: int) -> float:
        passed = self.text[self.at : place]
        self.depth += passed.count("{") - passed.count("}")
        if (end := passed.rfind("\n")) >= 0:
            self.line = self.at + end + 1
        self.at = place
        indent = self._indent()
        while self.above and (self.depth < self.above[-1][1] if self.above[-1][0] else self.depth == 0 and indent <= self.above[-1][1]):
            self.above.pop()
        return self.above[-1][2] if self.above else 0.0

    def _indent(self) -> int:
        at = self.line
        while at < self.at and self.text[at] in " \t-" and at - self.line < 200:
            at += 1
        return at - self.line

    def opened(self, after: int, weight: float) -> bool:
        """Whether the operator that ends at `after` opens a nested mapping."""
        m = OPENS.match(self.text, after)
        if not m:
            return False
        held = max(weight, self.above[-1][2] if self.above else 0.0)
        self.above.append((True, self.depth + 1, held) if m["brace"] else (False, self._indent(), held))
        return True


def named_literals(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that sensitive names receive, directly or through constants."""
    known: dict[str, _Node] = {}
    found: list[tuple[float, _Node]] = []
    nesting, runs = _Nesting(text), _Bare(text)
    for m in OPERATOR.finditer(text):
        name = _name_before(text, m.start())
        if not name or name[0].isdigit():
            continue
        weight = name_weight(name)
        above = nesting.weight(m.start())
        if nesting.opened(m.end(), weight):
            continue
        node = _expression(text, m.end(), known, runs)
        if node is None:
            continue
        known[name] = node
        dull = 0.4 if weight == 0 and _parts(name)[-1:] and _parts(name)[-1] in DULL else 0.8
        found.append((max(weight, dull * above), node))
    for m in CALL.finditer(text) if "(" in text else ():
        found.append((name_weight(m["key"] or m["name"]), _Node([(m.start("s"), m.end("s"))], m["s"])))
    scored = [(w * literal_strength(node.value), node) for w, node in found if w]
    best: dict[tuple[int, int], float] = {}
    # From the best score down, each node's literals are looked up once.
    for score, node in sorted(scored, key=lambda x: -x[0]):
        if score < LEAST_SCORE:
            break
        for span in _literals(node):
            best.setdefault(span, score)
    return [(s, e, score) for (s, e), score in best.items() if e > s]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    if "=" in text or ":" in text:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_spans(text: str) -> tuple[list, list]:
    """Base spans, and all spans; a literal inside a base span adds nothing."""
    base = base_spans(text)
    extra = []
    if "=" in text or ":" in text or "(" in text:
        starts = sorted((b, e) for _, b, e in base)
        reach = list(accumulate((e for _, e in starts), max))

        def inside(s: int, e: int) -> bool:
            before = bisect_right(starts, (s, math.inf))
            return before > 0 and reach[before - 1] >= e

        extra = [("named", s, e) for s, e, _ in named_literals(text) if not inside(s, e)]
    return _ordered(base), _ordered(base + extra)


def render(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """`text` with the union of the spans replaced, each stretch by one mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every secret of `text` replaced by a mark; null texts stay null, other columns as they are.

    The scan runs as a function of the text alone, so that rows need no key."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t, find_spans(t)[1]))

    # Without an operator, a call or a long run of hex digits there is nothing to find.
    some = F.col(text).rlike(r"[=:(]|AKIA|[0-9a-f]{24}")
    return docs.withColumn(text, F.when(some, mask(F.col(text))).otherwise(F.col(text)))


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_named."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def work(texts: list[str]) -> dict:
        found = [find_spans(t) for t in texts]
        counts = [Counter(k for k, _, _ in spans) for _, spans in found]
        return {f"n_{k}": [c[k] for c in counts] for k in KINDS} | {"base_sha256": [hashlib.sha256(render(base).encode()).hexdigest() for base, _ in found], "spans": [render(spans) for _, spans in found]}

    return map_texts(rows, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_named long", lambda: work)
