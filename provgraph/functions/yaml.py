"""Block YAML to its leaves: the subset that data files are written in, without anchors, tags and nested flow collections."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A leaf: keys joined by dots with [] for lists, the places in those lists, and the text.
LEAVES = "array<struct<path:string,place:array<int>,value:string>>"
_KEY = re.compile(r"""((?:'[^']*'|"[^"]*"|[^\s'"#\[\]{},&*!|>%@`-][^:#]*?|-[^\s:#][^:#]*?))\s*:(?:\s+(.*))?$""")
_ESCAPE = re.compile(r'\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|U([0-9a-fA-F]{8})|(.))', re.S)
#: One-letter escapes of quoted texts, and the words for nothing.
_LETTERS = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b", " ": " ", '"': '"', "/": "/", "\\": "\\"}
_NOTHING = ("", "~", "null", "Null", "NULL")


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" "))


def _unescaped(text: str) -> str:
    def one(m: re.Match) -> str:
        code = m[1] or m[2] or m[3]
        if code:
            return chr(int(code, 16))
        if m[4] not in _LETTERS:
            raise ValueError(f"escape {m[0]!r}")
        return _LETTERS[m[4]]

    return _ESCAPE.sub(one, text)


def _folded(parts: list[str]) -> str:
    """Lines of a scalar as one text: a break is a blank, empty lines are breaks."""
    out, breaks = [parts[0]], 0
    for part in parts[1:]:
        if part == "":
            breaks += 1
            continue
        out.append("\n" * breaks if breaks else " ")
        out.append(part)
        breaks = 0
    return "".join(out)


def _closing(text: str, quote: str) -> int:
    """Where the quote that opens a text ends, or -1."""
    i = 1
    while i < len(text):
        if quote == '"' and text[i] == "\\":
            i += 2
        elif text[i] == quote:
            if quote == '"' or text[i + 1 : i + 2] != "'":
                return i
            i += 2
        else:
            i += 1
    return -1


class _Lines:
    def __init__(self, source: str):
        self.all = source.replace("\r\n", "\n").split("\n")
        self.at = 0

    def deeper(self, column: int) -> str | None:
        """The next line if it is empty or stands further right than a column."""
        if self.at < len(self.all) and (not self.all[self.at].strip() or _indent(self.all[self.at]) > column):
            self.at += 1
            return self.all[self.at - 1]
        return None

    def block(self, header: str, column: int) -> str:
        taken = []
        while (line := self.deeper(column)) is not None:
            taken.append(line)
        margin = min((_indent(x) for x in taken if x.strip()), default=0)
        taken = [x[margin:] if x.strip() else "" for x in taken]
        last = len(taken)
        while last and taken[last - 1] == "":
            last -= 1
        body, tail = taken[:last], len(taken) - last
        text = "" if not body else "\n".join(body) if header[0] == "|" else _folded(body)
        if not body or "-" in header:
            return text
        return text + "\n" * (1 + tail if "+" in header else 1)

    def quoted(self, start: str) -> str:
        """A text in quotes, over as many lines as it takes. Only the part read last is searched, so long texts stay linear."""
        quote, done = start[0], []
        rest, end = start, _closing(start, start[0])
        while end < 0:
            done.append(rest if not done else rest[1:])
            if self.at == len(self.all):
                raise ValueError("a quote isn't closed")
            rest, self.at = quote + self.all[self.at].strip(), self.at + 1
            end = _closing(rest, quote)
        if (after := rest[end + 1 :].strip()) and not after.startswith("#"):
            raise ValueError("text after a quote")
        parts = [*done, rest[:end] if not done else rest[1:end]]
        text = _folded([parts[0][1:].rstrip() if done else parts[0][1:], *[p.rstrip() if i < len(parts) - 2 else p for i, p in enumerate(parts[1:])]])
        return _unescaped(text) if quote == '"' else text.replace("''", "'")

    def plain(self, start: str, column: int) -> str:
        parts = [re.sub(r"\s+#.*$", "", start).strip()]
        while (line := self.deeper(column)) is not None:
            if line.strip().startswith("#"):
                break
            parts.append(line.strip())
        while parts and parts[-1] == "":
            parts.pop()
        return _folded(parts)


def leaves(source: str | bytes | None) -> list[tuple[str, list[int], str]] | None:
    """The texts of a document in order; null for what can't be read. Nothing, empty lists and empty values have no leaf."""
    if source is None:
        return None
    try:
        return _leaves(source.decode("utf-8") if isinstance(source, (bytes, bytearray)) else source)
    except ValueError:
        return None


def _leaves(source: str) -> list[tuple[str, list[int], str]]:
    lines, out, seen = _Lines(source), [], set()
    #: Open keys and lists: depth (twice the column, one more for a list, so that a list may stand below its key), path, place.
    stack: list[tuple[int, str, list[int]]] = [(-1, "", [])]

    def leaf(path: str, place: list[int], value: str) -> None:
        if (key := (path, *place)) in seen:
            raise ValueError(f"{path} stands twice")
        seen.add(key)
        out.append((path, place, value))

    while lines.at < len(lines.all):
        line = lines.all[lines.at]
        lines.at += 1
        rest = line.strip()
        if not rest or rest[0] in "#%" or rest in ("---", "..."):
            continue
        column = _indent(line)
        if "\t" in line[: len(line) - len(line.lstrip())]:
            raise ValueError("tabs indent nothing")
        held = column - 1
        while rest == "-" or rest.startswith("- "):
            depth = 2 * column + 1
            while stack[-1][0] > depth:
                stack.pop()
            if stack[-1][0] == depth:
                _, path, place = stack.pop()
                stack.append((depth, path, [*place[:-1], place[-1] + 1]))
            else:
                stack.append((depth, stack[-1][1] + "[]", [*stack[-1][2], 0]))
            held = column
            inner = rest[1:].lstrip()
            column, rest = column + len(rest) - len(inner), inner
        if found := _KEY.match(rest):
            depth = 2 * column
            while stack[-1][0] >= depth:
                stack.pop()
            name = found[1][1:-1] if found[1][0] in "'\"" else found[1]
            stack.append((depth, f"{stack[-1][1]}.{name}" if stack[-1][1] else name, stack[-1][2]))
            rest, held = (found[2] or "").strip(), column
        _, path, place = stack[-1]
        if not rest or rest[0] == "#":
            continue
        if rest[0] in "&*!@`?{" and rest != "{}":
            raise ValueError(f"{rest[0]} isn't read")
        if rest[0] in "|>":
            leaf(path, place, lines.block(rest, held))
        elif rest[0] in "'\"":
            leaf(path, place, lines.quoted(rest))
        elif rest[0] == "[":
            if not rest.endswith("]") or any(c in rest[1:-1] for c in "[]{}'\""):
                raise ValueError("only flat lists on one line are read")
            for i, item in enumerate(x.strip() for x in rest[1:-1].split(",") if x.strip()):
                leaf(path + "[]", [*place, i], item)
        elif rest != "{}" and (value := lines.plain(rest, held)) not in _NOTHING:
            leaf(path, place, value)
    return out


def yaml_leaves(content: Column) -> Column:
    return F.udf(leaves, LEAVES, useArrow=True)(content)
