"""Sinks: NDJSON lines, and batches over HTTP with retries."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.functions.text import float_text, json_text, time_text
from provgraph.operators.assemble import Graph

#: Attempts, first and longest pause in seconds, and statuses worth another attempt.
ATTEMPTS, FIRST_PAUSE, LONGEST_PAUSE = 4, 0.25, 30.0
RETRIED = {408, 429, 503}


def _value(v: Column) -> Column:
    return F.when(v["kind"] == "s", json_text(F.coalesce(v["s"], F.lit("")))).when(v["kind"] == "i", v["i"].cast("string")).when(v["kind"] == "b", v["b"].cast("string")).otherwise(float_text(v["f"], "json"))


def _props(id_: Column, props: Column) -> Column:
    each = F.transform(props, lambda p: F.concat(json_text(p["key"]), F.lit(":"), _value(p["value"])))
    return F.concat(F.lit('{"_id":'), json_text(id_), F.when(F.size(each) > 0, F.concat(F.lit(","), F.array_join(each, ","))).otherwise(""), F.lit("}"))


def _valid_from(at: Column) -> Column:
    return F.when(at.isNull(), "").otherwise(F.concat(F.lit(',"valid_from":"'), time_text(at), F.lit('"')))


def node_lines(nodes: DataFrame) -> DataFrame:
    """(id, line) of each node."""
    labels = F.concat(F.lit("["), F.array_join(F.transform(F.coalesce("labels", F.array().cast("array<string>")), json_text), ","), F.lit("]"))
    line = F.concat(F.lit('{"type":"node","labels":'), labels, F.lit(',"props":'), _props(F.col("id"), F.col("props")), _valid_from(F.col("valid_from")), F.lit("}"))
    return nodes.select("id", line.alias("line"))


def edge_lines(edges: DataFrame) -> DataFrame:
    """(id, line) of each edge."""
    ends = [F.concat(F.lit(f'"{n}":'), json_text(F.col(n)), F.lit(",")) for n in ("label", "src", "dst")]
    line = F.concat(F.lit('{"type":"edge",'), *ends, F.lit('"props":'), _props(F.col("id"), F.col("props")), _valid_from(F.col("valid_from")), F.lit("}"))
    return edges.select("id", line.alias("line"))


def write_ndjson(graph: Graph, path: str) -> None:
    """Two folders of lines, nodes before edges, each in the order of ids over all its files."""
    for name, lines in (("1-nodes", node_lines(graph.nodes)), ("2-edges", edge_lines(graph.edges))):
        lines.orderBy("id").select("line").write.mode("overwrite").text(f"{path}/{name}")


def pause(attempt: int, retry_after: str | None = None, now: datetime | None = None) -> float:
    """Seconds before the next attempt: what the server asks for, in seconds or as a date, else doubling from the first pause."""
    if retry_after and retry_after.strip().isdigit():
        return min(float(retry_after), LONGEST_PAUSE)
    try:
        until = parsedate_to_datetime(retry_after) if retry_after else None
    except ValueError:
        until = None
    if until is not None:
        until = until if until.tzinfo else until.replace(tzinfo=UTC)
        return min(max((until - (now or datetime.now(UTC))).total_seconds(), 0.0), LONGEST_PAUSE)
    return min(FIRST_PAUSE * 2 ** (attempt - 1), LONGEST_PAUSE)


class Refused(RuntimeError):
    """A batch that the server didn't take: its status (None without an answer), what it said, and what went through before."""

    def __init__(self, status: int | None, message: str, committed: dict | None = None):
        super().__init__(f"{status}: {message}")
        self.status, self.message, self.committed = status, message, committed or {}


def origin(url: str) -> str:
    """Scheme, host and port; ports are part of what is trusted."""
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.hostname or parts.username or parts.password:
        raise ValueError(f"not the address of a writer: {url!r}")
    return f"{parts.scheme}://{parts.netloc}".lower()


@dataclass(frozen=True)
class Writer:
    """Where batches go. Tokens and batches only ever reach the writer's own origin and those named as trusted."""

    address: str
    token: Callable[[], str]
    graph: str = ""
    trusted: tuple[str, ...] = ()
    attempts: int = ATTEMPTS

    def __post_init__(self):
        for url in (self.address, *self.trusted):
            origin(url)
        if any(urlsplit(t).path not in ("", "/") or urlsplit(t).query for t in self.trusted):
            raise ValueError("trusted writers are named by their origins")
        if self.graph.startswith("__"):
            raise ValueError("names of graphs mustn't start with __")

    def target(self, url: str) -> str:
        """`url` with this writer's graph, whatever graph it names itself."""
        parts = urlsplit(url)
        query = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k != "graph"] + ([("graph", self.graph)] if self.graph else [])
        return urlunsplit(parts._replace(query=urlencode(query)))

    def followed(self, url: str, location: str) -> str:
        """Where a redirect from `url` leads; refused unless it is trusted and as safe as before."""
        to = urljoin(url, location)
        allowed = {origin(u) for u in (self.address, *self.trusted)}
        try:
            known = origin(to) in allowed
        except ValueError:
            known = False
        if not known or (urlsplit(url).scheme == "https" and urlsplit(to).scheme != "https"):
            raise Refused(None, "redirected to a writer that isn't trusted")
        return self.target(to)


class _Still(urllib.request.HTTPRedirectHandler):
    """Redirects are answers like others: whoever asked decides."""

    def redirect_request(self, *args: object) -> None:
        return None


_OPENER = urllib.request.build_opener(_Still)
REDIRECTS, MOST_REDIRECTS = {307, 308, 421}, 10


def _once(writer: Writer, body: bytes) -> dict:
    """One attempt, redirects included; they keep the method and the body, and the token is asked for once."""
    url, headers = writer.target(writer.address.rstrip("/") + "/v1/ingest"), {"Content-Type": "application/x-ndjson", "Authorization": f"Bearer {writer.token()}"}
    for _ in range(MOST_REDIRECTS + 1):
        try:
            with _OPENER.open(urllib.request.Request(url, body, headers, method="POST"), timeout=120) as answer:
                return json.loads(answer.read(1 << 20) or b"{}")
        except urllib.error.HTTPError as error:
            location = error.headers.get("Location")
            if error.code in REDIRECTS and location:
                url = writer.followed(url, location)
            elif 300 <= error.code < 400:
                raise Refused(error.code, "a redirect that would change the method") from error
            else:
                raise
    raise Refused(None, f"more than {MOST_REDIRECTS} redirects")


def post(writer: Writer, body: bytes, sleep: Callable[[float], None] = time.sleep, retried: Callable[[], None] = lambda: None) -> dict:
    """The server's receipt. Transport faults and passing statuses get another attempt; what doesn't pass is raised as Refused."""
    for attempt in range(1, writer.attempts + 1):
        try:
            return _once(writer, body)
        except urllib.error.HTTPError as error:
            if error.code not in RETRIED or attempt == writer.attempts:
                said = error.read(1 << 20).decode("utf-8", "replace")
                try:
                    committed = json.loads(said).get("committed")
                except (ValueError, AttributeError):
                    committed = None
                raise Refused(error.code, said, committed) from error
            wait = pause(attempt, error.headers.get("Retry-After"))
        except (urllib.error.URLError, TimeoutError, ConnectionError) as error:
            if attempt == writer.attempts:
                raise Refused(None, str(error)) from error
            wait = pause(attempt)
        retried()
        sleep(wait)
    raise AssertionError("unreachable")


SENT = "nodes long, edges long, transactions long, basis string, retries long, status int, error string"


def send(lines: DataFrame, writer: Writer, rows: int = 10_000) -> list[dict]:
    """Post all lines in batches, from the tasks; one receipt for each partition (nodes, edges, transactions, basis, retries, and the status and error that ended it, if any).

    This is an action: it runs once. Tasks that are tried again post again, which
    is safe, as ids supersede in place. A partition whose batch is refused stops
    there and says what went through before; the others go on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes = edges = done = retries = 0
        basis = status = error = None

        def retried() -> None:
            nonlocal retries
            retries += 1

        for pdf in batches:
            for i in range(0, len(pdf), rows):
                try:
                    got = post(writer, ("\n".join(pdf["line"].iloc[i : i + rows]) + "\n").encode(), retried=retried)
                    done += 1
                except Refused as refused:
                    got, status, error = refused.committed, refused.status, refused.message
                nodes, edges, basis = nodes + got.get("nodes", 0), edges + got.get("edges", 0), got.get("basis", basis)
                if error is not None:
                    break
            if error is not None:
                break
        if done or error is not None:
            yield pd.DataFrame([[nodes, edges, done, None if basis is None else str(basis), retries, status, error]], columns=[c.split(" ")[0] for c in SENT.split(", ")])

    return [r.asDict() for r in lines.select("line").mapInPandas(run, SENT).collect()]
