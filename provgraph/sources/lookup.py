"""Lookups over the network: answers of services as a table, and readers that make it the tables that enrichers take.

Keys stay distributed: Spark deals them over `tasks` partitions, and each task asks
one after the other. Answers are fetched once, into a table; a task that is
lost asks again, which changes nothing at the service. What can't be fetched is a row
with its status, never a failure of the job.
"""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import urlencode, urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph import shared
from provgraph.functions.enrichment import cvss_version, first_cvss, first_epss, prop_text
from provgraph.functions.text import text
from provgraph.operators.claims import first_by_purl, vulnerability_nodes
from provgraph.operators.enrichers import Enricher, Lookup, affected_packages, european_facts, owners
from provgraph.operators.sinks import origin, pause

ANSWERS = "key string, page int, status int, body string, error string"
#: Statuses that may pass, attempts at each page, and bytes of the largest answer.
PASSING, ATTEMPTS, MOST_BYTES = {429, 500, 502, 503, 504}, 4, 64 << 20
REDIRECTS, MOST_REDIRECTS = {301, 302, 303, 307, 308}, 10


@dataclass(frozen=True)
class Service:
    """Where a key is asked: address, path, the parameter of the key, further parameters, the agent's name, and the field of an answer that names its next page (empty: one page)."""

    address: str
    path: str
    parameter: str
    further: tuple[tuple[str, str], ...] = ()
    agent: str = "provgraph"
    next_page: str = ""

    def __post_init__(self):
        origin(self.address)

    def url(self, key: str) -> str:
        return f"{self.address.rstrip('/')}/{self.path}?{urlencode([(self.parameter, key), *self.further])}"


#: Fixed values of three public services; only their addresses are given.
def european_search(address: str) -> Service:
    return Service(address, "search", "text", (("size", "10"),))


def package_registry(address: str) -> Service:
    return Service(address, "api/v1/packages/lookup", "purl")


def advisory_service(address: str) -> Service:
    return Service(address, "api/v3/affected-by-advisories", "purl", agent="VCIO_API_AGENT", next_page="next")


class _Still(urllib.request.HTTPRedirectHandler):
    """Redirects are answers like others; `_get` follows those that stay at the service."""

    def redirect_request(self, *args: object) -> None:
        return None


_OPENER = urllib.request.build_opener(_Still)


def _same(service: Service, url: str) -> bool:
    try:
        return origin(url) == origin(service.address)
    except ValueError:
        return False


def _get(service: Service, url: str) -> tuple[int, str, str | None]:
    """(status, body, how long to wait) of one attempt; redirects within the service are followed."""
    for _ in range(MOST_REDIRECTS + 1):
        try:
            with _OPENER.open(urllib.request.Request(url, headers={"User-Agent": service.agent, "Accept": "application/json"}), timeout=20) as answer:
                body = answer.read(MOST_BYTES + 1)
                if len(body) > MOST_BYTES:
                    raise ValueError(f"an answer of more than {MOST_BYTES} bytes")
                return answer.status, body.decode("utf-8"), None
        except urllib.error.HTTPError as error:
            to = urljoin(url, error.headers.get("Location") or "")
            if error.code in REDIRECTS and error.headers.get("Location") and _same(service, to):
                url = to
                continue
            return error.code, "", error.headers.get("Retry-After")
    raise ValueError(f"more than {MOST_REDIRECTS} redirects")


def ask(service: Service, key: str, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """Rows of ANSWERS for a key, page by page. Passing statuses and faults of the network get further attempts; a page that names one already read ends the key."""
    url, page, seen = service.url(key), 0, set()
    while url:
        seen.add(url)
        status = error = None
        body = ""
        for attempt in range(1, ATTEMPTS + 1):
            after = error = status = None
            try:
                status, body, after = _get(service, url)
            except (urllib.error.URLError, http.client.HTTPException, TimeoutError, ConnectionError) as fault:
                error = f"{type(fault).__name__}: {fault}"
            except ValueError as fault:
                error = f"{type(fault).__name__}: {fault}"
                break
            if error is None and status not in PASSING:
                break
            if attempt < ATTEMPTS:
                sleep(pause(attempt, after))
        yield key, page, status, body if status == 200 else None, error
        following = None
        if status == 200 and service.next_page:
            try:
                answer = json.loads(body)
                following = answer.get(service.next_page) if isinstance(answer, dict) else None
            except ValueError:
                following = None
        url = urljoin(url, following) if isinstance(following, str) and following else None
        if url and (url in seen or not _same(service, url)):
            yield key, page + 1, None, None, "the next page is elsewhere or was read before"
            url = None
        page += 1


def fetched(keys: DataFrame, service: Service, tasks: int = 8) -> DataFrame:
    """(key, page, status, body, error) for every key, once each; `tasks` is how many ask at a time. Keys that are null or empty aren't asked.

    Store the result before it is used (`shared.kept`): each job over it asks anew.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in ANSWERS.split(", ")]
        for pdf in batches:
            for key in pdf["key"]:
                rows = pd.DataFrame(list(ask(service, key)), columns=names)
                yield rows.astype({"page": "Int32", "status": "Int32"})

    asked = keys.select("key").where("key IS NOT NULL AND key <> ''").distinct()
    return asked.repartition(tasks, "key").mapInPandas(run, ANSWERS)


def _read(answers: DataFrame, schema: str) -> DataFrame:
    """Answers with `x`, what their body holds, and `bad`: why a page counts as failed, if it does."""
    rows = answers.withColumn("x", F.when(F.col("status") == 200, F.from_json("body", schema, {"mode": "PERMISSIVE"})))
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("status").isNull(), F.lit("no answer")).when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status").cast("string")))
    return rows.withColumn("bad", F.coalesce(why, F.when(F.try_parse_json("body").isNull(), F.lit("the answer isn't JSON"))))


def failures(answers: DataFrame) -> DataFrame:
    """(key, error) of keys with a page that couldn't be fetched or read."""
    return _read(answers, "struct<a:string>").where("bad IS NOT NULL").groupBy("key").agg(F.min("bad").alias("error"))


def _sound(answers: DataFrame, schema: str) -> DataFrame:
    """Pages of the keys that didn't fail."""
    return _read(answers, schema).join(failures(answers), "key", "left_anti")


_OWNER = "array<struct<repository_url:string,repo_metadata:struct<owner_record:struct<name:string>>>>"


def owner_responses(answers: DataFrame) -> DataFrame:
    """(purl, place, status, owner, repository_url) as `enrichers.owners` takes it; a key that failed has one row with its status, or none if there was no sound answer."""
    rows = _sound(answers, _OWNER).select(F.col("key").alias("purl"), F.posexplode("x").alias("place", "r"))
    good = rows.select("purl", "place", F.lit(200).alias("status"), text(F.col("r.repo_metadata.owner_record.name")).alias("owner"), text(F.col("r.repository_url")).alias("repository_url"))
    status = answers.where("status <> 200").groupBy("key").agg(F.min("status").alias("status"))
    none = F.lit(None).cast("string")
    lost = failures(answers).join(status, "key", "left").select(F.col("key").alias("purl"), F.lit(0).alias("place"), "status", none.alias("owner"), none.alias("repository_url"))
    return good.unionByName(lost)


_ITEMS = "struct<items:array<struct<id:string,aliases:string,baseScore:double,baseScoreVersion:string,baseScoreVector:string,epss:double,description:string,datePublished:string,dateUpdated:string,references:string>>>"


def european_items(answers: DataFrame) -> DataFrame:
    """Items of the European search as `enrichers.european_facts` takes them."""
    rows = _sound(answers, _ITEMS).select(F.col("key").alias("asked"), F.explode("x.items").alias("i"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return rows.select(
        "asked", text(F.col("i.id")).alias("id"), text(F.col("i.aliases")).alias("aliases"), zero("i.baseScore").alias("base_score"), text(F.col("i.baseScoreVersion")).alias("base_score_version"), text(F.col("i.baseScoreVector")).alias("base_score_vector"),
        zero("i.epss").alias("epss"), text(F.col("i.description")).alias("description"), F.col("i.datePublished").alias("date_published"), F.col("i.dateUpdated").alias("date_updated"), text(F.col("i.references")).alias("references"),
    )


_PAGE = "struct<results:array<struct<advisory_id:string,aliases:array<string>,summary:string,severities:array<struct<value:string,scoring_system:string,scoring_elements:string>>,references:array<struct<url:string>>,fixed_by_packages:array<string>>>>"


def affecting_advisories(answers: DataFrame) -> DataFrame:
    """Advisories about packages as `enrichers.affected_packages` takes them."""
    rows = _sound(answers, _PAGE).select(F.col("key").alias("purl"), F.explode("x.results").alias("a"))
    severities = F.transform("a.severities", lambda s: F.struct(s["scoring_system"].alias("system"), s["value"].alias("score"), s["scoring_elements"].alias("vector")))
    scored = rows.withColumn("severities", severities).withColumns({"c": first_cvss(F.col("severities")), "e": first_epss(F.col("severities"))})
    listed = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    return scored.select(
        "purl", text(F.col("a.advisory_id")).alias("advisory_id"), listed(F.col("a.aliases")).alias("aliases"), text(F.col("a.summary")).alias("summary"), F.col("c.score").alias("cvss"), cvss_version(F.col("c.system")).alias("cvss_version"),
        F.col("c.vector").alias("cvss_vector"), F.col("e.score").alias("epss"), listed(F.transform("a.references", lambda r: r["url"])).alias("references"), listed(F.col("a.fixed_by_packages")).alias("fixed_by"),
    )


def asking(service: Service, keys: Callable[[DataFrame], DataFrame], read: Callable[[DataFrame, DataFrame], Enricher], paths: list[str], tasks: int = 8) -> Enricher:
    """An enricher that asks a service about the nodes it gets; its answers are a table, whose path is added to `paths` for whoever ends the run."""

    def enrich(nodes: DataFrame, now: datetime) -> DataFrame | Lookup:
        answers, path = shared.kept(fetched(keys(nodes), service, tasks), "answers")
        paths.append(path)
        return read(answers, nodes)(nodes, now)

    return enrich


def _purls(nodes: DataFrame) -> DataFrame:
    return first_by_purl(nodes).select(F.col("purl").alias("key"))


def _names(nodes: DataFrame) -> DataFrame:
    p = F.col("props")
    return nodes.where(F.array_contains("labels", "Vulnerability") & prop_text(p, "type").isin("cve", "euvd")).select(prop_text(p, "vulnID").alias("key"))


def live(paths: list[str], european: str = "", registry: str = "", advisories: str = "", tasks: int = 8) -> dict[str, Enricher]:
    """The enrichers that ask the services whose addresses are given."""
    found = {}
    if european:
        found["euvd"] = asking(european_search(european), _names, lambda a, n: european_facts(european_items(a), failures(a)), paths, tasks)
    if registry:
        found["ecosystems"] = asking(package_registry(registry), _purls, lambda a, n: owners(owner_responses(a)), paths, tasks)
    if advisories:
        found["vulnerablecode"] = asking(advisory_service(advisories), _purls, lambda a, n: affected_packages(affecting_advisories(a), vulnerability_nodes(n), failures(a)), paths, tasks)
    return found
