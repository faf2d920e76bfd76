"""Lookups against a local server: pauses, pages, statuses, and readers of three services' answers feeding the enrichers."""

import json
import threading
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from provgraph import shared
from provgraph.operators import assemble as A
from provgraph.operators import claims as C
from provgraph.operators import enrichers as X
from provgraph.plans import lens
from provgraph.sources import lookup as L

NOW = datetime(2026, 1, 1, tzinfo=UTC)


@pytest.fixture
def server():
    """Answers by path and key, one after the other where there are several; what was asked is kept."""
    asked, answers, lock = [], {}, threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            query = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            key = query.get("purl") or query.get("text") or self.path
            with lock:
                asked.append((self.path, self.headers["User-Agent"]))
                left = answers.get(key, [(404, {}, "gone")])
                code, headers, body = left.pop(0) if len(left) > 1 else left[0]
            self.send_response(code)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body if isinstance(body, bytes) else (body if isinstance(body, str) else json.dumps(body)).encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", asked, answers
    made.shutdown()


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def test_one_key_is_asked_politely(server):
    url, asked, answers = server
    service, slept = L.package_registry(url), []
    answers["a"] = [(503, {"Retry-After": "3"}, ""), (429, {}, ""), (200, {}, [])]
    assert list(L.ask(service, "a", slept.append)) == [("a", 0, 200, "[]", None)]
    assert slept == [3.0, 0.5] and asked[0] == ("/api/v1/packages/lookup?purl=a", "provgraph")
    answers["b"] = [(500, {}, "x")]
    assert list(L.ask(service, "b", slept.append)) == [("b", 0, 500, None, None)] and len(asked) == 3 + L.ATTEMPTS
    assert list(L.ask(service, "c", slept.append)) == [("c", 0, 404, None, None)]
    answers["d"] = [(302, {"Location": "/moved"}, "")]
    answers["/moved"] = [(200, {}, "[1]")]
    assert list(L.ask(service, "d", slept.append))[0][2:4] == (200, "[1]")
    before = len(asked)
    answers["e"] = [(302, {"Location": url.replace("127.0.0.1", "localhost") + "/moved"}, "")]
    assert list(L.ask(service, "e", slept.append)) == [("e", 0, 302, None, None)] and len(asked) == before + 1
    answers["f"] = [(200, {}, b"\xff")]
    assert list(L.ask(service, "f", slept.append))[0][4].startswith("UnicodeDecodeError")
    dead = L.package_registry("http://127.0.0.1:1")
    row = list(L.ask(dead, "g", slept.append))[0]
    assert row[2:4] == (None, None) and row[4].startswith("URLError")
    with pytest.raises(ValueError):
        L.package_registry("ftp://x")


def test_pages_are_followed_within_the_service(server):
    url, asked, answers = server
    service = L.advisory_service(url)
    answers["p"] = [(200, {}, {"results": [1], "next": "/two"})]
    answers["/two"] = [(200, {}, {"results": [2], "next": f"{url}/two"})]
    rows = list(L.ask(service, "p"))
    assert [(r[1], r[2]) for r in rows] == [(0, 200), (1, 200), (2, None)] and "read before" in rows[-1][4]
    answers["q"] = [(200, {}, {"next": "http://localhost:1/x"})]
    assert [r[2] for r in L.ask(service, "q")] == [200, None]
    assert {a[1] for a in asked} == {"VCIO_API_AGENT"}


def test_answers_are_rows(spark, server):
    url, asked, answers = server
    for n in range(20):
        answers[f"k{n}"] = [(200, {}, [n])]
    answers["k3"] = [(503, {"Retry-After": "0"}, ""), (200, {}, [3])]
    del answers["k7"]
    rows, path = shared.kept(L.fetched(keys(spark, *answers, "k7", "k1", "", None), L.package_registry(url), 3), "answers")
    got = {r["key"]: (r["status"], r["body"]) for r in rows.collect()}
    assert got == {f"k{n}": (200, f"[{n}]") for n in range(20) if n != 7} | {"k7": (404, None)} and len(asked) == 21
    assert L.fetched(keys(spark, "x").limit(0), L.package_registry(url)).collect() == []
    shared.removed(spark, path)


def _nodes(spark, *names):
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i long").select("i", F.posexplode(F.array(*A.package_nodes(lens.package("npm", F.lit(""), F.col("n"), F.lit("1"), lens.pairs())))).alias("place", "x"))
    return rows.select("x.*", F.lit(NOW).cast("timestamp").alias("valid_from"), (F.col("i") * 10 + F.col("place")).alias("ord"))


def test_owners_come_from_the_registry(spark, server):
    url, _, answers = server
    record = lambda owner: {"repository_url": "r", "repo_metadata": {"owner_record": {"name": owner}, "more": 1}}
    answers |= {"pkg:npm/a@1": [(200, {}, [record("first"), record("second")])], "pkg:npm/b@1": [(200, {}, [])], "pkg:npm/c@1": [(200, {}, [{"repo_metadata": None}, record("late")])], "pkg:npm/d@1": [(200, {}, "{broken")]}
    purls = [f"pkg:npm/{n}@1" for n in "abcde"]
    answered, path = shared.kept(L.fetched(keys(spark, *purls), L.package_registry(url)), "answers")
    found = X.owners(L.owner_responses(answered))(_nodes(spark, *"abcde"), NOW)
    assert [(r["value"], r["ref"]) for r in found.claims.collect()] == [("first", "r")]  # the first record counts, also where it has no owner
    assert sorted(r["error"] for r in found.lost.collect()) == ["status 404", "status unknown"]
    shared.removed(spark, path)


def test_facts_come_from_the_european_search(spark, server):
    url, asked, answers = server
    item = {"id": "EUVD-1", "enisaUuid": "x", "description": "bad", "datePublished": "Mar 29, 2024, 4:51:12 PM", "dateUpdated": "Aug 4, 2025, 7:05:54 AM", "baseScore": 10.0, "baseScoreVersion": "3.1", "baseScoreVector": "V", "references": "https://a\nhttps://b\n", "aliases": "CVE-2024-1\nGHSA-x\n", "epss": 0.5}
    answers["cve-2024-1"] = [(200, {}, {"items": [item, item | {"id": "EUVD-2", "aliases": "CVE-9"}], "total": 2})]
    answers["cve-2024-2"] = [(200, {}, {"items": [], "total": 0})]
    answered, path = shared.kept(L.fetched(keys(spark, "cve-2024-1", "cve-2024-2", "cve-2024-3"), L.european_search(url)), "answers")
    vulns = spark.createDataFrame([(f"cve-2024-{i}",) for i in (1, 2, 3)], "v string").select(A.node(F.concat(F.lit("vuln:cve/"), F.col("v")), "Vulnerability", [A.prop("type", F.lit("cve")), A.prop("vulnID", F.col("v"))]).alias("x")).select("x.*", F.lit(NOW).cast("timestamp").alias("valid_from"), F.lit(0).cast("bigint").alias("ord"))
    found = X.european_facts(L.european_items(answered), L.failures(answered))(vulns, NOW)
    got = {(r["fact"], r["value"]) for r in found.claims.collect()}
    assert got == {("euvd_id", "EUVD-1"), ("cvss", "10"), ("cvss_version", "3.1"), ("cvss_vector", "V"), ("epss", "0.5"), ("description", "bad"), ("published", "2024-03-29T16:51:12Z"), ("updated", "2025-08-04T07:05:54Z"), ("reference", "https://a"), ("reference", "https://b")}
    assert [(r["subject"], r["error"]) for r in found.lost.collect()] == [("vuln:cve/cve-2024-3", "status 404")]
    assert all("size=10" in a[0] for a in asked)
    shared.removed(spark, path)


def test_advisories_come_page_by_page(spark, server):
    url, _, answers = server
    one = {"advisory_id": "A1", "aliases": ["CVE-1", "GHSA-9"], "summary": "s", "severities": [{"value": "High", "scoring_system": "cvssv3"}, {"value": "7.5", "scoring_system": "cvssv3.1", "scoring_elements": "V"}, {"value": "0.1", "scoring_system": "epss"}], "references": [{"url": "https://a", "reference_id": ""}], "fixed_by_packages": ["pkg:npm/a@2"]}
    answers["pkg:npm/a@1"] = [(200, {}, {"results": [one], "next": "/more"})]
    answers["/more"] = [(200, {}, {"results": [{"advisory_id": "A2", "aliases": [], "summary": ""}], "next": None})]
    answered, path = shared.kept(L.fetched(keys(spark, "pkg:npm/a@1", "pkg:npm/b@1"), L.advisory_service(url)), "answers")
    known = spark.createDataFrame([("cve-1", "V1")], "name string, id string")
    found = X.affected_packages(L.affecting_advisories(answered), known, L.failures(answered))(_nodes(spark, "a", "b"), NOW)
    claims = found.claims.collect()
    assert sorted((r["value"], *r["also"]) for r in claims if r["fact"] == "affected") == [("A1", "V1"), ("A2",)]
    assert {(r["fact"], r["value"]) for r in claims if r["subject"] == "V1"} == {("advisory_id", "A1"), ("description", "s"), ("cvss", "7.5"), ("cvss_version", "3.1"), ("cvss_vector", "V"), ("epss", "0.1"), ("reference", "https://a"), ("fixed_by", "pkg:npm/a@2")}
    assert [r["error"] for r in found.lost.collect()] == ["status 404"]
    shared.removed(spark, path)
