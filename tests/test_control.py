"""Sink policy, counters, configuration, the enricher chain and decorators."""

import json
import threading
import urllib.request
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from provgraph import config, metrics
from provgraph.operators import assemble as A
from provgraph.operators import claims as C
from provgraph.operators import enrichers as X
from provgraph.operators import sinks
from provgraph.plans import lens

NOW = datetime(2026, 1, 1, tzinfo=UTC)


@pytest.fixture
def server():
    """Answers by path; what it was asked is kept."""
    asked, answers = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers.get("Authorization"), self.rfile.read(int(self.headers["Content-Length"]))))
            code, headers, body = answers.pop(0) if answers else (200, {}, {"nodes": 1, "edges": 0})
            self.send_response(code)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", asked, answers
    made.shutdown()


def test_batches_go_to_trusted_writers_only(server):
    url, asked, answers = server
    other = url.replace("127.0.0.1", "localhost")
    writer = sinks.Writer(url, lambda: "t", "g")
    slept = []
    answers += [(503, {"Retry-After": "2"}, {}), (421, {"Location": "/v1/ingest?graph=evil"}, {})]
    assert sinks.post(writer, b"x", slept.append) == {"nodes": 1, "edges": 0}
    assert slept == [2.0] and [a[0] for a in asked] == ["/v1/ingest?graph=g"] * 3 and {a[1] for a in asked} == {"Bearer t"} and asked[-1][2] == b"x"
    for code, where in ((307, f"{other}/v1/ingest"), (421, "http://user@127.0.0.1/"), (302, "/v1/ingest")):
        answers.append((code, {"Location": where}, {}))
        before = len(asked)
        with pytest.raises(sinks.Refused):
            sinks.post(writer, b"x", slept.append)
        assert len(asked) == before + 1  # the token went nowhere else
    answers.append((307, {"Location": f"{other}/v1/ingest"}, {}))
    assert sinks.post(sinks.Writer(url, lambda: "t", trusted=(other,)), b"y")["nodes"] == 1
    answers.append((400, {}, {"committed": {"nodes": 3}}))
    with pytest.raises(sinks.Refused) as error:
        sinks.post(writer, b"x")
    assert error.value.status == 400 and error.value.committed == {"nodes": 3}
    for bad in ({"address": "ftp://x"}, {"address": url, "graph": "__x"}, {"address": url, "trusted": (f"{other}/path",)}):
        with pytest.raises(ValueError):
            sinks.Writer(token=lambda: "t", **bad)
    assert sinks.pause(1, "Thu, 01 Jan 2026 00:00:07 GMT", NOW) == 7.0 and sinks.pause(2, "soon") == 0.5


def test_counters_are_served():
    m = metrics.Metrics()
    m.add("documents", 2, outcome="ingested")
    m.add("claims", 3)
    with pytest.raises(ValueError):
        m.add("documents", 1, kind="x")
    server = m.serve()
    get = lambda p: urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{p}").read().decode()
    assert get("/healthz") == "ok\n"
    lines = get("/metrics").splitlines()
    server.shutdown()
    assert 'provgraph_documents_total{outcome="ingested"} 2' in lines and "provgraph_claims_total 3" in lines and "provgraph_sink_retries_total 0" in lines


GOOD = {"receivers": {"files": {"path": "/d", "poll": "1m30s"}}, "processors": {"enrich": {"sources": ["euvd", "purl"]}, "expand": {"deps_dev": True}}, "sink": {"address": "https://w", "token_env": "T"}}


@pytest.mark.parametrize("change", [{"x": 1}, {"receivers": {}}, {"receivers": {"files": {}}}, {"receivers": {"files": {"path": "/d", "poll": "soon"}}}, {"receivers": {"s3": {"bucket": "b", "poll": "1s"}}}, {"processors": {"enrich": {"sources": ["nobody"]}}}, {"processors": {"enrich": {"sources": ["purl", "purl"]}}}, {"processors": {"expand": {"deps_dev": True, "max_docs": -1}}}, {"sink": {"address": "https://w"}}, {"sink": {"address": "w", "token_env": "T"}}])
def test_configurations_are_checked(change):
    with pytest.raises(config.ConfigError):
        config.parsed(GOOD | change, {})


def test_good_configurations_are_read(tmp_path):
    got = config.parsed(GOOD, {"T": "secret"})
    assert (got.paths, got.poll, got.max_documents, got.sink.token()) == (("/d",), 90.0, 500, "secret")
    assert got.policy.allows("euvd") and got.guard(NOW).floor == datetime(2000, 1, 1, tzinfo=UTC)
    (tmp_path / "c.json").write_text(json.dumps(GOOD))
    assert config.load(str(tmp_path / "c.json")).paths == ("/d",)


def test_chain_feeds_forward_and_reports_failures(spark):
    rows = spark.createDataFrame([(1,)], "i int").select(F.explode(F.array(*A.package_nodes(lens.package("deb", F.lit("debian"), F.lit("x"), F.lit("1"), lens.pairs())))).alias("n")).select("n.*", F.lit(NOW).cast("timestamp").alias("valid_from"), F.lit(0).cast("bigint").alias("ord"))
    edges = rows.select("id", F.lit("l").alias("label"), F.col("id").alias("src"), F.col("id").alias("dst"), "props", "valid_from", "ord").limit(0)
    seen = []

    def late(nodes, now):
        seen.append(nodes.where(F.array_contains("labels", "Claim")).count())
        raise RuntimeError("down")

    policy = C.Policy(("purl", "ecosystems", "sbom", "euvd"))
    got = X.enriched(A.Graph(rows, edges), policy, {"purl": X.purl_suppliers, "ecosystems": late, "sbom": X.sbom_suppliers(spark.createDataFrame([("d", 0, "pkg:deb/debian/x@1", "Organization: Y")], "digest string, place int, purl string, supplier string"))}, NOW)
    assert seen == [1] and [s for s, _ in got.failed] == ["ecosystems", "euvd"] and got.claims == 2
    claims = got.graph.nodes.where(F.array_contains("labels", "Claim"))
    assert claims.count() == 2 and got.graph.edges.where("label = 'ABOUT'").count() == 2
    lookup = X.owners(spark.createDataFrame([("pkg:deb/debian/x@1", 0, 500, "o", "r")], "purl string, place int, status int, owner string, repository_url string"))
    found = lookup(rows, NOW)
    assert found.claims.count() == 0 and [r["error"] for r in found.lost.collect()] == ["status 500"]
    got.close()


def test_a_bad_response_costs_one_document_one_source(spark):
    """Three documents; one names a package whose owner can't be looked up, and shares another package with the second."""
    packages = {"d1": ("a", "b"), "d2": ("b", "c"), "d3": ("e",)}
    named = [(doc, n) for doc, names in packages.items() for n in names]
    docs = spark.createDataFrame(named, "doc string, n string")
    each = docs.select("doc", F.explode(F.array(*A.package_nodes(lens.package("npm", F.lit(""), F.col("n"), F.lit("1"), lens.pairs())))).alias("x"))
    rows = each.select("doc", "x.*", F.lit(NOW).cast("timestamp").alias("valid_from"), F.lit(0).cast("bigint").alias("ord"))
    edges = rows.select("id", F.lit("l").alias("label"), F.col("id").alias("src"), F.col("id").alias("dst"), "props", "valid_from", "ord").limit(0)
    responses = spark.createDataFrame([(f"pkg:npm/{n}@1", 0, 503 if n == "a" else 200, f"owner-{n}", "r") for n in "abce"], "purl string, place int, status int, owner string, repository_url string")
    nodes = rows.drop("doc").dropDuplicates(["id"])
    policy = C.Policy(("ecosystems", "purl"))
    got = X.enriched(A.Graph(nodes, edges), policy, {"ecosystems": X.owners(responses), "purl": X.purl_suppliers}, NOW, rows.select("doc", "id"))
    assert [tuple(r) for r in got.errors.collect()] == [("d1", "ecosystems", "status 503")] and got.failed == []
    value = F.get(F.filter("props", lambda p: p["key"] == "value"), F.lit(0))["value"]["s"]
    claims = got.graph.nodes.where(F.array_contains("labels", "Claim")).select(value.alias("v")).collect()
    assert sorted(r["v"] for r in claims) == ["owner-b", "owner-c", "owner-e"]  # b by the second document
    got.close()


def test_plans_grow_by_one_step_a_source(spark):
    rows = spark.createDataFrame([(1,)], "i int").select(F.explode(F.array(*A.package_nodes(lens.package("deb", F.lit("debian"), F.lit("x"), F.lit("1"), lens.pairs())))).alias("n")).select("n.*", F.lit(NOW).cast("timestamp").alias("valid_from"), F.lit(0).cast("bigint").alias("ord"))
    edges = rows.select("id", F.lit("l").alias("label"), F.col("id").alias("src"), F.col("id").alias("dst"), "props", "valid_from", "ord").limit(0)
    sources = ("purl", "sbom", "euvd", "ecosystems")
    sizes = []
    for n in range(1, 5):
        got = X.enriched(A.Graph(rows, edges), C.Policy(sources[:n]), {s: X.purl_suppliers for s in sources}, NOW)
        sizes.append(got.graph.nodes._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        got.close()
    steps = [b - a for a, b in zip(sizes, sizes[1:], strict=False)]
    assert len(set(steps)) == 1


def test_decorators_fail_by_document(spark):
    nodes = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "doc string, id string")

    def twice(pdf):
        if pdf["doc"].iloc[0] == "b":
            raise ValueError("no")
        return pdf.assign(id=pdf["id"] * 2)

    good, bad = X.decorated(nodes, twice, twice)
    assert sorted(r["id"] for r in good.collect()) == ["1111", "2222"]
    assert [(r["doc"], r["error"]) for r in bad.collect()] == [("b", "ValueError: no")]
