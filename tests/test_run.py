"""Runs from files to a writer and a store: one pass, polling, refusals, the command line."""

import json
import threading
from datetime import UTC, datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from provgraph import __main__ as command
from provgraph import config
from provgraph.operators import enrichers as X
from provgraph.operators.store import Store
from provgraph.run import Run, Stopped

NOW = datetime(2026, 1, 1, tzinfo=UTC)


@pytest.fixture
def writer():
    """Takes lines; refuses while `answers` says so."""
    lines, answers, lock = [], [], threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            got = self.rfile.read(int(self.headers["Content-Length"])).decode().splitlines()
            with lock:
                code, headers = answers.pop(0) if answers else (200, {})
                if code == 200:
                    lines.extend(map(json.loads, got))
                basis = len(lines)
            nodes = sum('"type":"node"' in x for x in got)
            self.send_response(code)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(json.dumps({"nodes": nodes, "edges": len(got) - nodes, "basis": basis} if code == 200 else {"committed": {"nodes": 2}}).encode())

        def log_message(self, *args):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", lines, answers
    made.shutdown()


def spdx(name, *packages, created="2024-01-02T00:00:00Z"):
    parts = [{"SPDXID": f"S{i}", "name": p, "versionInfo": "1", "supplier": f"Organization: of {p}", "licenseDeclared": "MIT", "externalRefs": [{"referenceType": "purl", "referenceLocator": f"pkg:npm/{p}@1"}]} for i, p in enumerate(packages)]
    return json.dumps({"spdxVersion": "SPDX-2.3", "name": name, "documentNamespace": f"urn:{name}", "creationInfo": {"created": created}, "packages": parts, "relationships": [{"spdxElementId": "S0", "relationshipType": "DEPENDS_ON", "relatedSpdxElement": f"S{i}"} for i in range(1, len(parts))]})


def configured(url="", *paths, sources=("sbom", "ecosystems"), budget=2, poll=""):
    given = {"receivers": {"files": {"path": paths[0]} | ({"poll": poll} if poll else {})}, "processors": {"enrich": {"sources": list(sources)}, "expand": {"deps_dev": True, "max_docs": budget}}}
    return given | ({"sink": {"address": url, "token_env": "T"}} if url else {})


def checked(*args, **more):
    return config.parsed(configured(*args, **more), {"T": "t"})


def owners(spark, *bad):
    rows = [(f"pkg:npm/{n}@1", 0, 503 if n in bad else 200, f"owner-{n}", "r") for n in "abcdefg"]
    return X.owners(spark.createDataFrame(rows, "purl string, place int, status int, owner string, repository_url string"))


def reject(name):
    def decorate(pdf):
        if pdf["doc"].iloc[0].endswith(name):
            raise ValueError("not ours")
        first = pdf.iloc[:1].assign(id="Note:" + pdf["doc"].iloc[0].rsplit("/", 1)[-1])
        return pdf._append(first) if hasattr(pdf, "_append") else pdf

    return decorate


def test_one_pass_from_files_to_a_writer(spark, tmp_path, writer):
    url, lines, answers = writer
    for name, text in (("1.json", spdx("one", "a", "b")), ("2.json", spdx("two", "c", created="1990-01-01T00:00:00Z")), ("3.json", spdx("three", "d")), ("4.json", "{broken"), ("5.json", '{"a": 1}')):
        (tmp_path / name).write_text(text)
    answers.append((503, {"Retry-After": "0"}))
    dependencies = spark.createDataFrame([("pkg:npm/a@1", "pkg:npm/x@1"), ("pkg:npm/x@1", "pkg:npm/y@1"), ("pkg:npm/b@1", "pkg:npm/y@1"), ("pkg:npm/d@1", "pkg:npm/z@1")], "purl string, dep string")
    run = Run(spark, checked(url, str(tmp_path)), enrichers={"ecosystems": owners(spark, "b")}, decorators=(reject("3.json"),), dependencies=dependencies, clock=lambda: NOW)
    receipt = run.once()
    run.close()
    assert (receipt.documents, receipt.skipped, receipt.decorated, receipt.decorate_failed) == (2, 2, 2, 1)
    assert (receipt.expanded, receipt.exhausted, receipt.budget) == (2, True, 2)  # a and b; x is over the budget
    # The document that names b, and b's own, go without owners; a's own document and the second don't.
    assert receipt.enrich_failed == 2 and receipt.claims == 3 + 2 and receipt.fallbacks > 0
    nodes, edges = [x for x in lines if x["type"] == "node"], [x for x in lines if x["type"] == "edge"]
    assert (receipt.nodes, receipt.edges) == (len(nodes), len(edges)) and receipt.basis == len(lines)
    ids = [n["props"]["_id"] for n in nodes]
    assert len(ids) == len(set(ids)) and {"Note:1.json", "Note:2.json"} <= set(ids) and "Note:3.json" not in ids
    purls = {n["props"].get("purl") for n in nodes}
    assert {f"pkg:npm/{n}@1" for n in "abcxy"} <= purls and "pkg:npm/d@1" not in purls
    depends = {(e["src"], e["dst"]) for e in edges if e["label"].startswith("IsDependency")}
    assert depends and {e["dst"] for e in edges} <= set(ids)
    shown = str(receipt)
    assert shown.startswith("documents=2 nodes=") and "4.json: not JSON" in shown and "decorate failed" in shown and "status 503" in shown and "expansion budget 2 reached" in shown
    counters = run.metrics.text()
    for line in ('documents_total{outcome="ingested"} 2', 'documents_total{outcome="skipped"} 2', "documents_decorated_total 2", "documents_decorate_failed_total 1", "expansion_documents_total 2", "claims_total 5", 'enrich_failures_total{source="ecosystems"} 2', "sink_retries_total 1", f"valid_time_fallbacks_total {receipt.fallbacks}", f'records_emitted_total{{kind="node"}} {len(nodes)}'):
        assert f"provgraph_{line}" in counters


def test_a_refusal_ends_the_run_with_what_went_through(spark, tmp_path, writer):
    url, lines, answers = writer
    (tmp_path / "1.json").write_text(spdx("one", "a"))
    answers += [(400, {})] * 50
    run = Run(spark, checked(url, str(tmp_path), sources=()), clock=lambda: NOW)
    with pytest.raises(Stopped) as stopped:
        run.once()
    assert stopped.value.refused.status == 400 and stopped.value.receipt.nodes >= 2 and lines == []
    assert run.receipt.documents == 0 and 'documents_total{outcome="failed"} 1' in run.metrics.text()


def test_polling_keeps_one_budget_and_takes_no_batch_twice(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    dependencies = spark.createDataFrame([(f"pkg:npm/{n}@1", f"pkg:npm/{n}{n}@1") for n in "abcd"], "purl string, dep string")
    store, ticks = Store(spark, str(tmp_path / "store"), buckets=2), iter(range(100))
    run = Run(spark, checked("", str(docs), sources=(), poll="1s", budget=3), store, dependencies=dependencies, clock=lambda: NOW + timedelta(minutes=next(ticks)))
    for i, names in enumerate(("ab", "cd")):
        (docs / f"{i}.json").write_text(spdx(f"d{i}", *names))
        run.poll(str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert (run.receipt.documents, run.receipt.expanded, run.receipt.exhausted, run.receipt.claims) == (2, 3, True, 0)
    versions = store.read("nodes", history=False).where(F.array_contains("labels", "PkgVersion"))
    purls = F.get(F.filter("props", lambda p: p["key"] == "purl"), F.lit(0))["value"]["s"]
    assert {r[0] for r in versions.select(purls).collect()} == {f"pkg:npm/{n}@1" for n in ("a", "b", "c", "d", "aa", "bb", "cc")}
    again = run.take(spark.createDataFrame([], "path string, content binary, receiver int, arrived timestamp, digest string"), next(iter(store.state().sources)), 0)
    assert str(again).startswith("documents=0 nodes=0")
    run.close()


def test_a_folder_without_documents(spark, tmp_path):
    (tmp_path / "x.json").write_text("no")
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    run = Run(spark, checked("", str(tmp_path / "x.json")), store, clock=lambda: NOW)
    assert (run.once().skipped, run.receipt.documents) == (1, 0)


def test_the_command_line(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "1.json").write_text(spdx("one", "a"))
    (tmp_path / "c.json").write_text(json.dumps(configured("", str(tmp_path / "docs"), sources=("purl",))))
    monkeypatch.setattr(command, "session", lambda: spark)
    assert command.main([str(tmp_path / "c.json"), "--store", str(tmp_path / "store")]) == 0
    assert capsys.readouterr().out.startswith("documents=1 nodes=")
    for bad in ([str(tmp_path / "none.json")], [str(tmp_path / "c.json")]):
        with pytest.raises(SystemExit):
            command.main(bad)
