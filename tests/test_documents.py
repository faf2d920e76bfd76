"""Documents whose parts nest deeper than any fixed schema."""

import base64
import hashlib
import json

from provgraph.sources import documents as D


def test_components_are_read_at_any_depth(spark, tmp_path):
    deep = {"bom-ref": "c29", "name": "c29", "version": "1", "supplier": {"name": "s"}}
    for i in reversed(range(29)):
        deep = {"bom-ref": f"c{i}", "name": f"c{i}", "purl": f"pkg:npm/c{i}@1", "components": [deep, {"name": f"leaf{i}"}]}
    (tmp_path / "deep.json").write_text(json.dumps({"bomFormat": "CycloneDX", "components": [deep]}))
    (tmp_path / "flat.json").write_text(json.dumps({"bomFormat": "CycloneDX", "components": [{"name": "flat"}]}))
    (tmp_path / "none.json").write_text(json.dumps({"bomFormat": "CycloneDX"}))
    docs = D.sniffed(D.files(spark, str(tmp_path)))
    rows = D.components(docs).collect()
    assert sorted(r["name"] for r in rows) == sorted([f"c{i}" for i in range(30)] + [f"leaf{i}" for i in range(29)] + ["flat"])
    last = next(r for r in rows if r["name"] == "c29")
    assert (last["depth"], last["supplier"], last["pkg"]["version"]) == (29, "s", "1")
    sboms = D.evidence_tables(docs)["HasSBOM"].collect()
    assert sorted(len(r["includedSoftware"]) for r in sboms) == [0, 1, 59]


def test_every_format_states_its_evidence(spark, tmp_path):
    import base64

    from provgraph.operators import assemble as A
    from provgraph.plans.lens import GUARD

    spdx = {
        "spdxVersion": "SPDX-2.3", "documentNamespace": "https://example.com/d", "creationInfo": {"created": "2024-01-02T03:04:05Z"}, "documentDescribes": ["a"],
        "packages": [
            {"SPDXID": "a", "name": "top", "versionInfo": "1", "supplier": "Organization: self"},
            {"SPDXID": "b", "name": "b", "supplier": "Organization: first", "licenseDeclared": "(MIT OR Apache-2.0)", "licenseConcluded": "NOASSERTION", "checksums": [{"algorithm": "SHA256", "checksumValue": "AB"}], "externalRefs": [{"referenceType": "purl", "referenceLocator": "pkg:npm/b@2"}]},
        ],
        "relationships": [{"spdxElementId": "a", "relationshipType": "DEPENDS_ON", "relatedSpdxElement": "b"}],
    }
    bom = {
        "bomFormat": "CycloneDX", "metadata": {"timestamp": "2024-02-02T00:00:00Z", "component": {"bom-ref": "r", "name": "root"}}, "components": [{"bom-ref": "c", "purl": "pkg:npm/c@1", "hashes": [{"alg": "SHA-256", "content": "cd"}]}],
        "dependencies": [{"ref": "r", "dependsOn": ["c"]}], "vulnerabilities": [{"id": "CVE-2024-1", "ratings": [{"score": 7.5, "method": "CVSSv31"}], "analysis": {"state": "not_affected", "detail": "unreachable"}, "affects": [{"ref": "c"}]}],
    }
    build = {"predicateType": "https://slsa.dev/provenance/v1", "subject": [{"name": "x", "digest": {"sha256": "01"}}], "predicate": {"buildDefinition": {"buildType": "t", "resolvedDependencies": [{"uri": "u", "digest": {"sha1": "02"}}]}, "runDetails": {"builder": {"id": "https://b"}, "metadata": {"finishedOn": "2024-03-03T00:00:00Z"}}}}
    card = {"date": "2024-04-04T00:00:00Z", "repo": {"name": "example.com/o/r", "commit": "f0"}, "scorecard": {"version": "v5", "commit": "c"}, "score": 6.5, "checks": [{"name": "CI", "score": 9}]}
    envelope = {"payloadType": "application/vnd.in-toto+json", "payload": base64.b64encode(json.dumps(build).encode()).decode()}
    for name, body in (("spdx", spdx), ("bom", bom), ("build", envelope), ("card", card), ("junk", {"x": 1})):
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    docs = D.sniffed(D.files(spark, str(tmp_path)))
    assert [r["error"] for r in D.failed(docs).collect()] == ["unknown format"]
    tables = D.evidence_tables(docs)
    found = {k: df.coalesce(1).collect() for k, df in tables.items()}
    assert {k: len(v) for k, v in found.items()} == {"HasSBOM": 2, "IsDependency": 2, "IsOccurrence": 2, "CertifyLegal": 1, "CertifyVuln": 0, "CertifyScorecard": 1, "HasSlsa": 1, "Vex": 1, "VulnMetadata": 1}
    assert {r["pkg"]["name"] for r in found["HasSBOM"]} == {"top", "root"}
    assert [x["name"] for x in found["CertifyLegal"][0]["declared"]] == ["MIT", "Apache-2.0"] and found["CertifyLegal"][0]["discoveredLicense"] == ""
    assert found["Vex"][0]["status"] == "NOT_AFFECTED" and found["VulnMetadata"][0]["scoreValue"] == 7.5
    assert found["HasSlsa"][0]["builder"]["uri"] == "https://b" and len(found["HasSlsa"][0]["materials"]) == 1
    assert found["CertifyScorecard"][0]["src"]["name"] == "r"
    assert len({r["item"] for r in found["HasSBOM"]}) == 2
    graph = A.assemble({k: tables[k] for k in ("HasSlsa", "CertifyScorecard", "VulnMetadata")}, GUARD)
    labels = {r["label"]: r["n"] for r in graph.nodes.selectExpr("labels[0] AS label", "id").distinct().groupBy("label").count().withColumnRenamed("count", "n").collect()}
    assert labels["VulnMetadata"] == labels["HasSlsa"] == labels["CertifyScorecard"] == 1
    assert [(r["purl"], r["supplier"]) for r in D.supplied_parts(docs).where("supplier IS NOT NULL").collect()] == [("pkg:npm/b@2", "Organization: first")]
    assert sorted(r["purl"] for r in D.document_purls(docs).collect()) == ["pkg:npm/b@2", "pkg:npm/c@1"]


def test_bytes_that_are_no_text_are_set_aside(spark, tmp_path):
    (tmp_path / "image").write_bytes(b"\xff\xfe\x00{}")
    envelope = {"payloadType": "x", "payload": base64.b64encode(b"\xff\xfe").decode()}
    (tmp_path / "envelope").write_text(json.dumps(envelope))
    docs = D.sniffed(D.files(spark, str(tmp_path)))
    assert [r["error"] for r in D.failed(docs).collect()] == ["not JSON", "not JSON"]


def test_documents_attached_to_images_are_read(spark, tmp_path):
    def blob(body) -> str:
        raw = body if isinstance(body, bytes) else json.dumps(body).encode()
        name = hashlib.sha256(raw).hexdigest()
        (tmp_path / "blobs" / "sha256" / name).write_bytes(raw)
        return f"sha256:{name}"

    (tmp_path / "blobs" / "sha256").mkdir(parents=True)
    images = []
    for name in ("a", "b"):
        layer = blob(b"\xff\x00" + name.encode())
        image = blob({"schemaVersion": 2, "layers": [{"mediaType": "application/vnd.oci.image.layer.v1.tar+gzip", "digest": layer}]})
        sbom = blob({"bomFormat": "CycloneDX", "metadata": {"component": {"name": name}}})
        blob({"schemaVersion": 2, "subject": {"digest": image}, "layers": [{"mediaType": "application/vnd.cyclonedx+json", "digest": sbom}, {"mediaType": "text/plain", "digest": layer}]})
        images.append({"digest": image, "annotations": {"org.opencontainers.image.ref.name": f"registry.example/{name}:1"}})
    blob({"schemaVersion": 2, "subject": {"digest": "sha256:other"}, "layers": [{"mediaType": "application/spdx+json", "digest": blob({"spdxVersion": "SPDX-2.3"})}]})
    (tmp_path / "index.json").write_text(json.dumps({"schemaVersion": 2, "manifests": images}, indent=1))

    def names(*refs) -> list[str]:
        rows = D.image_layout(spark, str(tmp_path), *refs).collect()
        return sorted(json.loads(bytes(r["content"]))["metadata"]["component"]["name"] for r in rows)

    assert names() == ["a", "b"] and names("registry.example/b:1") == ["b"] and names("registry.example/c:1") == []
