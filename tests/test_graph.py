"""The engine against its contract: ids, framing, valid times, merge, store, sinks, documents."""

import json
from datetime import UTC, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from provgraph.functions import enrichment as E
from provgraph.functions import ids
from provgraph.functions import text as T
from provgraph.operators import assemble as A
from provgraph.operators import claims as C
from provgraph.operators import match as Q
from provgraph.operators import merge as M
from provgraph.operators import sinks
from provgraph.operators.store import Store, upsert
from provgraph.plans import lens
from provgraph.sources import documents as D

NOW = datetime(2026, 1, 1, tzinfo=UTC)
GUARD = A.Guard(NOW)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def package(**parts):
    fields = {"type": "generic", "namespace": "", "name": "n", "version": "1", "subpath": ""} | parts
    quals = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in fields.pop("quals", {}).items()]).cast("array<struct<key:string,value:string>>")
    return F.struct(*[F.lit(v).alias(k) for k, v in fields.items()], quals.alias("qualifiers"))


def test_ids_escape_components_and_framing_counts_bytes(spark):
    p = package(type="golang", namespace="github.com/x", name="y", version="v1.0.0", subpath="sub", quals={"os": "linux", "arch": "amd64"})
    got = one(spark, ids.package_version_id(p), ids.package_name_id(p), ids.package_purl(p), T.frame(F.lit("añ"), F.lit("")), T.frame())
    assert got[0] == "pkg:v:golang/github.com%2Fx/y/v1.0.0+arch=amd64&os=linux+sub"
    assert got[1] == "pkg:n:golang/github.com%2Fx/y"
    assert got[2] == "pkg:golang/github.com/x/y@v1.0.0?arch=amd64&os=linux#sub"
    assert got[3:] == ("3:añ0:", "")


def test_edge_ids_keep_fields_apart(spark):
    assert one(spark, ids.edge_id(F.lit("a|b"), F.lit("L"), F.lit("c%")))[0] == "a%7Cb|L|c%25"


@pytest.mark.parametrize(("value", "g", "f", "js"), [(10.0, "10", "10", "10"), (8.9, "8.9", "8.9", "8.9"), (1e6, "1e+06", "1000000", "1000000"), (1e-5, "1e-05", "0.00001", "0.00001"), (0.0, "0", "0", "0"), (-3.25, "-3.25", "-3.25", "-3.25"), (1e21, "1e+21", "1" + "0" * 21, "1e+21")])
def test_float_text_in_three_styles(spark, value, g, f, js):
    x = F.lit(value)
    assert one(spark, T.float_text(x), T.float_text(x, "f"), T.float_text(x, "json")) == (g, f, js)


def test_times_keep_nanoseconds_as_text(spark):
    assert one(spark, T.canonical_time(F.lit("2023-01-09T21:23:03.579712389-06:00")))[0] == "2023-01-10T03:23:03.579712389Z"
    assert one(spark, T.required_time(F.lit(None).cast("timestamp")), T.optional_time(F.lit(None).cast("timestamp"))) == (T.ZERO_TIME, "")


@pytest.mark.parametrize(("at", "refused"), [(None, True), (datetime(2000, 1, 1, tzinfo=UTC), False), (datetime(1999, 12, 31, 23, 59, 59, tzinfo=UTC), True), (NOW + timedelta(minutes=5), False), (NOW + timedelta(minutes=5, seconds=1), True)])
def test_guard_boundaries(spark, at, refused):
    assert one(spark, GUARD.refused(F.lit(at).cast("timestamp")))[0] is refused


def test_bucket_hash_and_suppliers(spark):
    assert one(spark, E.purl_hash(F.lit("pkg:npm/lodash"), F.lit(10)))[0] == "026"
    assert one(spark, E.purl_hash(F.lit("pkg:x/y"), F.lit(0)))[0] == "0"
    assert one(spark, E.supplier_name(F.lit("Organization: Foo (Bar) Inc (a@b.c)")), E.supplier_name(F.lit("NOASSERTION"))) == ("Foo (Bar) Inc", "")
    assert one(spark, E.supplier_of(F.lit("pkg:maven/org.apache.x/y@1"))["supplier"], E.supplier_of(F.lit("pkg:npm/@angular/core@1"))["supplier"]) == ("The Apache Software Foundation", None)
    assert one(spark, E.advisory_path(F.lit("VCID")))[0] is None


def test_severities_are_read_as_written(spark):
    numbers = ["7.12345678", "1e1", "-1", "9", ".5", "5.", "0x1p-2", "Inf", "-infinity", "NaN", "+7"]
    others = ["", " 7", "7 ", "high", "1e999", "1_0", "0x1", "e5", ".", "+-1", "nano", "7.5.1", "+nan", "0x.p1"]
    for score, good in [*((n, True) for n in numbers), *((o, False) for o in others)]:
        each = F.array(*[F.struct(F.lit(s).alias("system"), F.lit(v).alias("score"), F.lit(s).alias("vector")) for s, v in (("epss", "1"), ("CVSSv3", "8"), ("cvssv3.1", score), ("cvssv4", "2"))])
        assert one(spark, E.first_cvss(each)["system"])[0] == ("cvssv3.1" if good else "cvssv4"), score


def test_policy_fails_closed():
    policy = C.Policy(("osv", "purl"), eu_only=True, hosted={"osv": "eu"})
    assert policy.allows("osv") and not policy.allows("purl") and not policy.allows("euvd")
    for bad in (("x",), ("osv", "osv")):
        with pytest.raises(ValueError):
            C.Policy(bad)


def _tables(spark, rows):
    art = "struct<algorithm:string,digest:string>"
    return {"HasSBOM": spark.createDataFrame(rows, f"item long, doc string, artifact {art}, uri string, knownSince timestamp")}


def test_first_payload_and_earliest_time_win(spark):
    a = spark.createDataFrame([("x", "first", 2, NOW), ("x", "other", 3, datetime(2020, 1, 1, tzinfo=UTC)), ("y", "only", 1, None)], "id string, label string, ord long, valid_from timestamp")
    got = {r["id"]: (r["label"], r["us"]) for r in M.merge_records(a).select("*", F.unix_micros("valid_from").alias("us")).collect()}
    assert got == {"x": ("first", 1577836800000000), "y": ("only", None)}


def test_uniting_repeats_first_changes_nothing(spark):
    """Ids, labels, properties and times of kinds with lists, members, loose payloads and packages of all versions."""
    tables = lens.tables(spark, "/root/testdata/sf0.001", "CertifyLegal", "HasSBOM", "HasSlsa", "PkgEqual")
    # Rows again, later and with other payloads.
    again = tables["HasSBOM"].withColumns({"includedSoftware": F.array(F.lit("other")), "item": F.col("item") + (1 << 40), "knownSince": F.col("knownSince") - F.expr("interval 1 day")})
    tables["HasSBOM"] = tables["HasSBOM"].unionByName(again)
    rows = lambda df: sorted(tuple(r) for r in df.select("id", F.to_json(F.struct(*[c for c in df.columns if c not in ("id", "ord")]))).collect())
    one, other = M.merged(tables, GUARD), M.merge(A.assemble(tables, GUARD))
    assert rows(one.nodes) == rows(other.nodes) and rows(one.edges) == rows(other.edges)


def test_missing_subject_keeps_evidence_without_an_edge(spark):
    graph = A.assemble(_tables(spark, [(1, "d", None, "u", datetime(2024, 1, 1, tzinfo=UTC))]), GUARD)
    assert [r["labels"] for r in graph.nodes.collect()] == [["HasSBOM"]]
    assert graph.edges.count() == 0


def test_store_keeps_history_and_ignores_replays(spark, tmp_path):
    at = [datetime(2024, m, 1, tzinfo=UTC) for m in (1, 2, 3, 4)]
    batch = lambda value, t: spark.createDataFrame([("x", "L", value, t)], "id string, label string, v string, valid_from timestamp")
    store = Store(spark, str(tmp_path / "s"))
    store.write({"edges": batch("a", at[0])}, at[1])
    store.write({"edges": batch("a", at[0])}, at[2])
    assert store.read("edges").count() == 1
    store.write({"edges": batch("b", at[2])}, at[3])
    rows = store.read("edges")
    value = lambda **kw: [r["v"] for r in Q.Instant(**kw).holds(rows).collect()]
    assert value(valid=at[1]) == ["a"] and value(valid=at[3]) == ["b"] and value(valid=at[3], system=at[2]) == ["a"]
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path), "__x")
    assert upsert(None, batch("a", at[0]), at[0]).where("system_to IS NULL").count() == 1


def test_lost_writes_and_old_snapshots_leave_the_store_as_it_is(spark, tmp_path):
    batch = lambda i, v: spark.createDataFrame([(i, "L", v, NOW)], "id string, label string, v string, valid_from timestamp")
    store = Store(spark, str(tmp_path / "s"))
    for i in range(4):
        store.write({"edges": batch(f"e{i}", "a")} | ({"nodes": batch("n", "a")} if i == 0 else {}), NOW)
    bad = batch("n", "x").withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.write({"edges": batch("e9", "a"), "nodes": bad}, NOW)
    held = lambda t: sorted(r["id"] for r in store.read(t).collect())
    assert store.current() == 4 and held("edges") == ["e0", "e1", "e2", "e3"]
    assert store.vacuum(keep=1) == 0  # all deltas are in force
    store.write({"edges": batch("e0", "b")}, NOW)
    assert store.compact() == 6 and store.vacuum(keep=1) == 2 and store.vacuum(keep=1) == 0
    assert held("edges").count("e0") == 2  # with the version that was closed
    assert [i for i in held("edges") if i != "e0"] == ["e1", "e2", "e3"] and held("nodes") == ["n"]


def test_ndjson_lines_escape_markup(spark):
    at = F.lit(datetime(2024, 1, 2, 3, 4, 5, 500000, tzinfo=UTC))
    nodes = spark.range(1).select(F.lit('a"<&').alias("id"), F.array(F.lit("L")).alias("labels"), F.array(A.prop("k", F.lit("é>")), A.prop("s", F.lit(10.0), "f")).cast(A.PROPS).alias("props"), at.alias("valid_from"))
    line = sinks.node_lines(nodes).first()["line"]
    assert line == '{"type":"node","labels":["L"],"props":{"_id":"a\\"\\u003c\\u0026","k":"é\\u003e","s":10},"valid_from":"2024-01-02T03:04:05.5Z"}'
    assert json.loads(line)["props"]["_id"] == 'a"<&'


def test_retry_pauses_double_and_stop():
    assert [sinks.pause(i) for i in (1, 2, 3, 20)] == [0.25, 0.5, 1.0, 30.0] and sinks.pause(1, "7") == 7.0


def test_documents_are_read_or_set_aside(spark, tmp_path):
    spdx = {"spdxVersion": "SPDX-2.3", "documentNamespace": "urn:x", "creationInfo": {"created": "2024-01-02T00:00:00Z"}, "documentDescribes": ["S0", "S1", "S2"], "packages": [{"SPDXID": f"S{i}", "name": f"p{i}", "versionInfo": "1", "externalRefs": [{"referenceType": "purl", "referenceLocator": f"pkg:npm/p{i}@1"}]} for i in range(3)]}
    cdx = {"bomFormat": "CycloneDX", "metadata": {"timestamp": "2024-01-02T00:00:00Z"}, "components": [{"bom-ref": "a", "name": "a", "purl": "pkg:npm/a@1", "components": [{"bom-ref": "b", "name": "b"}]}]}
    for name, doc in (("a.json", spdx), ("b", cdx), ("bad", None), ("late.json", spdx | {"creationInfo": {"created": "soon"}})):
        (tmp_path / name).write_text("{" if doc is None else json.dumps(doc))
    docs = D.sniffed(D.files(spark, str(tmp_path)))
    assert sorted(r["error"] for r in D.failed(docs).collect()) == ["bad creation time", "not JSON"]
    graph = M.merge(A.assemble({"HasSBOM": D.evidence_tables(docs.where("path LIKE '%a.json'"))["HasSBOM"]}, GUARD))
    assert graph.nodes.count() == 9 and graph.edges.count() == 6
    assert sorted(r["name"] for r in D.components(docs).collect()) == ["a", "b"]


def test_blast_radius_agrees_with_sql(spark):
    import __spark_entry__

    d = "/root/testdata/sf0.001"
    got = {(r["vulnerability"], r["product"]) for r in __spark_entry__.queries()["blast_radius_one"](spark, d).collect()}
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    assert got == set(con.sql(__spark_entry__.oracle_sql()["blast_radius_one"]).fetchall()) and got


def test_entry_and_catalogue():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(lens.TABLES) == 17
