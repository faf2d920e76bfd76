"""Arrival order, streams that crash and come back, stateful merges, intervals of paths."""

import json
import os
import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from provgraph.operators import assemble as A
from provgraph.operators import match as Q
from provgraph.operators import merge as M
from provgraph.operators.store import Store
from provgraph.sources import documents as D
from provgraph.streaming import dedup, ingest

NOW = datetime(2026, 1, 1, tzinfo=UTC)
GUARD = A.Guard(NOW)


def _spdx(name, *packages):
    return json.dumps({"spdxVersion": "SPDX-2.3", "documentNamespace": f"urn:{name}", "creationInfo": {"created": "2024-01-02T00:00:00Z"}, "packages": [{"SPDXID": p, "name": p, "versionInfo": "1", "licenseDeclared": f"L{p}"} for p in packages]})


def test_documents_are_numbered_as_they_arrived(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.choice([None, *[NOW + timedelta(seconds=k) for k in range(4)]]), f"p{k:03d}", b"x" * rng.randrange(0, 50)) for k in range(300)]
    docs = spark.createDataFrame(rows, "receiver int, arrived timestamp, path string, content binary").repartition(7)
    want, before = {}, 0
    for receiver, _, path, content in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or NOW, r[2])):
        want[receiver, path] = before
        before += len(content)
    assert {(r["receiver"], r["path"]): r["seq"] for r in D.numbered(docs).collect()} == want
    assert D.numbered(docs.limit(0)).collect() == []


def test_places_beyond_any_fixed_number_keep_their_order(spark, tmp_path):
    n = 70_000
    for folder, name, text in (("a", "big.json", _spdx("big", *[f"p{i}" for i in range(n)])), ("b", "small.json", _spdx("small", "p5", "q"))):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_text(text)
        os.utime(tmp_path / folder / name, (1_700_000_000 - (folder == "b"),) * 2)
    docs = D.sniffed(D.files(spark, str(tmp_path / "a"), str(tmp_path / "b")))
    rows = D.evidence_tables(docs)["CertifyLegal"].select("item", "declaredLicense", "doc").orderBy("item").collect()
    # The first receiver's documents come first, though the other's are older.
    assert [r["declaredLicense"] for r in rows] == [*[f"Lp{i}" for i in range(n)], "Lp5", "Lq"]
    assert len({r["item"] for r in rows}) == n + 2


def test_nested_components_keep_their_order(spark, tmp_path):
    part = lambda name, *inner: {"bom-ref": name, "name": name, "components": list(inner)}
    cdx = {"bomFormat": "CycloneDX", "components": [part("a", part("b", part("c")), part("d")), part("e", part("f"))]}
    (tmp_path / "c.json").write_text(json.dumps(cdx))
    rows = D.components(D.sniffed(D.files(spark, str(tmp_path)))).orderBy("pos").collect()
    assert "".join(r["name"] for r in rows) == "abcdef" and [r["pos"] for r in rows] == list(range(6))


def test_a_stream_that_crashed_holds_what_a_clean_one_does(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for i in range(2):
        (docs / f"{i}.json").write_text(_spdx(f"d{i}", "shared", f"own{i}"))
        os.utime(docs / f"{i}.json", (1_700_000_000 + i,) * 2)
    ticks = iter(range(10**6))
    clock = lambda: NOW + timedelta(minutes=10 * next(ticks))

    def run(store, name):
        return ingest.run_stream(spark, str(docs), str(tmp_path / name), store, GUARD, per_trigger=1, clock=clock).awaitTermination()

    clean = Store(spark, str(tmp_path / "clean"), buckets=2)
    run(clean, "at-clean")
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    plain, calls = store._claim, []

    def dies(number, state):
        calls.append(number)
        if len(calls) == 1:
            raise RuntimeError("killed between files and commit")
        plain(number, state)
        if len(calls) == 2:
            raise RuntimeError("killed after the commit, before the stream knew")

    store._claim = dies
    for _ in range(2):
        try:
            run(store, "at")
        except Exception as error:  # noqa: BLE001
            assert "killed" in str(error)
    run(store, "at")
    assert store.current() == clean.current() == 2
    tally = lambda s: sorted(map(tuple, s.read("nodes").groupBy("id", F.col("system_to").isNull().alias("open")).count().collect()))
    assert tally(store) == tally(clean) and len(tally(clean)) > 5
    edges = lambda s: sorted(r["id"] for r in s.read("edges", history=False).collect())
    assert edges(store) == edges(clean)
    times = {r[0] for r in clean.read("nodes").select("system_from").distinct().collect()}
    assert len(times) > 1  # each batch has its own time


def test_streamed_merges_equal_one_merge(spark, tmp_path):
    dedup.prepare(spark)
    rng = random.Random(5)
    rows = [(f"i{rng.randrange(25)}", f"L{k}", [f"x{k}", None], k, rng.choice([None, *[NOW - timedelta(days=d) for d in range(6)]])) for k in range(200)]
    records = spark.createDataFrame(rows, "id string, label string, more array<string>, ord long, valid_from timestamp")
    order = list(range(4)) * 50
    rng.shuffle(order)
    for part in range(4):
        some = spark.createDataFrame([r for r, p in zip(rows, order, strict=True) if p == part], records.schema)
        some.unionByName(some.limit(5)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # some rows twice
    left, seen = {}, []

    def deliver(batch, number):
        got = batch.collect()
        seen.append(len(got))
        assert len({r["id"] for r in got}) == len(got)
        left.update({r["id"]: r for r in got})

    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start = lambda: dedup.merged_stream(stream).writeStream.outputMode("update").foreachBatch(deliver).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    start()
    want = {r["id"]: r for r in M.merge_records(records).collect()}
    assert {i: (r["label"], r["more"], r["valid_from"]) for i, r in left.items()} == {i: (r["label"], r["more"], r["valid_from"]) for i, r in want.items()}
    seen.clear()
    records.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    start()  # all of it again, on the state of the first run
    assert sum(seen) == 0


def test_intervals_of_paths_agree_with_days(spark):
    rng = random.Random(7)
    day = lambda n: None if n is None else NOW + timedelta(days=n)

    def spans():
        cuts = sorted(rng.sample(range(12), 4))
        return [(cuts[0], cuts[1]), (cuts[1] if rng.random() < 0.5 else cuts[2], rng.choice([cuts[3], None]))]

    nodes = {f"{kind}{i}": spans() for kind in "ab" for i in range(5)}
    edges = {(f"a{i}", f"b{j}"): spans() for i in range(5) for j in range(5) if rng.random() < 0.6}
    node_rows = [(i, "A" if i[0] == "a" else "B", day(f), day(t), NOW, None) for i, s in nodes.items() for f, t in s]
    edge_rows = [("e", "to", a, b, day(f), day(t), NOW, None) for (a, b), s in edges.items() for f, t in s]
    axes = "valid_from timestamp, valid_to timestamp, system_from timestamp, system_to timestamp"
    graph = A.Graph(spark.createDataFrame(node_rows, f"id string, label string, {axes}"), spark.createDataFrame(edge_rows, f"id string, label string, src string, dst string, {axes}"))
    holds = lambda s, d: any(f <= d and (t is None or d < t) for f, t in s)
    for line in (Q.timeline(graph, "a", "A").out("to", "b"), Q.timeline(graph, "b", "B").into("to", "a")):
        got = line.all().collect()
        days = {}
        for r in got:
            f, t = ((x.replace(tzinfo=UTC) - NOW).days if x else 99 for x in (r["valid_from"], r["valid_to"]))
            days.setdefault((r["a"], r["b"]), []).append((f, t))
        for (a, b), s in edges.items():
            want = [d for d in range(14) if holds(s, d) and holds(nodes[a], d) and holds(nodes[b], d)]
            own = sorted(days.get((a, b), []))
            assert [d for d in range(14) if any(f <= d < t for f, t in own)] == want
            assert all(x[1] < y[0] for x, y in zip(own, own[1:], strict=False))  # coalesced
        some = {(r["a"], r["b"]) for r in line.between(day(3), day(5)).collect()}
        assert some == {k for k, s in days.items() if any(f < 5 and t > 3 for f, t in s)}
    assert Q.timeline(graph, "a", "A", system=NOW - timedelta(days=1)).out("to", "b").all().collect() == []
