"""The store: deltas and compaction, two writers at once, repeated batches, lost writers, both time axes."""

import threading
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from provgraph.operators import match as Q
from provgraph.operators.store import Conflict, Store, upsert

NOW = datetime(2026, 1, 1, tzinfo=UTC)
SCHEMA = "id string, label string, v string, valid_from timestamp"


def day(n):
    return NOW + timedelta(days=n)


def batch(spark, *rows):
    return spark.createDataFrame([(i, "L", v, at) for i, v, at in rows], SCHEMA)


def seen(df, *columns):
    names = columns or ("id", "v", "valid_from", "valid_to", "system_from", "system_to")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def size(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_small_batch_writes_little(spark, tmp_path):
    many = spark.range(40_000).select(F.concat(F.lit("n"), "id").alias("id"), F.lit("L").alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(NOW).cast("timestamp").alias("valid_from"))
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    store.write({"nodes": many}, NOW)
    whole = size(tmp_path)
    few = many.where("pmod(xxhash64(id), 100) = 3").withColumn("v", F.lit("changed"))
    n = few.count()
    store.write({"nodes": few}, day(1))
    assert 200 < n < 800 and size(tmp_path) - whole < 0.05 * whole
    assert store.read("nodes", history=False).count() == 40_000
    assert store.read("nodes").where("system_to IS NOT NULL").count() == n
    assert store.read("nodes", history=False).where("v = 'changed'").count() == n
    before = size(tmp_path)
    store.write({"nodes": few}, day(2))  # the same again: no row is written
    assert size(tmp_path) - before < 10_000 and store.current() == 2
    one = many.where("id = 'n7'").withColumn("v", F.lit("x"))
    touched = store._merged(store.state(), {"nodes": one}, day(3))["nodes"]["read"]
    assert len(touched) == 1  # other buckets aren't opened


def test_history_equals_that_of_plain_upserts(spark, tmp_path):
    store, plain = Store(spark, str(tmp_path / "s"), buckets=3), None
    for n in range(11):
        rows = [(f"i{k}", f"v{(k * n) % 4}", day(n - (k * n) % 5)) for k in range(n % 3, 12, 1 + n % 3)]
        made = batch(spark, *rows)
        store.write({"edges": made}, day(n))
        after = upsert(plain, made, day(n))
        plain = spark.createDataFrame(after.collect(), after.schema)
        assert seen(store.read("edges")) == seen(plain)
    files = store.state().buckets("edges")
    assert max(len(f) for f in files.values()) <= 10
    store.compact()
    assert all(len(f) == 1 for f in store.state().buckets("edges").values())
    assert seen(store.read("edges")) == seen(plain)
    assert seen(store.read("edges", history=False)) == seen(plain.where("system_to IS NULL"))
    for valid, system in ((day(3), None), (day(3), day(5)), (day(9), day(9)), (None, day(7))):
        assert seen(Q.Instant(valid, system).holds(store.read("edges"))) == seen(Q.Instant(valid, system).holds(plain))


def test_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "s")
    Store(spark, path, buckets=4).write({"edges": batch(spark, *[(f"i{k}", "old", NOW) for k in range(20)])}, NOW)
    gate, failed = threading.Barrier(2), []

    def run(name, ids):
        store = Store(spark, path, buckets=4)
        plain, first = store._claim, []

        def claim(number, state):
            if not first:
                first.append(1)
                gate.wait(60)  # both have merged over the same state
            plain(number, state)

        store._claim = claim
        try:
            store.write({"edges": batch(spark, *[(i, name, day(1)) for i in ids]), "nodes": batch(spark, (name, name, NOW))}, day(1))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=run, args=("a", [f"i{k}" for k in range(12)])), threading.Thread(target=run, args=("b", [f"i{k}" for k in range(8, 20)]))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = Store(spark, path, buckets=4)
    assert not failed and store.current() == 3
    now = dict(seen(Q.Instant(day(2)).holds(store.read("edges", history=False)), "id", "v"))
    assert {now[f"i{k}"] for k in range(8)} == {"a"} and {now[f"i{k}"] for k in range(12, 20)} == {"b"}
    assert len({now[f"i{k}"] for k in range(8, 12)}) == 1  # the later one, whole
    assert seen(store.read("nodes"), "id") == [("a",), ("b",)]
    assert sum(1 for f in (tmp_path / "s" / "graph=default" / "edges").iterdir()) == 3  # what the loser wrote first is gone


def test_other_buckets_stand_as_they_are(spark, tmp_path):
    """A loser whose buckets nobody touched links its files under the next number without merging again."""
    store, other = (Store(spark, str(tmp_path / "s"), buckets=64) for _ in range(2))
    store.write({"edges": batch(spark, ("x", "old", NOW), ("y", "old", NOW))}, NOW)
    merges, plain, merged = [], store._claim, store._merged
    store._merged = lambda *a: merges.append(1) or merged(*a)

    def claim(number, state):
        if len(merges) == 1 and number == 2:
            other.write({"edges": batch(spark, ("y", "b", NOW))}, day(1))
        plain(number, state)

    store._claim = claim
    assert store.write({"edges": batch(spark, ("x", "a", NOW))}, day(1)) == 3 and len(merges) == 1
    assert seen(store.read("edges", history=False), "id", "v") == [("x", "a"), ("y", "b")]
    with pytest.raises(Conflict):
        plain(3, store.state())


def test_a_lost_writer_leaves_nothing_and_its_batch_is_delivered_once(spark, tmp_path):
    clean, store = Store(spark, str(tmp_path / "clean")), Store(spark, str(tmp_path / "s"))
    tables = lambda k: {"nodes": batch(spark, ("n", f"v{k}", day(k))), "edges": batch(spark, (f"e{k}", "x", day(k)))}
    for k in range(3):
        clean.write(tables(k), day(k), "stream", k)
    store.write(tables(0), day(0), "stream", 0)
    lost = Store(spark, str(tmp_path / "s"))
    lost._claim = lambda *a: (_ for _ in ()).throw(KeyboardInterrupt())  # between the files and the commit
    with pytest.raises(KeyboardInterrupt):
        lost.write(tables(1), day(1), "stream", 1)
    assert store.current() == 1 and store.read("nodes").count() == 1
    for k in (1, 1, 0, 2, 2):
        store.write(tables(k), day(k), "stream", k)
    for table in ("nodes", "edges"):
        assert seen(store.read(table)) == seen(clean.read(table))
    assert store.current() == 3 and store.write(tables(9), day(9), "another", 0) == 4
    assert store.vacuum(keep=1) == 0 and store.vacuum(keep=1, lost=datetime.now(UTC) + timedelta(hours=1)) == 2
    assert seen(store.read("edges"), "id") == [("e0",), ("e1",), ("e2",), ("e9",)]


def test_earlier_commits_can_be_read(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for k in range(3):
        store.write({"edges": batch(spark, ("x", f"v{k}", day(k)))}, day(k))
    assert [seen(store.read("edges", number=n, history=False), "v")[-1] for n in (1, 2, 3)] == [("v0",), ("v1",), ("v2",)]
    with pytest.raises(ValueError):
        store.read("edges", number=9)
    with pytest.raises(ValueError, match="columns"):
        store.write({"edges": batch(spark, ("x", "v", NOW)).withColumn("more", F.lit(1))}, NOW)
