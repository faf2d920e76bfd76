"""Findings of round 3 on growth: what streams, stores and pattern queries do with many rows."""

from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from provgraph import shared
from provgraph.plans import streams
from provgraph.streaming import dedup

NOW = datetime(2026, 1, 1, tzinfo=UTC)
DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_streams_are_merged_without_python(spark, tmp_path):
    schema = "id string, label string, ord long, valid_from timestamp"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    found = dedup.merged_stream(stream)
    text = found._jdf.queryExecution().analyzed().toString()
    assert found.columns == ["id", "label", "ord", "valid_from"] and "Aggregate" in text and "Python" not in text and "TransformWithState" not in text


def test_a_batch_of_a_stream_is_written_by_all_tasks(spark, monkeypatch):
    dedup.prepare(spark)
    rows = spark.range(80, numPartitions=4).select(F.concat(F.lit("i"), F.col("id") % 40).alias("id"), F.lit("L").alias("label"), "id", F.lit(NOW).alias("valid_from")).toDF("id", "label", "ord", "valid_from")
    files, got, plain = [], {}, shared.removed

    def removed(session, *paths):
        files.extend(f for p in paths for f in Path(p, "in").rglob("*.parquet"))
        plain(session, *paths)

    def deliver(batch, number):
        got.setdefault(number, []).extend(batch.collect())

    monkeypatch.setattr(streams.shared, "removed", removed)
    streams._streamed(spark, rows, 3, deliver)
    assert sorted(got) == [0, 1, 2] and len(files) > 3
    last = {r["id"]: r["ord"] for n in sorted(got) for r in got[n]}
    assert last == {f"i{k}": k for k in range(40)}


def test_an_earlier_time_leaves_with_the_first_payload(spark, tmp_path):
    dedup.prepare(spark)
    schema, left = "id string, label string, ord long, valid_from timestamp", []
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for rows in ([("a", "first", 1, NOW), ("b", "b", None, None)], [("a", "second", 2, NOW - timedelta(days=1))], [("a", "second", 2, NOW), ("b", "b", None, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        seen = []
        dedup.merged_stream(stream).writeStream.outputMode("update").foreachBatch(lambda b, n: seen.extend(map(tuple, b.collect()))).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()  # noqa: B023
        left.append(sorted((i, label, o, t and t.replace(tzinfo=UTC)) for i, label, o, t in seen))
    assert left == [[("a", "first", 1, NOW), ("b", "b", None, None)], [("a", "first", 1, NOW - timedelta(days=1))], []]


def test_instants_are_counted_in_one_reading_of_the_store(spark):
    text = plan(streams.as_of_both_axes(spark, DIR))
    assert text.count("Union") < 4 and text.count("Relation") < len(streams._INSTANTS)


def test_changes_take_an_id_s_last_statement(spark):
    """Rows of bases and deltas as they lie: those that a later write states anew don't count."""
    from provgraph.operators import store as S

    day = lambda n: NOW + timedelta(days=n)
    schema = "id string, label string, v string, valid_from timestamp, valid_to timestamp, system_from timestamp, system_to timestamp"
    lie = [("a", "L", "old", day(0), None, day(0), None, 0), ("a", "L", "old", day(0), day(2), day(3), None, 4), ("a", "L", "new", day(2), None, day(3), None, 4), ("b", "L", "old", day(0), None, day(0), None, 0)]
    current = spark.createDataFrame(lie, f"{schema}, {S.STATED} long")
    batch = spark.createDataFrame([("a", "L", "new", day(2)), ("b", "L", "new", day(1))], "id string, label string, v string, valid_from timestamp")
    got = sorted((r["id"], r["v"], r["valid_to"] is None, r["system_to"] is None) for r in S.changes(current, batch, day(5)).collect())
    assert got == [("b", "new", True, True), ("b", "old", False, True), ("b", "old", True, False)]


def test_a_new_table_is_written_without_reading_its_batch_first(spark, tmp_path):
    from provgraph.operators.store import Store

    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x)
    rows = spark.range(40).select(count(F.concat(F.lit("n"), F.col("id"))).alias("id"), F.lit("L").alias("label"), F.lit(NOW).cast("timestamp").alias("valid_from"))
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    store.write({"nodes": rows}, NOW)
    assert seen.value == 40 and store.read("nodes").count() == 40


def test_blast_radius_makes_an_id_once_for_each_part(spark):
    """Package ids are made below the join with the lines, and vulnerabilities multiply only what is left of these."""
    import __spark_entry__

    text = plan(__spark_entry__.queries()["blast_radius"](spark, DIR))
    first = [line for line in text.splitlines() if "Join" in line]
    assert "LeftSemi" not in first[0] and "Inner" in first[0] and "LeftSemi" in first[1]
    assert any("dep_pkg_id" in line and "LeftSemi" in line for line in first)
