"""Findings of round 4: what queries write and move, and what they give on odd rows."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from provgraph.functions import ids
from provgraph.operators import merge as M
from provgraph.plans import lens, streams

DIR = "/root/testdata/sf0.001"


def against_sql(spark, name, folder):
    found = __spark_entry__.queries()[name](spark, folder)
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events", "documents", "labels", "customer", "supplier"):
        con.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    want = Counter(con.sql(f"SELECT {', '.join(found.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall())
    assert Counter(map(tuple, found.collect())) == want and want


def test_packed_ids_come_back_as_they_were(spark):
    texts = ["", "art:sha256:", "art:sha256:" + "0f" * 32, "ART:" + "0F" * 32, "0f" * 32, "é" + "a1" * 32, "lic:en", "\x01" + "0" * 63, "x" + "0" * 65]
    rows = spark.createDataFrame([(t,) for t in texts], "id string").select("id", ids.packed(F.col("id")).alias("b")).select("id", "b", ids.unpacked(F.col("b")).alias("again")).collect()
    assert [r["again"] for r in rows] == texts and len(rows[2]["b"]) == 44 and len({bytes(r["b"]) for r in rows}) == len(texts)


def test_streamed_records_are_narrow_and_batches_go(spark, monkeypatch):
    seen, plain = [], streams.dedup.merged_stream
    monkeypatch.setattr(streams.dedup, "merged_stream", lambda rows: seen.append(dict(rows.dtypes)) or plain(rows))
    left, removed = [], streams.shared.removed

    def watched(session, *paths):
        left.extend((p, {f.parts[-2] for f in Path(p).rglob("*.parquet")}) for p in paths if "/due=" in p)
        removed(session, *paths)

    monkeypatch.setattr(streams.shared, "removed", watched)
    assert streams.stream_merge_equals_batch(spark, DIR).count() == 3000
    assert seen == [{"id": "binary", "label": "string", "n_props": "int", "valid_from": "timestamp", "ord": "bigint"}]
    assert [(Path(p).name, x) for p, x in left] == [(f"due={k}", {"in"}) for k in range(3)] and not any(Path(p).exists() for p, _ in left)


def odd(spark, folder):
    """Tables of sf0.001 with rows stated twice, keys that lead nowhere or are null, and times that aren't believed."""
    for t in ("part", "orders", "lineitem", "events", "documents", "labels", "customer", "supplier"):
        rows = spark.read.parquet(f"{DIR}/{t}.parquet")
        if t in ("orders", "lineitem", "part", "events"):
            rows = rows.unionByName(rows.limit(50))
        if t == "lineitem":
            lost = rows.limit(40).withColumns({"l_partkey": F.lit(10**9).cast(rows.schema["l_partkey"].dataType), "l_shipdate": F.lit(None).cast(rows.schema["l_shipdate"].dataType)})
            rows = rows.unionByName(lost).unionByName(rows.limit(30).withColumn("l_orderkey", F.lit(10**9).cast(rows.schema["l_orderkey"].dataType)))
        if t == "orders":
            rows = rows.unionByName(rows.limit(20).withColumn("o_orderstatus", F.lit("Z"))).unionByName(rows.limit(3).withColumn("o_orderkey", F.lit(None).cast(rows.schema["o_orderkey"].dataType)))
        rows.write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def once(df, *columns):
    return Counter((*map(str, r),) for r in df.select(*columns).collect())


def dealt_by(df):
    """The keys that a plan is dealt by."""
    return re.findall(r"hashpartitioning\((.*?), \d+\)", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    return odd(spark, tmp_path_factory.mktemp("odd"))


@pytest.fixture
def joins_shuffle(spark):
    """No table is small, as at the sizes that the findings are of."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dealt_tables_give_the_same_edges(spark, odd_dir):
    for kind in lens.KEYS:
        plain, dealt = (M.merged(t, lens.GUARD).edges for t in (lens.tables(spark, odd_dir, kind), lens.dealt(spark, odd_dir, kind)))
        columns = ("id", "label", "src", "dst", "valid_from", "ord")
        assert once(plain, *columns) == once(dealt, *columns), kind


def test_edges_of_orders_are_united_where_they_lie(spark, joins_shuffle):
    """No hash of evidence is shuffled: lines and orders are dealt by their keys before."""
    edges = M.merged(lens.dealt(spark, DIR, "IsDependency", "IsOccurrence", "HasSBOM", "HasSlsa"), lens.GUARD).edges
    keys = dealt_by(edges.select("label", "src", "dst", "valid_from"))
    assert keys and not any("hash#" in k for k in keys)
    lost = M.merged(lens.tables(spark, DIR, "IsOccurrence"), lens.GUARD).edges
    assert any("hash#" in k for k in dealt_by(lost))


def test_merge_edges_is_as_its_sql(spark, joins_shuffle):
    against_sql(spark, "merge_edges", DIR)


def test_nodes_of_dealt_tables_are_those_of_plain_ones(spark, odd_dir):
    for kind in ("IsDependency", "HasSlsa"):
        plain, dealt = (M.merged(t, lens.GUARD, props=False).nodes for t in (lens.tables(spark, odd_dir, kind), lens.dealt(spark, odd_dir, kind)))
        assert once(plain, "id", "labels", "valid_from") == once(dealt, "id", "labels", "valid_from"), kind


def test_merge_nodes_moves_materials_by_their_parts(spark, joins_shuffle):
    """Materials are united by parts' keys, others by packed ids, and no evidence's hash is shuffled for orders."""
    keys = dealt_by(M.merged(lens.dealt(spark, DIR, "IsDependency", "HasSlsa"), lens.GUARD, props=False).nodes.select("id", "valid_from"))
    assert any(re.fullmatch(r"k#\d+L?", k) for k in keys) and not any("hash#" in k for k in keys)
