"""Findings of round 3: queries against their SQL, and what they move."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from provgraph.operators import assemble as A
from provgraph.operators import merge as M
from provgraph.plans import lens

DIR = "/root/testdata/sf0.001"


def against_sql(spark, name):
    found = __spark_entry__.queries()[name](spark, DIR)
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events", "documents", "labels", "customer", "supplier"):
        con.sql(f"CREATE VIEW {t} AS FROM '{DIR}/{t}.parquet'")
    want = Counter(con.sql(f"SELECT {', '.join(found.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall())
    assert Counter(map(tuple, found.collect())) == want and want


def shuffled_by(df):
    """The keys that a plan is dealt by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"hashpartitioning\((.*?), \d+\)", plan)


def test_owner_claims_are_those_of_the_lookup(spark):
    against_sql(spark, "ecosystems_owner_claims")


def test_edges_are_united_by_their_evidence(spark):
    """No shuffle is dealt by the text of an edge."""
    edges = M.merged(lens.tables(spark, DIR, "IsDependency", "HasSlsa"), lens.GUARD).edges
    dealt = shuffled_by(edges.select("label", "src", "dst", "valid_from"))
    assert not any("src#" in keys or "label#" in keys for keys in dealt)
    assert any(keys.startswith("hash#") for keys in dealt)


@pytest.mark.parametrize("kind", ["IsDependency", "HasSlsa", "HashEqual", "HasSourceAt"])
def test_light_nodes_and_edges_are_those_of_the_plain_merge(spark, kind):
    tables = lens.tables(spark, DIR, kind)
    light, plain = M.merged(tables, lens.GUARD, props=False), M.merge(A.assemble(tables, lens.GUARD))
    for got, want, columns in ((light.nodes, plain.nodes, ("id", "labels", "valid_from")), (light.edges, plain.edges, ("id", "label", "src", "dst", "valid_from"))):
        rows = lambda df: Counter((*map(str, r),) for r in df.select(*columns).collect())  # noqa: B023, E731
        assert rows(got) == rows(want)


def test_a_material_that_is_named_twice_gives_one_edge(spark):
    art = lambda x: f"named_struct('algorithm', 'sha256', 'digest', '{x}')"
    ir = spark.sql(f"SELECT 1L AS item, 'd' AS doc, {art('a')} AS artifact, named_struct('uri', 'b') AS builder, array({art('m')}, {art('m')}) AS materials")
    assert M.merged({"HasSlsa": ir}, lens.GUARD).edges.where("label = 'HasSlsaMaterial'").count() == 1


def test_merge_nodes_moves_no_properties(spark):
    dealt = shuffled_by(__spark_entry__.queries()["merge_nodes"](spark, DIR))
    assert not any("v_" in keys for keys in dealt)


def test_sbom_contents_are_merged_alone(spark):
    found = __spark_entry__.queries()["sbom_includes_first_wins"](spark, DIR)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    against_sql(spark, "sbom_includes_first_wins")
