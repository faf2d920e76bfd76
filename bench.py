"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`graph_records` builds and merges the graph of four kinds and counts its
records; the others are the pattern queries and the replay of an identical
batch. Each query runs once to warm up and then BENCH_RUNS times (median).
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import UTC, datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from provgraph.operators import assemble as A
from provgraph.operators import merge as M
from provgraph.operators.store import upsert
from provgraph.plans import catalogue, lens
from provgraph.session import session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def graph_records(spark, d):
    graph = M.merged(lens.tables(spark, d, "IsDependency", "CertifyVuln", "IsOccurrence", "HasSBOM"), lens.GUARD)
    return graph.nodes.select("id", "props").unionByName(graph.edges.select("id", "props"))


def replay(spark, d):
    nodes = M.merge_records(A.records(lens.has_sbom(spark, d), "HasSBOM", lens.GUARD).nodes).drop("ord")
    return upsert(upsert(None, nodes, lens.NOW), nodes, datetime(2026, 2, 1, tzinfo=UTC))


def main() -> None:
    spark = session(f"local[{CPUS}]", int(CPUS) * 2, "bench", **{"spark.driver.memory": "20g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue.queries()
    todo = {"graph_records": graph_records, "replay": replay} | {n: known[n] for n in ("blast_radius", "blast_radius_one", "blast_radius_as_of", "ev_is_dependency")}
    times, records = {}, 0
    for name, query in todo.items():
        took = []
        for i in range(RUNS + 1):
            start = time.perf_counter()
            seen = Observation()
            query(spark, SF_DIR).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
            if i:
                took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)
        records = seen.get["n"] if name == "graph_records" else records
    print(json.dumps({"metric": "total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")), "records": records, "records_per_sec": round(records / times["graph_records"])}))


if __name__ == "__main__":
    main()
