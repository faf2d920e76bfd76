"""Batch and streaming runs: documents to a bitemporal store.

A batch's time is one literal. Streams go by micro-batches into the store, whose
commits remember the stream and the number of its last batch: a batch that is
delivered again, after whatever crash, is recognised and changes nothing. Late
documents only lower valid times; there is no watermark.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from provgraph import shared
from provgraph.metrics import Metrics
from provgraph.operators.assemble import Graph, Guard
from provgraph.operators.merge import merged
from provgraph.operators.store import Store
from provgraph.sources.documents import evidence_tables, failed, numbered, sniffed, stream


@dataclass(frozen=True)
class Receipt:
    documents: int
    failed: int
    nodes: int
    edges: int


def graph_of(docs: DataFrame, guard: Guard) -> Graph | None:
    """The graph of stored, sniffed documents; none if no document can be read."""
    formats = {r[0] for r in docs.where("error IS NULL").select("format").distinct().collect()}
    return merged(evidence_tables(docs, formats), guard) if formats else None


def run_batch(docs: DataFrame, store: Store, guard: Guard, metrics: Metrics | None = None, source: str | None = None, batch: int = 0) -> Receipt:
    """One upsert for all documents; those that can't be read are counted and left out.

    Documents are read once, and their graph is made once: both are tables of
    the shared folder until the batch ends. `source` and `batch` name a delivery
    that may come again (see `Store.write`); one that the store holds already
    isn't read at all.
    """
    spark = docs.sparkSession
    if source is not None and store.state().sources.get(source, -1) >= batch:
        return Receipt(0, 0, 0, 0)
    stored, path = shared.kept(numbered(sniffed(docs)), "documents")
    paths = [path]
    try:
        graph, tables = graph_of(stored, guard), {}
        for name in ("nodes", "edges") if graph else ():
            tables[name], path = shared.kept(getattr(graph, name).drop("ord"), name)
            paths.append(path)
        store.write(tables, guard.now, source, batch)
        size = lambda name: tables[name].count() if name in tables else 0
        receipt = Receipt(stored.count(), failed(stored).count(), size("nodes"), size("edges"))
    finally:
        shared.removed(spark, *paths)
    if metrics is not None:
        metrics.add("documents", receipt.documents - receipt.failed, outcome="ingested")
        metrics.add("documents", receipt.failed, outcome="skipped")
        metrics.add("records_emitted", receipt.nodes, kind="node")
        metrics.add("records_emitted", receipt.edges, kind="edge")
    return receipt


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name that a stream keeps over its restarts, as its checkpoint holds it; a stream that begins anew has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def run_stream(
    spark: SparkSession, path: str, checkpoint: str, store: Store, guard: Guard, per_trigger: int = 1000, once: bool = True,
    metrics: Metrics | None = None, clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> StreamingQuery:
    """A streaming query over a folder; with `once` it ends when all files that are there have been read. Each batch has its own time."""

    def deliver(docs: DataFrame, batch: int) -> None:
        run_batch(docs, store, replace(guard, now=clock()), metrics, stream_id(spark, checkpoint), batch)

    writer = stream(spark, path, per_trigger).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")).start()


def drain(query: StreamingQuery, seconds: float = 30.0) -> bool:
    """Let a query finish the documents it has taken, then stop it; whether it was idle in time."""
    end = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.1)
    idle = not query.isActive or not query.status["isTriggerActive"]
    query.stop()
    return idle
