"""A run: documents are collected, scanned, assembled, decorated, enriched and expanded, and their graph goes to a store and a writer; a receipt says what happened.

One pass takes all documents at once; polling takes them by micro-batches, each
with its own time and under the run's one expansion budget. Counts come from
observations of the jobs that write the tables, not from counting them again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from provgraph import shared
from provgraph.config import Config
from provgraph.metrics import Metrics
from provgraph.operators.assemble import Graph, Guard, assemble, fallbacks
from provgraph.operators.enrichers import Decorator, Enricher, decorated_rows, enriched, purl_suppliers, sbom_suppliers
from provgraph.operators.expand import Expansion
from provgraph.operators.merge import merge, merged
from provgraph.operators.sinks import Refused, edge_lines, node_lines, send
from provgraph.operators.store import Store
from provgraph.sources import documents as D
from provgraph.streaming.ingest import stream_id

#: Faults that a receipt names one by one; it counts all of them.
MOST_SHOWN = 1000
#: Expansion's documents come after all that are collected.
_LAST = 1 << 47


@dataclass
class Receipt:
    """What a run did. The lists name the first MOST_SHOWN faults of a batch; the numbers count all."""

    documents: int = 0
    nodes: int = 0
    edges: int = 0
    transactions: int = 0
    basis: int = 0
    skipped: int = 0
    fallbacks: int = 0
    expanded: int = 0
    decorated: int = 0
    decorate_failed: int = 0
    claims: int = 0
    enrich_failed: int = 0
    budget: int = 0
    exhausted: bool = False
    faults: list[str] = field(default_factory=list)

    def add(self, other: Receipt) -> None:
        for f in fields(self):
            mine, theirs = getattr(self, f.name), getattr(other, f.name)
            setattr(self, f.name, max(mine, theirs) if f.name in ("basis", "budget", "exhausted") else mine + theirs)

    def __str__(self) -> str:
        counts = ("documents", "nodes", "edges", "transactions", "basis", "skipped", "fallbacks", "expanded", "decorated", "decorate_failed", "claims", "enrich_failed")
        lines = [" ".join(f"{n}={getattr(self, n)}" for n in counts), *(f"  {x}" for x in self.faults)]
        if self.exhausted:
            lines.append(f"  expansion budget {self.budget} reached; some transitive dependencies were not collected")
        return "\n".join(lines)


class Stopped(RuntimeError):
    """A writer refused a batch; `receipt` has what went through before."""

    def __init__(self, receipt: Receipt, refused: Refused):
        super().__init__(str(refused))
        self.receipt, self.refused = receipt, refused


class Run:
    """One configuration at work.

    `store` and the configuration's sink may both be there, or one. `enrichers`
    adds sources to those that need nothing but the documents. `dependencies`
    (purl, dep) is what the expansion goes along, `malformed` (purl) what of it can't be
    read. `scans` are scanners' findings as `documents.scanned` takes them. A
    decorator sees one document's own nodes, before any source speaks; a
    document that it rejects goes no further, and nodes that it adds get the time
    it gives them.
    """

    def __init__(
        self, spark: SparkSession, config: Config, store: Store | None = None, enrichers: dict[str, Enricher] | None = None, decorators: tuple[Decorator, ...] = (), dependencies: DataFrame | None = None,
        malformed: DataFrame | None = None, scans: dict[str, dict[str, DataFrame]] | None = None, metrics: Metrics | None = None, clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    ):
        self.spark, self.config, self.store, self.decorators, self.scans, self.clock = spark, config, store, decorators, scans or {}, clock
        self.enrichers, self.metrics, self.receipt = enrichers or {}, metrics or Metrics(), Receipt()
        self.expansion = Expansion(dependencies, config.max_documents, malformed) if dependencies is not None and config.max_documents else None
        self._paths: list[str] = []

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        rows, path = shared.kept(df, name)
        self._paths.append(path)
        return rows

    def _observed(self, df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        seen = Observation(f"{name}-{id(df)}")
        rows = self._kept(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]), name)
        return rows, seen.get

    def _shown(self, rows: DataFrame, text: Column) -> list[str]:
        return [r[0] for r in rows.select(text.alias("t")).orderBy("t").limit(MOST_SHOWN).collect()]

    def _decorated(self, tables: dict[str, DataFrame], guard: Guard, receipt: Receipt) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
        """(evidence of the documents that all decorators passed, nodes that they added, the documents that one rejected)."""
        raw = self._kept(assemble(tables, guard).nodes, "records")
        rows, seen = self._observed(decorated_rows(raw, *self.decorators), "decorated", failed=F.count_if(F.col("error").isNotNull()))
        bad = rows.where("error IS NOT NULL")
        receipt.decorate_failed = seen["failed"]
        receipt.documents -= receipt.decorate_failed
        if receipt.decorate_failed:
            receipt.faults += self._shown(bad, F.concat(F.lit("decorate failed "), "doc", F.lit(": "), "error"))
            tables = {n: t.join(bad.select("doc"), "doc", "left_anti") for n, t in tables.items()}
        added = rows.where("error IS NULL").drop("error").join(raw.select("doc", "id"), ["doc", "id"], "left_anti").select(raw.columns)
        return tables, added, bad.select(F.col("doc").alias("path"))

    def _expanded(self, docs: DataFrame, tables: dict[str, DataFrame], receipt: Receipt) -> dict[str, DataFrame]:
        """The evidence with what the packages of these documents depend on, as far as the budget goes."""
        if self.expansion is None:
            return tables
        found = self.expansion.expand(D.document_purls(docs).select("purl"))
        unread = found.documents.where("NOT ok")
        receipt.expanded, receipt.exhausted, receipt.budget = found.taken, self.expansion.exhausted, self.expansion.limit
        if lost := unread.count():
            receipt.expanded -= lost
            receipt.skipped += lost
            receipt.faults += self._shown(unread, F.concat(F.lit("skipped "), "purl", F.lit(": can't be read")))
        edges = self.expansion.edges.where("dep IS NOT NULL").distinct().join(found.documents.where("ok").select("purl"), "purl")
        pkg, dep = D.parsed_purl(F.col("purl")), D.parsed_purl(F.col("dep"))
        stated = edges.select(F.col("purl").alias("doc"), F.col("purl").alias("origin"), F.lit("deps.dev").alias("collector"), F.sha2("purl", 256).alias("documentRef"), F.lit(_LAST).alias("item"), pkg.alias("pkg"), dep.alias("dep_pkg"), F.lit("DIRECT").alias("dependencyType"), F.lit("resolved dependency").alias("justification"))
        stated = self._kept(stated.where("pkg IS NOT NULL AND dep_pkg IS NOT NULL"), "dependencies")
        return tables | {"IsDependency": tables["IsDependency"].unionByName(stated, allowMissingColumns=True) if "IsDependency" in tables else stated}

    def _enriched(self, graph: Graph, docs: DataFrame, tables: dict[str, DataFrame], guard: Guard, receipt: Receipt, passed: int) -> Graph:
        """The graph with the claims of the policy's sources; what they failed at is counted by document."""
        if not self.config.policy.sources:
            return graph
        own = {"sbom": sbom_suppliers(D.supplied_parts(docs)), "purl": purl_suppliers}
        members = self._kept(assemble(tables, guard).nodes.select("doc", "id").distinct(), "members")
        got = enriched(graph, self.config.policy, own | self.enrichers, guard.now, members)
        self._paths += got.paths
        receipt.claims = got.claims
        errors = {r["source"]: r["n"] for r in got.errors.groupBy("source").agg(F.count("*").alias("n")).collect()}
        for source, error in got.failed:
            errors[source] = errors.get(source, 0) + passed
            receipt.faults.append(f"enrich failed {source} all documents: {error}")
        receipt.faults += self._shown(got.errors, F.concat(F.lit("enrich failed "), "source", F.lit(" "), "doc", F.lit(": "), "error"))
        receipt.enrich_failed = sum(errors.values())
        for source, n in errors.items():
            self.metrics.add("enrich_failures", n, source=source)
        return got.graph

    def _sent(self, nodes: DataFrame, edges: DataFrame, receipt: Receipt) -> None:
        """Nodes, then edges, to the configured writer; the first refusal ends the run."""
        for lines in (node_lines(nodes), edge_lines(edges)):
            rows = send(lines, self.config.sink)
            for r in rows:
                receipt.nodes, receipt.edges, receipt.transactions = receipt.nodes + r["nodes"], receipt.edges + r["edges"], receipt.transactions + r["transactions"]
                receipt.basis = max(receipt.basis, int(r["basis"]) if (r["basis"] or "").isdigit() else 0)
                self.metrics.add("sink_retries", r["retries"])
            refused = next((r for r in rows if r["error"] is not None), None)
            if refused:
                raise Stopped(receipt, Refused(refused["status"], refused["error"]))

    def take(self, docs: DataFrame, source: str | None = None, batch: int = 0) -> Receipt:
        """Process documents (as `documents.files` gives them). `source` and `batch` name a delivery that may come again: one that the store holds isn't processed."""
        receipt = Receipt()
        if self.store is not None and source is not None and self.store.state().sources.get(source, -1) >= batch:
            return receipt
        guard = self.config.guard(self.clock())
        try:
            self._take(docs, guard, receipt, source, batch)
        except Stopped:
            self.metrics.add("documents", receipt.documents, outcome="failed")
            receipt.documents = 0
            raise
        finally:
            self.receipt.add(receipt)
            shared.removed(self.spark, *self._paths)
            self._paths.clear()
        self.metrics.add("documents", receipt.documents, outcome="ingested")
        return receipt

    def _take(self, docs: DataFrame, guard: Guard, receipt: Receipt, source: str | None, batch: int) -> None:
        stored, seen = self._observed(D.numbered(D.sniffed(docs)), "documents", failed=F.count_if(F.col("error").isNotNull()))
        receipt.skipped, receipt.documents = seen["failed"], seen["rows"] - seen["failed"]
        if receipt.skipped:
            receipt.faults += self._shown(D.failed(stored), F.concat(F.lit("skipped "), "path", F.lit(": "), "error"))
        sound = stored.where("error IS NULL")
        formats = {r[0] for r in sound.select("format").distinct().collect()}
        tables = D.evidence_tables(sound, formats) if formats else {}
        tables = D.scanned(tables, self.scans, D.document_purls(sound), self.config.policy.scan_flags()) if tables else tables
        added = None
        if self.decorators and tables:
            tables, added, bad = self._decorated(tables, guard, receipt)
            receipt.decorated = receipt.documents
            sound = sound.join(bad, "path", "left_anti")
        passed = receipt.documents
        tables = self._expanded(sound, tables, receipt)
        if tables:
            tables = {n: self._kept(t, n) for n, t in tables.items()}
            receipt.fallbacks = fallbacks(tables, guard).agg(F.sum("fallbacks")).first()[0] or 0
            graph = merged(tables, guard)
            if added is not None:
                graph = merge(graph, Graph(added.drop("doc"), graph.edges.limit(0)))
            graph = self._enriched(Graph(self._kept(graph.nodes, "nodes"), self._kept(graph.edges, "edges")), sound, tables, guard, receipt, passed + receipt.expanded)
            nodes, n = self._observed(graph.nodes.drop("ord"), "nodes")
            edges, m = self._observed(graph.edges.drop("ord"), "edges")
        batches = {"nodes": nodes, "edges": edges} if tables else {}
        if self.config.sink is not None and batches:
            self._sent(nodes, edges, receipt)
        elif batches:
            receipt.nodes, receipt.edges = n["rows"], m["rows"]
        if self.store is not None:
            receipt.transactions += 1
            receipt.basis = max(receipt.basis, self.store.write(batches, guard.now, source, batch))
        if batches:
            self.metrics.add("records_emitted", n["rows"], kind="node")
            self.metrics.add("records_emitted", m["rows"], kind="edge")
        self.metrics.add("documents", receipt.skipped, outcome="skipped")
        for counter, amount in (("valid_time_fallbacks", receipt.fallbacks), ("expansion_documents", receipt.expanded), ("documents_decorated", receipt.decorated), ("documents_decorate_failed", receipt.decorate_failed), ("claims", receipt.claims)):
            self.metrics.add(counter, amount)

    def once(self) -> Receipt:
        """All documents under the configured paths, in the receivers' order."""
        return self.take(D.files(self.spark, *self.config.paths))

    def poll(self, checkpoint: str, per_trigger: int = 1000, once: bool = False) -> StreamingQuery:
        """A query that takes new documents as they come; with `once` it ends when all that are there have been taken. `ingest.drain` stops it between batches."""
        streams = [D.stream(self.spark, p, per_trigger).withColumn("receiver", F.lit(i)) for i, p in enumerate(self.config.paths)]

        def deliver(docs: DataFrame, batch: int) -> None:
            self.take(docs, stream_id(self.spark, checkpoint), batch)

        writer = reduce(DataFrame.unionByName, streams).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{max(self.config.poll, 0.1)} seconds")).start()

    def close(self) -> None:
        if self.expansion is not None:
            self.expansion.close()
