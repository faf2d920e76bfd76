"""A small pattern language over nodes and edges: fixed-length paths as chains of equi-joins.

`path(graph).start("CertifyVuln", …).out("…").into("…")` keeps one row for each
distinct binding of the named variables. An edge's label determines the labels
of its ends, so node tables are joined only where a node's properties or its own
validity matter (`as_of`).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provgraph.operators.assemble import EvidenceGraph, Graph
from provgraph.shared import kept


@dataclass(frozen=True)
class Instant:
    """Valid and system time of a query; None: all valid times, and what the store holds now."""

    valid: datetime | None = None
    system: datetime | None = None

    def held(self, columns: list[str]) -> Column:
        """Whether a row with these columns is in force."""
        found = F.lit(True)
        if self.valid is not None:
            at = F.lit(self.valid).cast("timestamp")
            found = found & (F.col("valid_from") <= at)
            if "valid_to" in columns:
                found = found & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
        if "system_to" in columns:
            if self.system is None:
                found = found & F.col("system_to").isNull()
            else:
                at = F.lit(self.system).cast("timestamp")
                found = found & (F.col("system_from") <= at) & (F.col("system_to").isNull() | (at < F.col("system_to")))
        return found

    def holds(self, df: DataFrame) -> DataFrame:
        return df.where(self.held(df.columns))


@dataclass(frozen=True)
class Path:
    graph: Graph | EvidenceGraph
    instant: Instant
    rows: DataFrame
    at: str

    def _edges(self, label: str) -> DataFrame:
        return self.instant.holds(self.graph.edges_of(label))

    def _valid(self, rows: DataFrame, column: str) -> DataFrame:
        """Under a valid time the node itself must hold too."""
        if self.instant.valid is None or self.graph.ends_hold:
            return rows
        nodes = self.instant.holds(self.graph.nodes).select(F.col("id").alias(column))
        return rows.join(nodes, column, "left_semi")

    def _hop(self, label: str, near: str, far: str, name: str) -> Path:
        step = self._edges(label).select(F.col(near).alias(self.at), F.col(far).alias(name)).distinct()
        return replace(self, rows=self._valid(self.rows.join(step, self.at), name), at=name)

    def out(self, label: str, name: str) -> Path:
        """Follow edges from their source."""
        return self._hop(label, "src", "dst", name)

    def into(self, label: str, name: str) -> Path:
        """Follow edges backwards, from their target."""
        return self._hop(label, "dst", "src", name)

    def keep(self, *names: str) -> Path:
        """Distinct bindings of these variables; the last is where the path goes on."""
        return replace(self, rows=self.rows.select(*names).distinct(), at=names[-1])

    def where_reaches(self, *hops: tuple[str, str]) -> Path:
        """Semi-join: bindings from which a chain of (direction, label) hops exists; built from its far end."""
        reach: DataFrame | None = None
        for direction, label in reversed(hops):
            near, far = ("src", "dst") if direction == "out" else ("dst", "src")
            step = self._edges(label).select(F.col(near).alias("near"), F.col(far).alias("far"))
            step = self._valid(step, "far")
            reach = (step if reach is None else step.join(reach.select(F.col("near").alias("far")), "far", "left_semi")).select("near").distinct()
        return replace(self, rows=self.rows.join(reach.select(F.col("near").alias(self.at)), self.at, "left_semi"))


def path(graph: Graph | EvidenceGraph, name: str, label: str, only: Column | None = None, instant: Instant | None = None) -> Path:
    """Paths that start at nodes of a label that meet a condition."""
    instant = instant or Instant()
    nodes = instant.holds(graph.nodes_of(label))
    if only is not None:
        nodes = nodes.where(only)
    return Path(graph, instant, nodes.select(F.col("id").alias(name)), name)


def _met(rows: DataFrame) -> DataFrame:
    """Rows with the intervals valid_* and other_* as their common part; those without one go. Null bounds are open."""
    begins, ends = F.greatest("valid_from", "other_from"), F.least("valid_to", "other_to")
    rows = rows.withColumns({"valid_from": begins, "valid_to": ends}).drop("other_from", "other_to")
    return rows.where(F.coalesce(F.col("valid_from") < F.col("valid_to"), F.lit(True)))


def coalesced(rows: DataFrame) -> DataFrame:
    """Rows with valid_from and valid_to: for equal rows, intervals that overlap or meet as one (gaps and islands)."""
    names = [c for c in rows.columns if c not in ("valid_from", "valid_to")]
    far = F.lit(datetime(9999, 12, 31, tzinfo=UTC)).cast("timestamp")
    own = Window.partitionBy(*names).orderBy(F.asc_nulls_first("valid_from"), F.asc_nulls_last("valid_to"))
    reached = F.max(F.coalesce("valid_to", far)).over(own.rowsBetween(Window.unboundedPreceding, -1))
    begun = rows.withColumn("begins", F.coalesce((F.col("valid_from") > reached).cast("int"), F.when(reached.isNull(), 1).otherwise(0)))
    island = begun.withColumn("island", F.sum("begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    ends = F.max(F.coalesce("valid_to", far)).alias("valid_to")
    # min leaves nulls out, so an open beginning is looked for.
    begin = F.when(~F.bool_or(F.col("valid_from").isNull()), F.min("valid_from")).alias("valid_from")
    return island.groupBy(*names, "island").agg(begin, ends).select(*names, "valid_from", F.when(F.col("valid_to") < far, F.col("valid_to")).alias("valid_to"))


@dataclass(frozen=True)
class Timeline:
    """Paths with the times at which all of their records hold: each row is a binding and an interval."""

    graph: Graph
    system: Instant
    rows: DataFrame
    at: str

    def _records(self, rows: DataFrame, **names: str) -> DataFrame:
        held = self.system.holds(rows)
        return held.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("valid_from").alias("other_from"), F.col("valid_to").alias("other_to"))

    def _hop(self, label: str, near: str, far: str, name: str) -> Timeline:
        rows = _met(self.rows.join(self._records(self.graph.edges_of(label), **{near: self.at, far: name}), self.at))
        return replace(self, rows=_met(rows.join(self._records(self.graph.nodes, id=name), name)), at=name)

    def out(self, label: str, name: str) -> Timeline:
        return self._hop(label, "src", "dst", name)

    def into(self, label: str, name: str) -> Timeline:
        return self._hop(label, "dst", "src", name)

    def all(self) -> DataFrame:
        """Every binding with all of its intervals, valid_from to valid_to (null: open)."""
        return coalesced(self.rows)

    def between(self, start: datetime, end: datetime, closed: bool = False) -> DataFrame:
        """Those intervals that hold at some time of a range."""
        return overlapping(self.all(), start, end, closed)


def timeline(graph: Graph, name: str, label: str, only: Column | None = None, system: datetime | None = None) -> Timeline:
    """Paths over all valid times that start at nodes of a label, as known at a system time (None: now). Nodes and edges have the columns of a store."""
    known = Instant(None, system)
    nodes = known.holds(graph.nodes_of(label))
    nodes = nodes if only is None else nodes.where(only)
    return Timeline(graph, known, nodes.select(F.col("id").alias(name), "valid_from", "valid_to"), name)


#: Packages with a finding that are sent to all tasks; beyond that the join is a shuffle.
FEW = 100_000


def blast_radius(graph: Graph | EvidenceGraph, only: Column | None = None, instant: Instant | None = None) -> DataFrame:
    """Products that depend on a package with a certified vulnerability and that have an artifact with an SBOM: (vulnerability, product)."""
    instant = instant or Instant()
    if isinstance(graph, EvidenceGraph):
        return _blast_radius_of_evidence(graph, only, instant)
    # The first hop's targets are the vulnerabilities in question; their own table would add nothing.
    seeds = instant.holds(graph.edges_of("CertifyVulnVulnerability")).select(F.col("dst").alias("id")).distinct()
    start = Path(graph, instant, (seeds if only is None else seeds.where(only)).select(F.col("id").alias("vulnerability")), "vulnerability")
    bad = start.into("CertifyVulnVulnerability", "finding").into("CertifyVulnSubject", "bad").keep("vulnerability", "bad")
    product = bad.into("IsDependencyObject", "dependency").into("IsDependencySubject", "product").keep("vulnerability", "product")
    return product.where_reaches(("out", "IsOccurrenceSubject"), ("out", "IsOccurrenceArtifact"), ("out", "HasSbomSubject")).rows


def _blast_radius_of_evidence(graph: EvidenceGraph, only: Column | None, instant: Instant) -> DataFrame:
    """The same where both ends of a hop stand in one evidence row: a pair holds at an instant if any of its rows does.

    The bad packages are stored and counted first; few of them go to every task.
    Dependencies are cut down to theirs, and to products with an SBOM, before each
    is multiplied by the vulnerabilities of its packages.
    """
    seeds = instant.holds(graph.pairs_of("CertifyVuln")).select(F.col("object").alias("id"), F.col("subject").alias("bad"))
    bad, _ = kept((seeds if only is None else seeds.where(only)).select(F.col("id").alias("vulnerability"), "bad").distinct(), "bad")
    few = bad.limit(FEW + 1).count() <= FEW
    depends = instant.holds(graph.pairs_of("IsDependency", among=bad.select("bad").distinct())).select(F.col("object").alias("bad"), F.col("subject").alias("product"))
    occurs = instant.holds(graph.pairs_of("IsOccurrence")).select(F.col("subject").alias("product"), F.col("object").alias("artifact"))
    held = instant.holds(graph.subjects_of("HasSBOM")).select(F.col("subject").alias("artifact"))
    product = depends.join(occurs.join(held, "artifact", "left_semi").select("product"), "product", "left_semi")
    return product.join(F.broadcast(bad) if few else bad, "bad").select("vulnerability", "product").distinct()


def overlapping(df: DataFrame, start: datetime, end: datetime, closed: bool = False) -> DataFrame:
    """Records valid at some time from `start` to `end`: half-open, or closed at its end (FROM ... TO, BETWEEN ... AND)."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    begun = F.col("valid_from") <= last if closed else F.col("valid_from") < last
    return df.where(begun & (F.col("valid_to").isNull() | (F.col("valid_to") > first))) if "valid_to" in df.columns else df.where(begun)
