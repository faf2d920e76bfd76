"""Claims: what enrichment sources say about nodes, stamped under a policy of sources and jurisdictions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.functions import ids
from provgraph.functions.enrichment import prop_text
from provgraph.functions.text import required_time
from provgraph.operators.assemble import PHASE, Graph, Guard, _edge, node, prop
from provgraph.functions.schemas import PROPS

#: Sources, how they run, and the jurisdictions that don't depend on a host.
RUNNERS = {"euvd": "enricher", "vulnerablecode": "enricher", "osv": "scanner", "clearlydefined": "scanner", "eol": "scanner", "deps_dev": "scanner", "federatedcode": "replay", "sbom": "enricher", "purl": "enricher", "ecosystems": "enricher"}
JURISDICTIONS = {"euvd": "eu", "osv": "us", "clearlydefined": "us", "eol": "us", "deps_dev": "us"}
KNOWN_JURISDICTIONS = ("eu", "us", "other")
FACTS = (
    "affected",
    "declared_license",
    "discovered_license",
    "endoflife",
    "scorecard",
    "euvd_id",
    "cvss",
    "cvss_version",
    "cvss_vector",
    "epss",
    "description",
    "published",
    "updated",
    "reference",
    "advisory_id",
    "fixed_by",
    "supplier",
    "origin_country",
)
CLAIM = "source string, subject string, fact string, value string, ref string, fetched_at timestamp, also array<string>, valid_from timestamp"


@dataclass(frozen=True)
class Policy:
    """Sources in order; with `eu_only` those under other jurisdictions are left out. `hosted` says where a source runs."""

    sources: tuple[str, ...]
    eu_only: bool = False
    hosted: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        for s in self.sources:
            if s not in RUNNERS:
                raise ValueError(f"unknown source {s!r}")
        if len(set(self.sources)) != len(self.sources):
            raise ValueError("a source is named twice")
        for s, j in self.hosted.items():
            if s not in RUNNERS or j not in KNOWN_JURISDICTIONS:
                raise ValueError(f"unknown source or jurisdiction: {s!r}, {j!r}")

    def jurisdiction(self, source: str) -> str:
        """Where it is hosted, else its fixed place, else `other`: what isn't known is not the EU."""
        return self.hosted.get(source) or JURISDICTIONS.get(source, "other")

    def allows(self, source: str) -> bool:
        return source in self.sources and (not self.eu_only or self.jurisdiction(source) == "eu")

    def scan_flags(self) -> dict[str, bool]:
        return {s: self.allows(s) for s, r in RUNNERS.items() if r == "scanner"}

    def runners(self) -> list[tuple[str, str]]:
        """(source, runner) of the allowed sources, in order; plans never build the branch of another."""
        return [(s, RUNNERS[s]) for s in self.sources if self.allows(s)]

    def jurisdiction_of(self, source: Column) -> Column:
        found = F.lit("other")
        for s in RUNNERS:
            found = F.when(source == s, self.jurisdiction(s)).otherwise(found)
        return found


def derive(nodes: DataFrame) -> DataFrame:
    """Claims that scanners' evidence nodes state, by label and collector."""
    keys = ("collector", "objectId", "subjectId", "declaredLicense", "discoveredLicense", "key", "value", "aggregateScore", "timeScanned", "timestamp")
    # Read once into columns; what follows names them often.
    nodes = nodes.select(F.get("labels", F.lit(0)).alias("label"), "id", "valid_from", *[prop_text(F.col("props"), k, k == "aggregateScore").alias(k) for k in keys])
    read, label = F.col, F.col("label")
    collector, target = read("collector"), read("objectId")

    def fact(name: str, value: Column, also: Column | None = None) -> Column:
        return F.struct(F.lit(name).alias("fact"), value.alias("value"), (F.array().cast("array<string>") if also is None else also).alias("also"))

    osv = (label == "CertifyVuln") & (collector == "osv_certifier") & (target != ids.NO_VULNERABILITY)
    legal = (label == "CertifyLegal") & (collector == "clearlydefined")
    eol = (label == "HasMetadata") & (collector == "GUAC") & (read("key") == "endoflife")
    card = (label == "CertifyScorecard") & (collector == "ingest_depsdev_scanner")
    facts = (
        F.when(osv, F.array(fact("affected", target, F.array(target))))
        .when(legal, F.array(fact("declared_license", read("declaredLicense")), fact("discovered_license", read("discoveredLicense"))))
        .when(eol, F.array(fact("endoflife", read("value"))))
        .when(card, F.array(fact("scorecard", read("aggregateScore"))))
    )
    source = F.when(osv, "osv").when(legal, "clearlydefined").when(eol, "eol").when(card, "deps_dev")
    at = F.try_to_timestamp(F.coalesce(read("timeScanned"), read("timestamp")))
    rows = nodes.where(facts.isNotNull()).select(source.alias("source"), read("subjectId").alias("subject"), F.explode(facts).alias("x"), F.col("id").alias("ref"), at.alias("fetched_at"), "valid_from")
    return rows.where(F.coalesce("x.value", F.lit("")) != "").select("source", "subject", "x.fact", "x.value", "ref", "fetched_at", "x.also", "valid_from")


def claim_id(c: DataFrame | None = None) -> Column:
    return ids.evidence_id("Claim", F.col("source"), F.col("subject"), F.col("fact"), F.col("value"))


def stamp(claims: DataFrame, policy: Policy) -> DataFrame:
    """Claims of allowed sources with their jurisdictions."""
    allowed = [s for s in policy.sources if policy.allows(s)]
    return claims.where(F.col("source").isin(allowed)).withColumn("source_jurisdiction", policy.jurisdiction_of(F.col("source")))


def claim_records(stamped: DataFrame, phase: int = 18) -> Graph:
    """A Claim node for each claim, and ABOUT edges to its subject and what else it is about."""
    names = [("source", "source"), ("source_jurisdiction", "source_jurisdiction"), ("fetched_at", None), ("fact", "fact"), ("value", "value"), ("ref", "ref"), ("subject_id", "subject")]
    props = [prop(k, required_time(F.col("fetched_at")) if c is None else F.col(c)) for k, c in names]
    ordinal = F.lit(phase * PHASE)
    nodes = stamped.select(node(claim_id(), "Claim", props).alias("n"), "valid_from").select("n.*", "valid_from", ordinal.alias("ord"), F.lit(None).cast("string").alias("doc"))
    about = F.filter(F.array_distinct(F.concat(F.array("subject"), F.coalesce("also", F.array().cast("array<string>")))), lambda x: F.coalesce(x, F.lit("")) != "")
    edges = stamped.select(claim_id().alias("src"), F.explode(about).alias("dst"), "valid_from").select(_edge(F.col("src"), "ABOUT", F.col("dst")).alias("e"), "valid_from")
    edges = edges.select("e.*", F.array().cast(PROPS).alias("props"), "valid_from", ordinal.alias("ord"), F.lit(None).cast("string").alias("doc"))
    return Graph(nodes, edges)


def first_by_purl(nodes: DataFrame) -> DataFrame:
    """(purl, id, valid_from) of the first PkgVersion node with each purl; one node has one purl, so the smallest ordinal decides."""
    packages = nodes.where(F.array_contains("labels", "PkgVersion")).select("id", prop_text(F.col("props"), "purl").alias("purl"), "valid_from", "ord").where("purl IS NOT NULL")
    return packages.groupBy("purl").agg(F.min(F.struct("ord", "id", "valid_from")).alias("x")).select("purl", "x.id", "x.valid_from")


def vulnerability_nodes(nodes: DataFrame) -> DataFrame:
    """(name, id) of vulnerability nodes by lower-case name; the last of several wins."""
    v = nodes.where(F.array_contains("labels", "Vulnerability")).select(F.lower(prop_text(F.col("props"), "vulnID")).alias("name"), "id", "ord").where("name IS NOT NULL")
    return v.groupBy("name").agg(F.max(F.struct("ord", "id")).alias("x")).select("name", "x.id")


def advisory_facts(advisories: DataFrame, now: Column) -> DataFrame:
    """Facts of advisories (subject, advisory_id, summary, cvss, epss, references, fixed_by, at), empty ones dropped, one row each."""
    facts = F.array(
        *[F.struct(F.lit(n).alias("fact"), F.col(c).cast("string").alias("value")) for n, c in (("advisory_id", "advisory_id"), ("description", "summary"), ("cvss", "cvss"), ("cvss_version", "cvss_version"), ("cvss_vector", "cvss_vector"), ("epss", "epss"))]
    )
    lists = [F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x) for c in ("references", "fixed_by")]
    named = [_named(n, c) for n, c in zip(("reference", "fixed_by"), lists, strict=True)]
    rows = advisories.select("subject", "also", "source", "at", F.explode(F.concat(facts, *named)).alias("f"))
    return rows.where(F.coalesce("f.value", F.lit("")) != "").select("source", "subject", "f.fact", "f.value", F.lit("").alias("ref"), now.alias("fetched_at"), "also", F.coalesce("at", now).alias("valid_from"))


def _named(fact: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(fact).alias("fact"), v.alias("value")))


def resolve_aliases(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, aliases as node ids): only names that have a node, in the order given."""
    each = rows.select(key, F.posexplode("aliases").alias("place", "alias")).withColumn("name", F.lower(F.trim("alias")))
    found = each.join(known, "name")
    return found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("x")).select(key, F.transform("x", lambda s: s["id"]).alias("ids"))


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str, out: str | None = None) -> DataFrame:
    """`left` with the value that `right` had at each row's time: the last one of its key at or before it, null before the first.

    One shuffle on the key: both sides are interleaved and the last value is
    carried forward. Keys are files of a repository, whose histories are short.
    """
    from pyspark.sql.window import Window

    out = out or value
    columns = left.columns
    mine = left.select(*columns, F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"))
    theirs = right.select(*[F.col(c) if c in (key, at) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in columns], F.struct(F.col(value).alias("v"))["v"].alias("_v"), F.lit(0).alias("_side"))
    order = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = mine.unionByName(theirs).withColumn(out, F.last("_v", ignorenulls=True).over(order))
    return both.where("_side = 1").drop("_v", "_side")


def budget(rows: DataFrame, limit: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """(the first `limit` rows in that order, one row that says whether more were there)."""
    return rows.orderBy(*order).limit(limit), rows.agg((F.count("*") > limit).alias("exhausted"), F.count("*").alias("offered"))
