"""Enrichers: what documents, package URLs, fetched responses and histories say about nodes, as claims; and the chain that runs them under a policy.

An enricher takes (nodes, now) and returns claims. Lookups read response tables
that were fetched beforehand, so that a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from provgraph import shared
from provgraph.functions.enrichment import matches_alias, prop_text, purl_type, search_date, supplier_name, supplier_of, supplier_prefix, vulnerability_of_name
from provgraph.functions.text import float_text, text, time_text
from provgraph.operators.claims import RUNNERS, Policy, advisory_facts, as_of, claim_id, claim_records, derive, first_by_purl, resolve_aliases, stamp
from provgraph.operators.assemble import Graph
from provgraph.operators.merge import merge


@dataclass(frozen=True)
class Lookup:
    """Claims of a source, and the nodes (subject, error) that it couldn't look up."""

    claims: DataFrame
    lost: DataFrame


Enricher = Callable[[DataFrame, datetime], "DataFrame | Lookup"]


def _now(now: datetime) -> Column:
    return F.lit(now).cast("timestamp")


def _claims(rows: DataFrame, source: str, now: datetime, fact: Column | str, value: Column | str, ref: Column | str, at: Column, subject: str = "id", also: Column | None = None) -> DataFrame:
    named = lambda c: F.col(c) if isinstance(c, str) else c
    none = F.array().cast("array<string>")
    return rows.select(F.lit(source).alias("source"), F.col(subject).alias("subject"), named(fact).alias("fact"), named(value).alias("value"), named(ref).alias("ref"), _now(now).alias("fetched_at"), (none if also is None else also).alias("also"), at.alias("valid_from"))


def sbom_suppliers(parts: DataFrame) -> Enricher:
    """Suppliers that a document names for its parts (digest, place, purl, supplier): the last of a purl counts; its node's time holds."""

    def enrich(nodes: DataFrame, now: datetime) -> DataFrame:
        last = parts.where("purl IS NOT NULL").groupBy("digest", "purl").agg(F.max_by(supplier_name(F.col("supplier")), "place").alias("name")).where("name <> ''")
        return _claims(last.join(first_by_purl(nodes), "purl"), "sbom", now, F.lit("supplier"), "name", "digest", F.col("valid_from"))

    return enrich


def purl_suppliers(nodes: DataFrame, now: datetime) -> DataFrame:
    """Supplier, and country where a rule knows one, of packages whose URL a fixed rule matches."""
    found = first_by_purl(nodes).withColumn("rule", supplier_of(F.col("purl"))).where("rule IS NOT NULL")
    facts = F.array(F.struct(F.lit("supplier").alias("fact"), F.col("rule.supplier").alias("value")), F.struct(F.lit("origin_country").alias("fact"), F.col("rule.country").alias("value")))
    rows = found.withColumn("f", F.explode(facts)).where("f.value <> ''").withColumn("rule_ref", F.concat(purl_type(F.col("purl")), F.lit("/"), supplier_prefix(F.col("purl"))))
    return _claims(rows, "purl", now, "f.fact", "f.value", "rule_ref", F.col("valid_from"))


def owners(responses: DataFrame) -> Enricher:
    """Owners of packages' repositories; responses: purl, place, status, owner, repository_url.

    The first record of a purl counts. A package with a response other than 200 has
    failed: documents that name it go without this source.
    """

    def enrich(nodes: DataFrame, now: datetime) -> Lookup:
        asked = first_by_purl(nodes).join(responses, "purl")
        bad = F.coalesce(F.col("status") != 200, F.lit(True))
        lost = asked.where(bad).groupBy(F.col("id").alias("subject")).agg(F.concat(F.lit("status "), F.coalesce(F.min("status").cast("string"), F.lit("unknown"))).alias("error"))
        first = asked.where(~bad).groupBy("purl").agg(F.min_by(F.struct("id", "owner", "repository_url"), "place").alias("x")).select("x.*").where("owner <> ''")
        return Lookup(_claims(first, "ecosystems", now, F.lit("supplier"), "owner", "repository_url", _now(now)), lost)

    return enrich


def european_facts(items: DataFrame, failed: DataFrame | None = None) -> Enricher:
    """Facts of the European vulnerability search; items: asked, id, aliases, base_score, base_score_version, base_score_vector, epss, description, date_published, date_updated, references.

    Only items that name what was asked count. Facts without a value stay as
    claims; the date of the update holds, else now. `failed` (key, error) names
    what couldn't be asked.
    """

    def enrich(nodes: DataFrame, now: datetime) -> DataFrame | Lookup:
        p = F.col("props")
        names = nodes.where(F.array_contains("labels", "Vulnerability") & prop_text(p, "type").isin("cve", "euvd")).select(prop_text(p, "vulnID").alias("asked")).distinct()
        rows = items.join(names, "asked").where(matches_alias(F.col("asked"), F.col("id"), F.col("aliases")))
        rows = rows.withColumns({"published": search_date(F.col("date_published")), "updated": search_date(F.col("date_updated")), "subject": vulnerability_of_name(F.col("asked"))})
        fact = lambda n, c: F.struct(F.lit(n).alias("fact"), text(c).alias("value"))
        always = [fact("euvd_id", F.col("id")), fact("cvss", float_text(F.col("base_score"), "f")), fact("cvss_version", F.col("base_score_version")), fact("cvss_vector", F.col("base_score_vector")), fact("epss", float_text(F.col("epss"), "f")), fact("description", F.col("description"))]
        dated = [F.when(F.col(n).isNotNull(), fact(n, time_text(F.date_trunc("second", n)))) for n in ("published", "updated")]
        lines = F.filter(F.transform(F.split(text(F.col("references")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
        every = F.concat(F.filter(F.array(*always, *dated), lambda x: x.isNotNull()), F.transform(lines, lambda x: F.struct(F.lit("reference").alias("fact"), x.alias("value"))))
        claims = _claims(rows.withColumn("f", F.explode(every)), "euvd", now, "f.fact", "f.value", "id", F.coalesce("updated", _now(now)), "subject")
        if failed is None:
            return claims
        return Lookup(claims, failed.join(names, failed["key"] == names["asked"]).select(vulnerability_of_name(F.col("asked")).alias("subject"), "error"))

    return enrich


def affected_packages(advisories: DataFrame, known: DataFrame, failed: DataFrame | None = None) -> Enricher:
    """What a vulnerability service says about packages; advisories: purl, advisory_id, aliases, summary, cvss, cvss_version, cvss_vector, epss, references, fixed_by.

    One `affected` claim on the package, about the aliases that have nodes too,
    and the advisory's facts on each of those nodes; now holds. `failed` (key,
    error) names the package URLs that couldn't be asked.
    """

    def enrich(nodes: DataFrame, now: datetime) -> DataFrame | Lookup:
        rows = first_by_purl(nodes).join(advisories, "purl").withColumn("row", F.xxhash64("purl", "advisory_id"))
        ids = resolve_aliases(rows.select("row", "aliases"), known, "row")
        rows = rows.join(ids, "row", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
        affected = _claims(rows, "vulnerablecode", now, F.lit("affected"), "advisory_id", "advisory_id", _now(now), also=F.col("ids"))
        about = rows.select(F.explode("ids").alias("subject"), F.array().cast("array<string>").alias("also"), F.lit("vulnerablecode").alias("source"), F.lit(None).cast("timestamp").alias("at"), "advisory_id", "summary", "cvss", "cvss_version", "cvss_vector", "epss", "references", "fixed_by")
        claims = affected.unionByName(advisory_facts(about, _now(now)))
        if failed is None:
            return claims
        return Lookup(claims, first_by_purl(nodes).join(failed, F.col("purl") == F.col("key")).select(F.col("id").alias("subject"), "error"))

    return enrich


@dataclass
class Replayed:
    """Claims in the order of their times, subjects without a history, and how many different commits were read."""

    claims: DataFrame
    missing: DataFrame
    commits: DataFrame


def replayed(commits: DataFrame, advisories: DataFrame, subjects: DataFrame, known: DataFrame, now: datetime, stated: DataFrame | None = None) -> Replayed:
    """Claims of a history of package files and advisories, dated by their commits.

    commits: path, commit, committed_at, affected_by; advisories: vcid, commit,
    committed_at, aliases and the advisory's facts; subjects: purl, path,
    subject; known: names and ids of vulnerability nodes. A package's claim is
    about the aliases that the advisory had at that commit: those of `stated`
    (vcid, commit, aliases) where it is given, else the last ones before it. An
    advisory's facts are those of its own commits. Where commits name a purl, its
    lists hold for that subject only; a commit without one was read all the same.
    """
    listed = subjects.join(commits, ["path", "purl"] if "purl" in commits.columns else "path").select("subject", "commit", "committed_at", F.explode("affected_by").alias("vcid"))
    if stated is None:
        dated = as_of(listed, advisories.select("vcid", "committed_at", "aliases"), "vcid", "committed_at", "aliases")
    else:
        dated = listed.join(stated, ["vcid", "commit"], "left")
    dated = dated.withColumn("row", F.xxhash64("subject", "vcid", "commit", "committed_at"))
    ids = resolve_aliases(dated.select("row", "aliases").dropDuplicates(["row"]), known, "row")
    dated = dated.join(ids, "row", "left")
    affected = _claims(dated, "federatedcode", now, F.lit("affected"), "vcid", "vcid", F.col("committed_at"), "subject", F.coalesce("ids", F.array().cast("array<string>")))
    named = advisories.join(listed.select("vcid").distinct(), "vcid", "left_semi").withColumn("row", F.xxhash64("vcid", "commit"))
    about = named.join(resolve_aliases(named.select("row", "aliases"), known, "row"), "row")
    facts = advisory_facts(about.select(F.explode("ids").alias("subject"), F.array().cast("array<string>").alias("also"), F.lit("federatedcode").alias("source"), F.col("committed_at").alias("at"), F.col("vcid").alias("advisory_id"), "summary", "cvss", "cvss_version", "cvss_vector", "epss", "references", "fixed_by"), _now(now))
    read = commits.join(subjects, "path", "left_semi").select("commit").union(named.select("commit")).distinct()
    return Replayed(affected.unionByName(facts), subjects.join(commits.select("path").distinct(), "path", "left_anti"), read)


def in_order(claims: DataFrame, by_time: bool = False) -> DataFrame:
    """Claims by their ids, or a history's by their times."""
    return claims.orderBy("valid_from", claim_id()) if by_time else claims.orderBy(claim_id())


@dataclass
class Enriched:
    """The graph with its claims, how many were folded in (before equal ones unite), the sources that failed as a whole, and (doc, source, error) of the documents that went without a source."""

    graph: Graph
    claims: int
    failed: list[tuple[str, str]]
    errors: DataFrame
    paths: list[str]

    def close(self) -> None:
        """Remove the tables that the graph is read from."""
        shared.removed(self.errors.sparkSession, *self.paths)


def _spared(found: Lookup, source: str, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims that a document without a lost node supports, errors of the others)."""
    named = members.select("doc", F.col("id").alias("subject"))
    errors = named.join(found.lost, "subject").groupBy("doc").agg(F.min("error").alias("error")).select("doc", F.lit(source).alias("source"), "error")
    sound = named.join(errors.select("doc"), "doc", "left_anti").select("subject").distinct()
    return found.claims.join(sound, "subject", "left_semi").select(*found.claims.columns), errors


def enriched(graph: Graph, policy: Policy, enrichers: dict[str, Enricher], now: datetime, members: DataFrame | None = None) -> Enriched:
    """Scanners' evidence turned into claims, then every allowed enricher in the policy's order, each seeing the claims before it.

    `members` (doc, id) tells which documents name a node: a lookup that fails
    costs only those the source, and a claim stays if another document supports
    it. Without it a lost node's claims go. A source that fails as a whole, or
    that the policy names and nobody runs, is reported; the graph goes on without
    it. What the policy refuses is silent. The graph and each source's claims are
    stored before the next source reads them, so a source adds one step to the
    plan, and nothing is worked out twice.
    """
    spark = graph.nodes.sparkSession
    paths, made, failed, n = [], [], [], 0

    def kept(df: DataFrame, name: str) -> DataFrame:
        rows, path = shared.kept(df, name)
        paths.append(path)
        return rows

    base = Graph(*[kept(df.drop("doc"), name) for df, name in ((graph.nodes, "nodes"), (graph.edges, "edges"))])
    errors = spark.createDataFrame([], "doc string, source string, error string")

    def nodes() -> DataFrame:
        return reduce(DataFrame.unionByName, [base.nodes, *[g.nodes.drop("doc") for g in made]])

    def fold(claims: DataFrame, phase: int) -> int:
        stamped = kept(stamp(claims, policy), "claims")
        made.append(claim_records(stamped, phase))
        return stamped.count()

    n = fold(derive(base.nodes), 18)
    for place, source in enumerate(s for s, runner in policy.runners() if runner == "enricher"):
        if source not in enrichers:
            failed.append((source, "nothing runs this source"))
            continue
        try:
            found = enrichers[source](nodes(), now)
            if isinstance(found, Lookup):
                held = members if members is not None else base.nodes.select(F.col("id").alias("doc"), "id")
                found, lost = _spared(found, source, held)
                errors = errors.unionByName(kept(lost, "errors"))
            n += fold(found, 19 + place)
        except Exception as error:  # noqa: BLE001 - whatever a source does wrong, the documents are kept
            failed.append((source, f"{type(error).__name__}: {error}"))
    return Enriched(merge(base, *[Graph(g.nodes.drop("doc"), g.edges.drop("doc")) for g in made]), n, failed, errors, paths)


Decorator = Callable[[pd.DataFrame], pd.DataFrame]


def decorated_rows(nodes: DataFrame, *decorators: Decorator) -> DataFrame:
    """Records of the documents that every decorator passed, in turn, with a null error; one row with doc and error for each of the others. A decorator gets one document's records."""
    schema = StructType([*nodes.schema.fields, StructField("error", StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc = pdf["doc"].iloc[0]
        try:
            for decorate in decorators:
                pdf = decorate(pdf)
            return pdf.assign(error=None)[schema.names]
        except Exception as error:  # noqa: BLE001 - one document's fault mustn't end the others
            return pd.DataFrame([{n: None for n in schema.names} | {"doc": doc, "error": f"{type(error).__name__}: {error}"}])[schema.names]

    return nodes.groupBy("doc").applyInPandas(run, schema)


def decorated(nodes: DataFrame, *decorators: Decorator) -> tuple[DataFrame, DataFrame]:
    """(records of the documents that every decorator passed, doc and error of the others)."""
    done = decorated_rows(nodes, *decorators)
    return done.where("error IS NULL").drop("error"), done.where("error IS NOT NULL").select("doc", "error")


def runner_of(source: str) -> str:
    """How a source runs; one that isn't known is an enricher."""
    return RUNNERS.get(source, "enricher")


def receipts_folded(receipts: DataFrame) -> DataFrame:
    """One receipt of many (batch, nodes, edges, transactions, basis): sums, and the last basis."""
    return receipts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("nodes", "edges", "transactions")], F.max_by("basis", "batch").alias("basis"))
