"""Registered enrichment queries, over claims, package URLs, severities and histories made of the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.functions import enrichment as E
from provgraph.functions import ids
from provgraph.functions.text import text
from provgraph.operators import assemble as A
from provgraph.operators import claims as C
from provgraph.operators import enrichers as X
from provgraph.operators import merge as M
from provgraph.plans import lens
from provgraph.plans import oracle as O
from provgraph.plans.lens import GUARD

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


POLICY = C.Policy(("osv", "clearlydefined", "eol", "deps_dev", "euvd"))
SCANNED = ("CertifyVuln", "CertifyLegal", "HasMetadata", "CertifyScorecard")


def _claims(spark, d):
    """Claims of all scanners' evidence; repeats of a node only repeat its claims."""
    nodes = [A.evidence_nodes(lens.TABLES[n](spark, d), n, GUARD) for n in SCANNED]
    return C.derive(reduce(DataFrame.unionByName, nodes))


LEGAL_SRC = "'src:n:doc/' || source || '/doc-' || doc_id || '@@'"
CLAIMS = f"""
SELECT DISTINCT 'osv' AS source, {O.PART_V} AS subject, 'affected' AS fact, 'vuln:osv/' || {O.CVE} AS value, 'vuln:osv/' || {O.CVE} AS other FROM {O.EVENTS.format('error')} AND {O.K} % 2 = 1 AND {O.K} % 10 <> 0
UNION ALL SELECT DISTINCT 'clearlydefined', {LEGAL_SRC}, unnest(['declared_license', 'discovered_license']), unnest([lang, source]), '' FROM documents WHERE doc_id % 2 = 0
UNION ALL SELECT DISTINCT 'eol', {O.PART_V}, 'endoflife', {O.K}::VARCHAR, '' FROM {O.EVENTS.format('signup')} AND event_id % 2 = 0
UNION ALL SELECT DISTINCT 'deps_dev', {O.SCORE_SRC}, 'scorecard', {O.float_g(O.AGGR)}, '' FROM supplier"""
CLAIM_ID = f"'Claim:' || sha256({O.frame('source', 'subject', 'fact', 'value')})"


@query(f"SELECT DISTINCT source, subject, fact, value FROM ({CLAIMS})")
def derive_claims(spark, d):
    return _claims(spark, d).select("source", "subject", "fact", "value").distinct()


@query(f"SELECT DISTINCT {CLAIM_ID} AS id, CASE source WHEN 'euvd' THEN 'eu' ELSE 'us' END AS jurisdiction FROM ({CLAIMS})")
def claim_nodes(spark, d):
    nodes = M.merge_records(C.claim_records(C.stamp(_claims(spark, d), POLICY)).nodes)
    return nodes.select("id", E.prop_text(F.col("props"), "source_jurisdiction").alias("jurisdiction"))


@query(f"SELECT DISTINCT {CLAIM_ID} AS src, subject AS dst FROM ({CLAIMS}) UNION SELECT {CLAIM_ID}, other FROM ({CLAIMS}) WHERE other <> ''")
def claim_about_edges(spark, d):
    return C.claim_records(C.stamp(_claims(spark, d), POLICY)).edges.select("src", "dst").distinct()


@query(f"SELECT source, count(*) AS n FROM ({CLAIMS}) WHERE source IN ('osv', 'eol') GROUP BY source")
def policy_allowed(spark, d):
    """Only sources that the policy names, and of them only those hosted in the EU."""
    policy = C.Policy(("osv", "eol", "deps_dev"), eu_only=True, hosted={"osv": "eu", "eol": "eu"})
    return C.stamp(_claims(spark, d), policy).select("source", "subject", "fact", "value").distinct().groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT source, CASE source WHEN 'osv' THEN 'us' WHEN 'eol' THEN 'us' END AS jurisdiction, count(*) AS n FROM ({CLAIMS}) WHERE source IN ('osv', 'eol') GROUP BY source")
def jurisdiction_stamp(spark, d):
    """Claims by the jurisdiction they are stamped with; what the policy doesn't name is left out."""
    stamped = C.stamp(_claims(spark, d), C.Policy(("osv", "eol")))
    return stamped.select("source", "subject", "fact", "value", "source_jurisdiction").distinct().groupBy("source", F.col("source_jurisdiction").alias("jurisdiction")).agg(F.count("*").alias("n"))


def _purl():
    return F.concat(F.element_at(F.array(*map(F.lit, ("pkg:golang/golang.org/x/", "pkg:deb/debian/", "pkg:maven/org.apache.commons/", "pkg:rpm/redhat/", "pkg:npm/", "pkg:npm/@angular/"))), (F.col("p_partkey") % 6 + 1).cast("int")), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("@"), F.col("p_size"))
_PURL_SQL = "(['pkg:golang/golang.org/x/', 'pkg:deb/debian/', 'pkg:maven/org.apache.commons/', 'pkg:rpm/redhat/', 'pkg:npm/', 'pkg:npm/@angular/'][p_partkey % 6 + 1] || replace(p_name, ' ', '-') || '@' || p_size)"


@query(f"SELECT p_partkey, ['Google LLC', 'Debian Project', 'The Apache Software Foundation', 'Red Hat, Inc.', NULL, NULL][p_partkey % 6 + 1] AS supplier, ['US', '', 'US', 'US', NULL, NULL][p_partkey % 6 + 1] AS country FROM part")
def purl_supplier(spark, d):
    found = E.supplier_of(_purl())
    return lens.table(spark, d, "part").select("p_partkey", found["supplier"].alias("supplier"), found["country"].alias("country"))


@query(f"SELECT p_partkey, split_part(split_part(p, '/', 1), ':', 2) AS type, CASE WHEN p_partkey % 6 = 5 THEN '' ELSE split_part(substr(p, length(split_part(p, '/', 1)) + 2), '@', 1) END AS path FROM (SELECT p_partkey, {_PURL_SQL} AS p FROM part)")
def purl_split(spark, d):
    return lens.table(spark, d, "part").select("p_partkey", E.purl_type(_purl()).alias("type"), E.purl_path(_purl()).alias("path"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 6 IN (4, 5) THEN lpad(to_hex(('0x' || right(sha256(core), 4))::INTEGER % 1024), 3, '0') WHEN p_partkey % 6 IN (0, 2) THEN lpad(to_hex(('0x' || right(sha256(core), 4))::INTEGER % 128), 2, '0') ELSE lpad(to_hex(('0x' || right(sha256(core), 4))::INTEGER % 32), 2, '0') END AS bucket FROM (SELECT p_partkey, split_part({_PURL_SQL}, '@', 1) AS core FROM part)".replace("to_hex(", "lower(to_hex(").replace("), 3, '0')", ")), 3, '0')").replace("), 2, '0')", ")), 2, '0')"))
def purl_hash_bucket(spark, d):
    core = E.core_purl(_purl())
    return lens.table(spark, d, "part").select("p_partkey", E.purl_hash(core, E.bucket_bits(E.purl_type(_purl()))).alias("bucket"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS name FROM supplier")
def supplier_name(spark, d):
    raw = F.when(F.col("s_suppkey") % 4 == 0, "NOASSERTION").when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("Organization: "), F.col("s_name"))).when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit(" Person: "), F.col("s_name"), F.lit(" (a@example.com)"))).otherwise(F.col("s_name"))
    return lens.table(spark, d, "supplier").select("s_suppkey", E.supplier_name(raw).alias("name"))


def _severities():
    def one(system, score):
        return F.struct(F.lit(system).alias("system"), score.alias("score"), F.lit("V").alias("vector"))

    k = F.get_json_object("props", "$.k").cast("int")
    return F.array(one("generic_textual", F.lit("HIGH")), one("cvssv3.1", F.when(k % 3 == 0, "none").otherwise((k % 10).cast("string"))), one("cvssv2", F.lit("5.5")), one("epss", F.concat(F.lit("0."), k)))


@query(f"SELECT event_id, CASE WHEN {O.K} % 3 = 0 THEN '5.5' ELSE ({O.K} % 10)::VARCHAR END AS score, CASE WHEN {O.K} % 3 = 0 THEN '2' ELSE '3.1' END AS version FROM events")
def cvss_first(spark, d):
    found = E.first_cvss(_severities())
    return lens.table(spark, d, "events").select("event_id", found["score"].alias("score"), E.cvss_version(found["system"]).alias("version"))


@query(f"SELECT event_id, '0.' || {O.K} AS score FROM events")
def epss_first(spark, d):
    return lens.table(spark, d, "events").select("event_id", E.first_epss(_severities())["score"].alias("score"))


@query(f"SELECT DISTINCT {O.CVE} AS name FROM {O.EVENTS.format('view')}")
def vuln_names(spark, d):
    nodes = A.records(lens.vex(spark, d), "Vex", GUARD).nodes
    return C.vulnerability_nodes(nodes).select("name")


@query("SELECT DISTINCT 'pkg:generic/' || url_encode(lower(p_brand)) || '/' || url_encode(p_name) || '@' || p_partkey || '?size=' || p_size || '&type=' || url_encode(p_type) AS purl FROM part")
def pkg_purls(spark, d):
    return C.first_by_purl(A.records(lens.has_source_at(spark, d), "HasSourceAt", GUARD).nodes).select("purl")


@query(f"SELECT e.event_id, string_agg('vuln:cve/' || n.name, ',' ORDER BY a.place) AS ids FROM (SELECT event_id, {O.K} AS k FROM events WHERE event_type = 'purchase') e, (VALUES (0), (1), (2)) a(place), (SELECT DISTINCT {O.CVE} AS name FROM {O.EVENTS.format('view')}) n WHERE n.name = 'cve-2024-' || (e.k + 40 * a.place) GROUP BY e.event_id")
def alias_resolution(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = lens.table(spark, d, "events").where("event_type = 'purchase'").select("event_id", F.array(*[F.concat(F.lit(" CVE-2024-"), k + 40 * i) for i in range(3)]).alias("aliases"))
    known = C.vulnerability_nodes(A.records(lens.vex(spark, d), "Vex", GUARD).nodes)
    return C.resolve_aliases(rows, known, "event_id").select("event_id", F.array_join("ids", ",").alias("ids"))


@query(f"SELECT event_id, fact, value FROM (SELECT event_id, unnest(['advisory_id', 'cvss', 'reference', 'reference']) AS fact, unnest(['A-' || event_id, CASE WHEN {O.K} % 2 = 0 THEN {O.K}::VARCHAR ELSE '' END, 'https://a.example.com', 'https://b.example.com']) AS value FROM events WHERE event_type = 'click') WHERE value <> ''")
def advisory_facts(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    none = F.lit("")
    rows = lens.table(spark, d, "events").where("event_type = 'click'").select(
        F.col("event_id").cast("string").alias("subject"), F.array().cast("array<string>").alias("also"), F.lit("vulnerablecode").alias("source"), F.col("ts").alias("at"), F.concat(F.lit("A-"), F.col("event_id")).alias("advisory_id"), none.alias("summary"),
        F.when(k % 2 == 0, k.cast("string")).otherwise("").alias("cvss"), none.alias("cvss_version"), none.alias("cvss_vector"), none.alias("epss"), F.array(F.lit("https://a.example.com"), F.lit("https://b.example.com")).alias("references"), F.array().cast("array<string>").alias("fixed_by"),
    )
    return C.advisory_facts(rows, F.lit(lens.NOW)).select(F.col("subject").cast("bigint").alias("event_id"), "fact", "value")


@query("SELECT a.event_id, b.value FROM (SELECT * FROM events WHERE event_type = 'view') a ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'error' GROUP BY ALL) b ON a.user_id = b.user_id AND a.ts >= b.ts")
def replay_as_of(spark, d):
    events = lens.table(spark, d, "events")
    right = events.where("event_type = 'error'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return C.as_of(events.where("event_type = 'view'").select("event_id", "user_id", "ts"), right, "user_id", "ts", "value").select("event_id", "value")


def _history(spark, d):
    """Errors as commits of package files, views as commits of advisories, parts as subjects."""
    events = lens.table(spark, d, "events").withColumn("vcid", F.concat(F.lit("VCID-"), F.get_json_object("props", "$.k")))
    commits = events.where("event_type = 'error'").select(F.col("user_id").cast("string").alias("path"), F.col("event_id").alias("commit"), F.col("ts").alias("committed_at"), F.array("vcid").alias("affected_by"))
    none, empty = F.lit(""), F.array().cast("array<string>")
    facts = {"summary": F.lit("s"), "cvss": none, "cvss_version": none, "cvss_vector": none, "epss": none, "references": empty, "fixed_by": empty}
    views = events.where("event_type = 'view'").groupBy("vcid", "ts").agg(F.min("event_id").alias("commit"))
    advisories = views.select("vcid", "commit", F.col("ts").alias("committed_at"), F.array(F.regexp_replace("vcid", "VCID", "CVE-2024")).alias("aliases"), *[c.alias(n) for n, c in facts.items()])
    subjects = lens.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("path"), F.col("p_name").alias("purl"), F.col("p_partkey").cast("string").alias("subject"))
    return X.replayed(commits, advisories, subjects, C.vulnerability_nodes(A.records(lens.vex(spark, d), "Vex", GUARD).nodes), lens.NOW)


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND user_id IS NOT NULL)")
def replay_missing(spark, d):
    return _history(spark, d).missing.select(F.col("path").cast("bigint").alias("p_partkey"))


_LISTED = f"SELECT p_partkey, e.ts, {O.K} AS k FROM events e JOIN part ON p_partkey = user_id WHERE event_type = 'error'"
_VIEWS = f"SELECT DISTINCT {O.K} AS k, ts FROM events WHERE event_type = 'view'"


@query(f"""SELECT p_partkey::VARCHAR AS subject, 'affected' AS fact, 'VCID-' || l.k AS value, epoch_us(l.ts) AS valid_from_us, (CASE WHEN v.ts IS NULL THEN 0 ELSE 1 END)::BIGINT AS n_also, count(*) AS n
FROM ({_LISTED}) l ASOF LEFT JOIN ({_VIEWS}) v ON l.k = v.k AND l.ts >= v.ts GROUP BY ALL
UNION ALL SELECT 'vuln:cve/cve-2024-' || k, unnest(['advisory_id', 'description']), unnest(['VCID-' || k, 's']), epoch_us(ts), 0, 1 FROM ({_VIEWS}) WHERE k IN (SELECT k FROM ({_LISTED}))""")
def replay_claims(spark, d):
    """Claims of packages as of each commit, and of advisories by their own commits."""
    claims = _history(spark, d).claims
    return claims.groupBy("subject", "fact", "value", F.unix_micros("valid_from").alias("valid_from_us"), F.size("also").cast("long").alias("n_also")).agg(F.count("*").alias("n"))


def _part_nodes(spark, d, package=None):
    """Nodes of all parts' packages."""
    rows = lens.table(spark, d, "part").select("p_partkey", F.posexplode(F.array(*A.package_nodes(lens.part_package() if package is None else package))).alias("place", "n"))
    return rows.select("n.*", F.lit(lens.NOW).cast("timestamp").alias("valid_from"), (F.col("p_partkey") * 2 + F.col("place")).cast("bigint").alias("ord"))


@query("SELECT fact, value, ref, count(*) AS n FROM (SELECT unnest(CASE p_partkey % 3 WHEN 0 THEN ['supplier'] WHEN 1 THEN ['supplier', 'origin_country'] ELSE [] END) AS fact, unnest(CASE p_partkey % 3 WHEN 0 THEN ['Debian Project'] WHEN 1 THEN ['Red Hat, Inc.', 'US'] ELSE [] END) AS value, CASE p_partkey % 3 WHEN 0 THEN 'deb/debian/' ELSE 'rpm/redhat/' END AS ref FROM part) GROUP BY ALL")
def purl_supplier_claims(spark, d):
    at = F.col("p_partkey") % 3
    kind, space = F.when(at == 0, "deb").when(at == 1, "rpm").otherwise("npm"), F.when(at == 0, "debian").when(at == 1, "redhat").otherwise("x")
    package = lens.part_package().withField("type", kind).withField("namespace", space)
    return X.purl_suppliers(_part_nodes(spark, d, package), lens.NOW).groupBy("fact", "value", "ref").agg(F.count("*").alias("n"))


@query(f"SELECT {O.PART_V} AS subject, p_brand AS value, 'digest' AS ref FROM part WHERE p_partkey % 5 <> 0")
def sbom_supplier_claims(spark, d):
    """Each part stands twice in the document; the later supplier counts, and one that says nothing makes no claim."""
    purl = ids.package_purl(lens.part_package())
    last = F.when(F.col("p_partkey") % 5 == 0, "NOASSERTION").otherwise(F.concat(F.lit("Organization: "), F.col("p_brand")))
    both = F.array(F.struct(F.lit(0).alias("place"), F.lit("first").alias("supplier")), F.struct(F.lit(1).alias("place"), last.alias("supplier")))
    parts = lens.table(spark, d, "part").select(F.lit("digest").alias("digest"), purl.alias("purl"), F.inline(both))
    return X.sbom_suppliers(parts)(_part_nodes(spark, d), lens.NOW).select("subject", "value", "ref")


@query(f"SELECT {O.PART_V} AS subject, p_brand AS value, 'https://example.com/' || p_partkey AS ref FROM part WHERE p_partkey % 4 <> 0")
def ecosystems_owner_claims(spark, d):
    """The first of two records names the owner; an empty one makes no claim."""
    purl = ids.package_purl(lens.part_package())
    owner = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_brand"))
    both = F.array(*[F.struct(F.lit(i).alias("place"), o.alias("owner")) for i, o in enumerate((owner, F.lit("second")))])
    responses = lens.table(spark, d, "part").select(purl.alias("purl"), F.lit(200).alias("status"), F.concat(F.lit("https://example.com/"), F.col("p_partkey")).alias("repository_url"), F.inline(both))
    return X.owners(responses)(_part_nodes(spark, d), lens.NOW).claims.select("subject", "value", "ref")


_EUVD_FACTS = "['euvd_id', 'cvss', 'cvss_version', 'cvss_vector', 'epss', 'description', 'updated', 'reference', 'reference']"


@query(f"SELECT 'vuln:cve/cve-2024-' || k AS subject, ref, unnest({_EUVD_FACTS}) AS fact, unnest(['EUVD-' || event_id, k::VARCHAR, '3.1', '', '0.5', 'd', '2024-08-04T07:05:54Z', 'https://a.example.com', 'https://b.example.com']) AS value FROM (SELECT event_id, 'EUVD-' || event_id AS ref, {O.K} AS k FROM events WHERE event_type = 'purchase' AND {O.K} % 2 = 0)")
def european_facts(spark, d):
    """Items whose aliases name what was asked; those of odd numbers don't. Facts without a value stay."""
    k = F.get_json_object("props", "$.k").cast("int")
    bought = lens.table(spark, d, "events").where("event_type = 'purchase'")
    asked = F.concat(F.lit("cve-2024-"), k)
    items = bought.select(
        asked.alias("asked"), F.concat(F.lit("EUVD-"), F.col("event_id")).alias("id"), F.when(k % 2 == 0, F.concat(F.lit("GHSA-x\n CVE-2024-"), k)).otherwise("GHSA-x").alias("aliases"), k.cast("double").alias("base_score"), F.lit("3.1").alias("base_score_version"),
        F.lit("").alias("base_score_vector"), F.lit(0.5).alias("epss"), F.lit("d").alias("description"), F.lit("").alias("date_published"), F.lit("Aug 4, 2024, 7:05:54 AM").alias("date_updated"), F.lit("https://a.example.com\n\n https://b.example.com").alias("references"),
    )
    nodes = bought.select(F.explode(F.array(A.identity_nodes("vulnerability", lens.vulnerability(F.lit("cve"), asked))[0])).alias("n")).select("n.*").dropDuplicates(["id"])
    return X.european_facts(items)(nodes, lens.NOW).select("subject", "ref", "fact", "value")


@query("SELECT sum(o_orderkey)::BIGINT AS nodes, sum(o_custkey)::BIGINT AS edges, count(*) AS transactions, arg_max(o_orderpriority, o_orderkey) AS basis FROM orders")
def receipt_fold(spark, d):
    receipts = lens.table(spark, d, "orders").select(F.col("o_orderkey").alias("batch"), F.col("o_orderkey").alias("nodes"), F.col("o_custkey").alias("edges"), F.lit(1).alias("transactions"), F.col("o_orderpriority").alias("basis"))
    return X.receipts_folded(receipts).select(*[F.col(c).cast("bigint").alias(c) for c in ("nodes", "edges", "transactions")], "basis")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")
def budget_topk(spark, d):
    rows = lens.table(spark, d, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("low"))
    return C.budget(rows, 500, "low", "o_orderkey")[0].drop("low")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
