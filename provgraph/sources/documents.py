"""Documents: files to evidence tables. Formats are told by their own marks; what can't be read is set aside, never fatal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from provgraph import shared
from provgraph.functions import ids
from provgraph.functions.schemas import ARTIFACT, BUILDER, LICENSE, PACKAGE, PAIRS, SOURCE, VULNERABILITY
from provgraph.functions.text import text

_REF = "array<struct<referenceType:string,referenceLocator:string>>"
SPDX = f"struct<spdxVersion:string,name:string,documentNamespace:string,creationInfo:struct<created:string>,documentDescribes:array<string>,packages:array<struct<SPDXID:string,name:string,versionInfo:string,supplier:string,licenseDeclared:string,licenseConcluded:string,copyrightText:string,checksums:array<struct<algorithm:string,checksumValue:string>>,externalRefs:{_REF}>>,relationships:array<struct<spdxElementId:string,relationshipType:string,relatedSpdxElement:string>>>"
#: Nested components stay JSON texts, which are read level by level.
COMPONENT = "struct<`bom-ref`:string,purl:string,name:string,version:string,supplier:struct<name:string>,hashes:array<struct<alg:string,content:string>>,components:array<string>>"
CYCLONEDX = "struct<bomFormat:string,serialNumber:string,metadata:struct<timestamp:string,component:struct<`bom-ref`:string,purl:string,name:string,version:string>>,components:array<string>,dependencies:array<struct<ref:string,dependsOn:array<string>>>,vulnerabilities:array<struct<id:string,ratings:array<struct<score:double,method:string>>,analysis:struct<state:string,justification:string,detail:string>,affects:array<struct<ref:string>>>>>"
_SUBJECT = "array<struct<uri:string,name:string,digest:map<string,string>>>"
STATEMENT = f"struct<predicateType:string,subject:{_SUBJECT},predicate:struct<scanner:struct<uri:string,version:string,db:struct<uri:string,version:string>,result:array<struct<vulnerability_id:string,id:string>>>,metadata:struct<scannedOn:string,scanFinishedOn:string>>>"
PROVENANCE = f"struct<predicateType:string,subject:{_SUBJECT},predicate:struct<buildType:string,builder:struct<id:string>,metadata:struct<buildStartedOn:string,buildFinishedOn:string>,materials:{_SUBJECT},buildDefinition:struct<buildType:string,resolvedDependencies:{_SUBJECT}>,runDetails:struct<builder:struct<id:string>,metadata:struct<startedOn:string,finishedOn:string>>>>"
SCORECARD = "struct<date:string,repo:struct<name:string,commit:string>,scorecard:struct<version:string,commit:string>,score:double,checks:array<struct<name:string,score:int>>>"
OPENVEX = "struct<`@context`:string,timestamp:string,statements:array<struct<vulnerability:struct<name:string>,products:array<struct<`@id`:string>>,status:string,justification:string>>>"


def files(spark: SparkSession, *paths: str) -> DataFrame:
    """Every file under the paths, whatever its name: path, content, digest of the bytes, its time, and the receiver's rank (the place of its path here)."""
    parts = [
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).withColumn("receiver", F.lit(i))
        for i, p in enumerate(paths)
    ]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return digested(df.select("path", "content", "receiver", F.col("modificationTime").alias("arrived")))


#: Manifests are smaller by the format's own rule; larger blobs are image layers or documents.
MANIFEST_BYTES = 4 << 20
_DESCRIPTOR = "mediaType:string,artifactType:string,digest:string,annotations:map<string,string>"
MANIFEST = f"struct<artifactType:string,subject:struct<{_DESCRIPTOR}>,layers:array<struct<{_DESCRIPTOR}>>>"
#: Media types of documents; others are layers of images.
DOCUMENT_TYPES = "spdx|cyclonedx|in-toto|openvex|dsse"


def image_layout(spark: SparkSession, path: str, *refs: str, receiver: int = 0) -> DataFrame:
    """Documents attached to the images of an image layout folder, as `files` gives them.

    A document is a layer of a manifest whose subject is an image of the index;
    with `refs`, only images of those names count. Only blobs that can be a
    manifest are parsed, and only those that are named as documents are read in
    full.
    """
    index = spark.read.schema(f"manifests array<struct<{_DESCRIPTOR}>>").json(f"{path}/index.json", multiLine=True)
    images = index.select(F.explode("manifests").alias("m")).select(F.col("m.digest").alias("image"), F.col("m.annotations")["org.opencontainers.image.ref.name"].alias("ref"))
    images = images.where(F.col("ref").isin(*refs)) if refs else images
    named = F.split("path", "/")
    blobs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/blobs").withColumn("blob", F.concat(F.get(named, F.size(named) - 2), F.lit(":"), F.get(named, F.size(named) - 1)))
    manifests = blobs.where(F.col("length") <= MANIFEST_BYTES).select(F.from_json(_utf8("content"), MANIFEST).alias("m"))
    attached = manifests.join(images.select("image").distinct(), F.col("m.subject.digest") == F.col("image"), "left_semi")
    layers = attached.select(F.explode("m.layers").alias("l")).where(F.col("l.mediaType").rlike(DOCUMENT_TYPES)).select(F.col("l.digest").alias("blob"))
    found = blobs.join(layers, "blob", "left_semi")
    return digested(found.select("path", "content", F.lit(receiver).alias("receiver"), F.col("modificationTime").alias("arrived")))


def stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """The same as a stream; files that are there once are read once."""
    files_ = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    df = files_.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(path)
    return digested(df.select("path", "content", F.lit(0).alias("receiver"), F.col("modificationTime").alias("arrived")))


#: What documents arrive by: the receivers' fixed order, then time, then path.
ARRIVAL = ("receiver", "arrived", "path")


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with seq: the bytes of all documents that arrived before.

    A document has fewer places than bytes, so seq + place orders the records of
    all documents as they arrived, however many there are. Two passes: documents
    are sorted into ranges, bytes are added up within each range, and the ranges'
    totals (one number each, at the driver) give where a range begins. No task
    sees more than a range, and the ranges are written down, because another
    attempt could draw other bounds. Documents need receiver, arrived (null: first)
    and path, which is unique within a receiver.
    """
    spark = docs.sparkSession
    docs = docs if "arrived" in docs.columns else docs.withColumn("arrived", F.lit(None).cast("timestamp"))
    keys = docs.select(*ARRIVAL, F.octet_length("content").cast("long").alias("bytes"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionByRange(ranges, *ARRIVAL).withColumn("range", F.spark_partition_id())
    dealt, _ = shared.kept(dealt, "arrivals")
    before, begins = 0, []
    for r in sorted(dealt.groupBy("range").agg(F.sum("bytes").alias("bytes")).collect()):
        begins.append((r["range"], before))
        before += r["bytes"]
    if before >= 1 << 48:
        raise ValueError("a run takes up to 2^48 bytes of documents")
    offsets = spark.createDataFrame(begins, "range int, begins long")
    own = Window.partitionBy("range").orderBy(*ARRIVAL).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("within", F.coalesce(F.sum("bytes").over(own), F.lit(0)))
    # One row for each range.
    seq = within.join(F.broadcast(offsets), "range").select("receiver", "path", (F.col("begins") + F.col("within")).alias("seq"))
    return docs.join(seq, ["receiver", "path"])


def digested(df: DataFrame) -> DataFrame:
    return df.withColumn("digest", F.sha2("content", 256))


def _utf8(content: str) -> Column:
    """Bytes as text, null where they aren't UTF-8."""
    return F.try_validate_utf8(F.col(content).cast("string"))


def sniffed(docs: DataFrame) -> DataFrame:
    """`docs` with raw text and format: spdx, cyclonedx, in-toto, openvex, scorecard, or null with the reason.

    Signed envelopes are opened; their signatures aren't checked.
    """
    df = docs.withColumn("raw", _utf8("content"))
    payload = F.get_json_object("raw", "$.payload")
    opened = F.when(F.get_json_object("raw", "$.payloadType").isNotNull() & payload.isNotNull(), F.try_validate_utf8(F.try_to_binary(payload, F.lit("base64")).cast("string"))).otherwise(F.col("raw"))
    # A generator of one row keeps the text from being worked out again wherever it is named.
    df = df.withColumn("raw", F.explode(F.array(opened)))
    field = lambda k: F.get_json_object("raw", k)
    valid = F.try_parse_json("raw").isNotNull()
    form = (
        F.when(~valid, None)
        .when(field("$.bomFormat") == "CycloneDX", "cyclonedx")
        .when(text(field("$.spdxVersion")) != "", "spdx")
        .when(field("$.predicateType").isNotNull(), "in-toto")
        .when(text(field("$['@context']")).contains("openvex"), "openvex")
        .when(field("$.scorecard.version").isNotNull() & field("$.checks").isNotNull(), "scorecard")
    )
    df = df.withColumn("format", form)
    created = F.when(F.col("format") == "spdx", F.try_to_timestamp(field("$.creationInfo.created")).isNull())
    error = F.when(~valid, "not JSON").when(F.col("format").isNull(), "unknown format").when(F.coalesce(created, F.lit(False)), "bad creation time")
    return df.withColumn("error", error)


def failed(docs: DataFrame) -> DataFrame:
    return docs.where("error IS NOT NULL").select("path", "digest", "error")


def parsed_purl(purl: Column) -> Column:
    """A package of a package URL."""
    parts = r"^pkg:([^/]+)/(?:([^@?#]+)/)?([^/@?#]+)(?:@([^?#]*))?(?:\?([^#]*))?(?:#(.*))?$"
    at = lambda i: F.coalesce(F.try_url_decode(F.regexp_extract(purl, parts, i)), F.lit(""))
    raw = F.regexp_extract(purl, parts, 5)
    quals = F.transform(F.filter(F.split(raw, "&"), lambda q: q != ""), lambda q: F.struct(F.split(q, "=", 2)[0], F.coalesce(F.try_url_decode(F.get(F.split(q, "=", 2), F.lit(1))), F.lit(""))))
    return F.when(purl.rlike(parts), F.struct(at(1), at(2), at(3), at(4), quals, at(6)).cast(PACKAGE))


def _named_package(name: Column, version: Column) -> Column:
    """A package that has a name only."""
    return F.struct(F.lit("guac"), F.lit("pkg"), name, text(version), F.array().cast("array<struct<key:string,value:string>>"), F.lit("")).cast(PACKAGE)


def _signed(df: DataFrame, collector: str = "FileCollector", **columns: Column) -> DataFrame:
    """Rows with where they come from; records are ordered by their documents' arrival and the place in them."""
    item = F.col("seq") + F.col("pos")
    base = {"doc": F.col("path"), "origin": F.concat(F.lit("file:///"), F.col("path")), "collector": F.lit(collector), "documentRef": F.concat(F.lit("sha256_"), F.col("digest")), "item": item}
    return df.select(*[c.alias(n) for n, c in (base | columns).items()])


WHERE = ("path", "digest", "seq")


def _where(docs: DataFrame) -> list[str]:
    """Columns that tell a document; its number only where documents are numbered."""
    return [c for c in WHERE if c in docs.columns]


def _of(docs: DataFrame, form: str, schema: str) -> DataFrame:
    return docs.where((F.col("format") == form) & F.col("error").isNull()).select(*_where(docs), F.from_json("raw", schema).alias("d"))


def _list(column: Column | str, kind: str) -> Column:
    return F.coalesce(column, F.array().cast(kind))


def spdx_packages(docs: DataFrame) -> DataFrame:
    """One row for each package of the SPDX documents, in place: created, spdx_id, pkg, supplier, licences, checksums, purl (the last counts), and whether the document describes it."""
    d = _of(docs, "spdx", SPDX)
    each = d.select(*_where(docs), F.col("d.documentNamespace").alias("uri"), F.try_to_timestamp("d.creationInfo.created").alias("created"), _list("d.documentDescribes", "array<string>").alias("described"), F.posexplode("d.packages").alias("pos", "p"))
    purls = F.transform(F.filter(_list("p.externalRefs", _REF), lambda r: r["referenceType"] == "purl"), lambda r: r["referenceLocator"])
    last = F.get(purls, F.size(purls) - 1)
    pkg = F.coalesce(parsed_purl(last), _named_package(F.col("p.name"), F.col("p.versionInfo")))
    hashes = F.transform(_list("p.checksums", "array<struct<algorithm:string,checksumValue:string>>"), lambda c: F.struct(c["algorithm"], c["checksumValue"]).cast(ARTIFACT))
    return each.select(*_where(docs), "pos", "uri", "created", F.col("p.SPDXID").alias("spdx_id"), pkg.alias("pkg"), F.col("p.supplier").alias("supplier"), F.col("p.licenseDeclared").alias("declared"), F.col("p.licenseConcluded").alias("concluded"), F.col("p.copyrightText").alias("copyright"), hashes.alias("hashes"), last.alias("purl"), F.array_contains("described", F.col("p.SPDXID")).alias("described"))


def components(docs: DataFrame) -> DataFrame:
    """CycloneDX components at any depth: where, at, pos, depth, ref, purl, name, version, supplier, hashes, pkg.

    Levels are read until one is empty, each with a job of its own. `place` (the
    positions on the way down) puts a document's components in pre-order; `pos`
    numbers them in that order.
    """
    level = _of(docs, "cyclonedx", CYCLONEDX).select(*_where(docs), F.try_to_timestamp("d.metadata.timestamp").alias("at"), F.array().cast("array<int>").alias("place"), F.posexplode("d.components").alias("pos", "c"))
    out, depth = None, 0
    while out is None or not level.isEmpty():
        level = level.withColumns({"c": F.from_json("c", COMPONENT), "place": F.concat("place", F.array("pos"))})
        hashes = F.transform(_list("c.hashes", "array<struct<alg:string,content:string>>"), lambda c: F.struct(F.replace(c["alg"], F.lit("-"), F.lit("")), c["content"]).cast(ARTIFACT))
        rows = level.select(*_where(docs), "at", "place", F.lit(depth).alias("depth"), F.col("c.bom-ref").alias("ref"), "c.purl", "c.name", "c.version", F.col("c.supplier.name").alias("supplier"), hashes.alias("hashes"))
        out = rows if out is None else out.unionByName(rows)
        level = level.select(*_where(docs), "at", "place", F.posexplode("c.components").alias("pos", "c"))
        depth += 1
    # A window for each document, whose components a task holds anyway.
    out = out.withColumn("pos", F.row_number().over(Window.partitionBy("path").orderBy("place")) - 1)
    return out.withColumn("pkg", F.coalesce(parsed_purl(F.col("purl")), _named_package(F.col("name"), F.col("version"))))


def supplied_parts(docs: DataFrame) -> DataFrame:
    """(digest, place, purl, supplier) of the parts that documents name, what an SPDX document describes itself left out; places are in pre-order."""
    spdx = spdx_packages(docs).where("NOT described").select("digest", F.array("pos").alias("place"), "purl", "supplier")
    return spdx.unionByName(components(docs).select("digest", "place", "purl", "supplier"))


def document_purls(docs: DataFrame) -> DataFrame:
    """(path, purl, place) of the package URLs of each document, each once, at its first place."""
    rows = spdx_packages(docs).select("path", "purl", F.array("pos").alias("place")).unionByName(components(docs).select("path", "purl", "place"))
    return rows.where("purl <> ''").groupBy("path", "purl").agg(F.min("place").alias("place"))


def _sboms(docs: DataFrame, packages: DataFrame, parts: DataFrame) -> DataFrame:
    """One statement for each package that a document describes, or one about the file itself, with the ids of all software in it."""
    file_ = F.struct(F.lit("sha256"), F.col("digest")).cast(ARTIFACT)
    in_spdx = packages.groupBy("path").agg(F.sort_array(F.collect_list(F.struct(F.array("pos").alias("place"), ids.package_version_id(F.col("pkg")).alias("id")))).alias("all"))
    tops = packages.where("described").select("path", "pos", F.col("pkg").alias("top"))
    in_cyclonedx = parts.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("place", ids.package_version_id(F.col("pkg")).alias("id")))).alias("all"))
    spdx = _of(docs, "spdx", SPDX).join(in_spdx, "path", "left").join(tops, "path", "left").select(*WHERE, F.coalesce("pos", F.lit(0)).alias("pos"), F.col("d.documentNamespace").alias("uri"), F.try_to_timestamp("d.creationInfo.created").alias("at"), "top", "all")
    root = F.col("d.metadata.component")
    top = F.coalesce(parsed_purl(root["purl"]), F.when(root["name"].isNotNull(), _named_package(root["name"], root["version"])))
    cyclonedx = _of(docs, "cyclonedx", CYCLONEDX).join(in_cyclonedx, "path", "left").select(*WHERE, F.lit(0).alias("pos"), F.col("d.serialNumber").alias("uri"), F.try_to_timestamp("d.metadata.timestamp").alias("at"), top.alias("top"), "all")
    both = spdx.unionByName(cyclonedx)
    software = F.transform(F.col("all"), lambda x: x["id"])
    return _signed(both, pkg=F.col("top"), artifact=F.when(F.col("top").isNull(), file_), uri=text(F.col("uri")), algorithm=F.lit("sha256"), digest=F.col("digest"), downloadLocation=F.col("path"), knownSince=F.col("at"), includedSoftware=F.coalesce(software, F.array().cast("array<string>")))


def _dependencies(docs: DataFrame, packages: DataFrame, parts: DataFrame) -> DataFrame:
    """What SPDX relationships and CycloneDX dependencies state."""
    related = _of(docs, "spdx", SPDX).select(*WHERE, F.posexplode("d.relationships").alias("pos", "r")).where("r.relationshipType IN ('DEPENDS_ON', 'CONTAINS')").select(*WHERE, "pos", F.col("r.spdxElementId").alias("ref"), F.col("r.relatedSpdxElement").alias("other"))
    named = _of(docs, "cyclonedx", CYCLONEDX).select(*WHERE, F.posexplode("d.dependencies").alias("pos", "x")).select(*WHERE, "pos", F.col("x.ref").alias("ref"), F.explode("x.dependsOn").alias("other"))
    root = _of(docs, "cyclonedx", CYCLONEDX).select("path", F.col("d.metadata.component").alias("c")).where("c.`bom-ref` IS NOT NULL")
    root = root.select("path", F.col("c.bom-ref").alias("ref"), F.coalesce(parsed_purl(F.col("c.purl")), _named_package(F.col("c.name"), F.col("c.version"))).alias("pkg"))
    ends = packages.select("path", F.col("spdx_id").alias("ref"), "pkg").unionByName(parts.select("path", "ref", "pkg")).unionByName(root)
    depends = related.unionByName(named).join(ends, ["path", "ref"]).join(ends.select("path", F.col("ref").alias("other"), F.col("pkg").alias("dep_pkg")), ["path", "other"])
    return _signed(depends, pkg=F.col("pkg"), dep_pkg=F.col("dep_pkg"), dependencyType=F.lit("DIRECT"), justification=F.lit("stated by the document"))


def _occurrences(packages: DataFrame, parts: DataFrame) -> DataFrame:
    each = packages.select(*WHERE, "pos", "pkg", F.explode("hashes").alias("artifact")).unionByName(parts.select(*WHERE, "pos", "pkg", F.explode("hashes").alias("artifact")))
    return _signed(each, pkg=F.col("pkg"), artifact=F.col("artifact"), justification=F.lit("checksum in the document"))


def _licences(packages: DataFrame) -> DataFrame:
    """Licence expressions, and the licences they name."""
    said = lambda c: F.when(F.coalesce(F.col(c), F.lit("")).isin("", "NOASSERTION", "NONE"), "").otherwise(F.col(c))
    named = lambda c: F.transform(F.array_distinct(F.filter(F.split(F.regexp_replace(said(c), "[()]", " "), r"\s+(?:AND|OR|WITH)\s+|\s+"), lambda x: x != "")), lambda x: F.struct(x, F.lit(""), F.lit("")).cast(LICENSE))
    rows = packages.where((said("declared") != "") | (said("concluded") != ""))
    return _signed(rows, pkg=F.col("pkg"), declaredLicense=said("declared"), discoveredLicense=said("concluded"), attribution=text(F.col("copyright")), justification=F.lit("stated by the document"), timeScanned=F.col("created"), declared=named("declared"), discovered=named("concluded"))


def _artifacts(subjects: Column) -> Column:
    """Artifacts of the digests of subjects or materials."""
    each = F.transform(_list(subjects, _SUBJECT), lambda s: F.transform(F.map_entries(F.coalesce(s["digest"], F.create_map().cast("map<string,string>"))), lambda x: F.struct(x["key"], x["value"]).cast(ARTIFACT)))
    return F.flatten(each)


def _builds(docs: DataFrame) -> DataFrame:
    """Build provenance of both generations: one statement for each digest of each subject."""
    d = _of(docs, "in-toto", PROVENANCE).where("d.predicateType LIKE '%slsa%provenance%'")
    p = F.col("d.predicate")
    rows = d.select(*WHERE, "d", F.posexplode(_artifacts(F.col("d.subject"))).alias("pos", "artifact"))
    first = lambda a, b: F.coalesce(a, b)
    return _signed(
        rows, artifact=F.col("artifact"), builder=F.struct(first(p["builder"]["id"], p["runDetails"]["builder"]["id"])).cast(BUILDER), materials=_artifacts(first(p["materials"], p["buildDefinition"]["resolvedDependencies"])),
        buildType=first(p["buildType"], p["buildDefinition"]["buildType"]), slsaVersion=F.col("d.predicateType"), startedOn=F.try_to_timestamp(first(p["metadata"]["buildStartedOn"], p["runDetails"]["metadata"]["startedOn"])),
        finishedOn=F.try_to_timestamp(first(p["metadata"]["buildFinishedOn"], p["runDetails"]["metadata"]["finishedOn"])), predicates=F.array().cast(PAIRS),
    )


def _scorecards(docs: DataFrame) -> DataFrame:
    d = _of(docs, "scorecard", SCORECARD).withColumn("pos", F.lit(0))
    host = F.regexp_extract("d.repo.name", "^(.*)/[^/]*$", 1)
    source = F.struct(F.lit("git"), host, F.regexp_extract("d.repo.name", "([^/]*)$", 1), F.lit(""), text(F.col("d.repo.commit"))).cast(SOURCE)
    checks = F.transform("d.checks", lambda c: F.struct(c["name"], c["score"].cast("string")).cast("struct<key:string,value:string>"))
    return _signed(d, src=source, aggregateScore=F.col("d.score"), timeScanned=F.try_to_timestamp("d.date"), scorecardVersion=F.col("d.scorecard.version"), scorecardCommit=F.col("d.scorecard.commit"), checks=checks)


def _vulnerability(name: Column) -> Column:
    return F.struct(F.when(F.lower(name).startswith("cve-"), "cve").otherwise("osv"), name).cast(VULNERABILITY)


def _findings(docs: DataFrame) -> DataFrame:
    scans = _of(docs, "in-toto", STATEMENT).where("d.predicateType LIKE '%vulns%'")
    subjects = scans.select(*WHERE, "d", F.posexplode("d.subject").alias("pos", "s")).withColumn("pkg", parsed_purl(F.coalesce("s.uri", "s.name"))).where("pkg IS NOT NULL")
    results = F.transform(_list("d.predicate.scanner.result", "array<struct<vulnerability_id:string,id:string>>"), lambda r: F.struct(F.lit("osv"), F.coalesce(r["vulnerability_id"], r["id"])).cast(VULNERABILITY))
    none = F.array(F.struct(F.lit("noVuln"), F.lit("")).cast(VULNERABILITY))
    named = subjects.withColumn("v", F.explode(F.when(F.size(results) > 0, results).otherwise(none)))
    at = F.try_to_timestamp(F.coalesce("d.predicate.metadata.scanFinishedOn", "d.predicate.metadata.scannedOn"))
    return _signed(named, pkg=F.col("pkg"), vulnerability=F.col("v"), timeScanned=at, dbUri=F.col("d.predicate.scanner.db.uri"), dbVersion=F.col("d.predicate.scanner.db.version"), scannerUri=F.col("d.predicate.scanner.uri"), scannerVersion=F.col("d.predicate.scanner.version"))


#: States of a CycloneDX analysis as statuses.
STATES = {"resolved": "FIXED", "resolved_with_pedigree": "FIXED", "exploitable": "AFFECTED", "in_triage": "UNDER_INVESTIGATION", "false_positive": "NOT_AFFECTED", "not_affected": "NOT_AFFECTED"}


def _statements(docs: DataFrame, named: DataFrame) -> DataFrame:
    """Exploitability statements of OpenVEX documents and of CycloneDX analyses."""
    vex = _of(docs, "openvex", OPENVEX).select(*WHERE, F.try_to_timestamp("d.timestamp").alias("at"), F.posexplode("d.statements").alias("pos", "s"))
    stated = vex.select(*WHERE, "pos", "at", "s", F.explode("s.products").alias("p")).withColumn("pkg", parsed_purl(F.col("p.@id"))).where("pkg IS NOT NULL")
    first = stated.select(*WHERE, "pos", "at", "pkg", F.col("s.vulnerability.name").alias("name"), F.upper("s.status").alias("status"), F.upper(text(F.col("s.justification"))).alias("why"), F.lit("").alias("detail"))
    status = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])[F.col("v.analysis.state")]
    second = named.where("v.analysis.state IS NOT NULL").select(*WHERE, "pos", "at", "pkg", F.col("v.id").alias("name"), status.alias("status"), F.upper(text(F.col("v.analysis.justification"))).alias("why"), text(F.col("v.analysis.detail")).alias("detail"))
    return _signed(first.unionByName(second), pkg=F.col("pkg"), vulnerability=_vulnerability(F.col("name")), status=F.col("status"), vexJustification=F.col("why"), statement=F.col("detail"), statusNotes=F.lit(""), knownSince=F.col("at"))


def _ratings(docs: DataFrame) -> DataFrame:
    v = _of(docs, "cyclonedx", CYCLONEDX).select(*WHERE, F.try_to_timestamp("d.metadata.timestamp").alias("at"), F.posexplode("d.vulnerabilities").alias("pos", "v"))
    each = v.select(*WHERE, "pos", "at", "v", F.explode("v.ratings").alias("r")).where("r.score IS NOT NULL")
    return _signed(each, vulnerability=_vulnerability(F.col("v.id")), scoreType=text(F.col("r.method")), scoreValue=F.col("r.score"), timestamp=F.col("at"))


#: Formats that each kind of evidence is read from.
FORMATS = {
    "HasSBOM": ("spdx", "cyclonedx"),
    "IsDependency": ("spdx", "cyclonedx"),
    "IsOccurrence": ("spdx", "cyclonedx"),
    "CertifyLegal": ("spdx",),
    "CertifyVuln": ("in-toto",),
    "CertifyScorecard": ("scorecard",),
    "HasSlsa": ("in-toto",),
    "Vex": ("openvex", "cyclonedx"),
    "VulnMetadata": ("cyclonedx",),
}


def evidence_tables(docs: DataFrame, formats: set[str] | None = None) -> dict[str, DataFrame]:
    """Evidence tables of sniffed documents, which are numbered by arrival first where they aren't yet.

    With `formats`, those that the documents have, tables that none of them can
    fill are left out, and so is what reads other formats.
    """
    docs = docs if "seq" in docs.columns else numbered(docs)
    wanted = set().union(*FORMATS.values()) if formats is None else formats
    tables = _evidence(docs, lambda form: docs if form in wanted else docs.where(F.lit(False)))
    return {kind: rows for kind, rows in tables.items() if wanted & set(FORMATS[kind])}


def _evidence(docs: DataFrame, of: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    packages, parts = spdx_packages(of("spdx")), components(of("cyclonedx"))
    affected = _of(docs, "cyclonedx", CYCLONEDX).select(*WHERE, F.try_to_timestamp("d.metadata.timestamp").alias("at"), F.posexplode("d.vulnerabilities").alias("pos", "v")).select(*WHERE, "at", "pos", "v", F.explode("v.affects.ref").alias("ref"))
    affected = affected.join(parts.select("path", "ref", "pkg"), ["path", "ref"])
    return {
        "HasSBOM": _sboms(docs, packages, parts),
        "IsDependency": _dependencies(docs, packages, parts),
        "IsOccurrence": _occurrences(packages, parts),
        "CertifyLegal": _licences(packages),
        "CertifyVuln": _findings(docs),
        "CertifyScorecard": _scorecards(docs),
        "HasSlsa": _builds(docs),
        "Vex": _statements(docs, affected),
        "VulnMetadata": _ratings(docs),
    }


def scanned(tables: dict[str, DataFrame], scans: dict[str, DataFrame], purls: DataFrame, allowed: dict[str, bool]) -> dict[str, DataFrame]:
    """Evidence tables with what allowed scanners found about the documents' package URLs.

    scans: source -> tables by kind, each with the purl it is about; their rows
    join the document that names it.
    """
    out = dict(tables)
    for source in (s for s in scans if allowed.get(s)):
        for kind, rows in scans[source].items():
            found = rows.join(purls.select(F.col("path").alias("doc"), "purl"), "purl").drop("purl")
            out[kind] = out[kind].unionByName(found, allowMissingColumns=True) if kind in out else found
    return out
