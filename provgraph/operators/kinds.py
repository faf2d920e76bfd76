"""The seventeen kinds of evidence, as data: what a node's id hashes, which properties it has, which edges it gets.

`ocd` stands for origin, collector and documentRef. Names of parts and
properties are columns of the evidence table or values that assembly derives
(subject, object, members, time and the packed lists). The orders are fixed
values: ids depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Kind:
    name: str
    phase: int
    endpoints: tuple[str, ...]
    subject: tuple[str, ...]
    object: str | None
    time: str | None
    parts: str
    props: str
    edges: tuple[tuple[str, str, str], ...]
    optional_time: bool = False
    members: tuple[str, str] | None = None


def _two(name: str, object_label: str) -> tuple:
    return ((f"{name}Subject", "subject", "self"), (object_label, "self", "object"))


KINDS = {
    k.name: k
    for k in (
        Kind("IsDependency", 1, ("pkg", "dep_pkg"), ("pkg",), "dep_pkg", None, "subject object dependencyType justification ocd", "subjectId objectId dependencyType justification ocd", _two("IsDependency", "IsDependencyObject")),
        Kind("CertifyVuln", 2, ("pkg", "vulnerability"), ("pkg",), "vulnerability", "timeScanned", "subject object timeScanned dbUri dbVersion scannerUri scannerVersion ocd", "subjectId objectId timeScanned dbUri dbVersion scannerUri scannerVersion ocd", _two("CertifyVuln", "CertifyVulnVulnerability")),
        Kind("HasSourceAt", 3, ("pkg", "src"), ("pkg",), "src", "knownSince", "subject object knownSince justification ocd", "subjectId objectId knownSince justification ocd", _two("HasSourceAt", "HasSourceAtSource")),
        Kind("IsOccurrence", 4, ("pkg", "src", "artifact"), ("pkg", "src"), "artifact", None, "subject object justification ocd", "subjectId objectId justification ocd", _two("IsOccurrence", "IsOccurrenceArtifact")),
        Kind("HasSBOM", 5, ("pkg", "artifact"), ("pkg", "artifact"), None, "knownSince", "subject uri algorithm digest downloadLocation knownSince ocd", "subjectId uri algorithm digest downloadLocation knownSince ocd includedSoftware includedDependencies includedOccurrences", (("HasSbomSubject", "subject", "self"),)),
        Kind("Vex", 6, ("pkg", "artifact", "vulnerability"), ("pkg", "artifact"), "vulnerability", "knownSince", "subject object status vexJustification statement statusNotes knownSince ocd", "subjectId objectId status vexJustification statement statusNotes knownSince ocd", _two("Vex", "VexVulnerability")),
        Kind("CertifyBad", 7, ("pkg", "src", "artifact"), ("pkg", "src", "artifact"), None, "knownSince", "subject knownSince justification ocd", "subjectId justification knownSince ocd", (("CertifyBadSubject", "subject", "self"),)),
        Kind("CertifyGood", 8, ("pkg", "src", "artifact"), ("pkg", "src", "artifact"), None, "knownSince", "subject knownSince justification ocd", "subjectId justification knownSince ocd", (("CertifyGoodSubject", "subject", "self"),)),
        Kind("HasMetadata", 9, ("pkg", "src", "artifact"), ("pkg", "src", "artifact"), None, "timestamp", "subject key value timestamp justification ocd", "subjectId key value timestamp justification ocd", (("HasMetadataSubject", "subject", "self"),)),
        Kind("PointOfContact", 10, ("pkg", "src", "artifact"), ("pkg", "src", "artifact"), None, "since", "subject email info since justification ocd", "subjectId email info since justification ocd", (("PointOfContactSubject", "subject", "self"),)),
        Kind("HashEqual", 11, ("artifact", "equal_artifact"), (), None, None, "members justification ocd", "members justification ocd", (("HashEqualArtifact", "self", "member"),), members=("artifact", "equal_artifact")),
        Kind("PkgEqual", 12, ("pkg", "equal_pkg"), (), None, None, "members justification ocd", "members justification ocd", (("PkgEqualPackage", "self", "member"),), members=("pkg", "equal_pkg")),
        Kind("VulnEqual", 13, ("vulnerability", "equal_vulnerability"), (), None, None, "members justification ocd", "members justification ocd", (("VulnEqualVulnerability", "self", "member"),), members=("vulnerability", "equal_vulnerability")),
        Kind("VulnMetadata", 14, ("vulnerability",), (), "vulnerability", "timestamp", "object scoreType scoreValue timestamp ocd", "objectId scoreType scoreValue timestamp ocd", (("VulnMetadataVulnerability", "self", "object"),)),
        Kind("HasSlsa", 15, ("artifact", "builder", "materials"), ("artifact",), None, "finishedOn", "subject builtById builtFrom buildType slsaVersion startedOn finishedOn ocd predicates", "subjectId builtById builtFrom buildType slsaVersion startedOn finishedOn ocd predicates", (("HasSlsaSubject", "subject", "self"), ("HasSlsaBuiltBy", "self", "builtById"), ("HasSlsaMaterial", "self", "materials")), optional_time=True),
        Kind("CertifyScorecard", 16, ("src",), ("src",), None, "timeScanned", "subject scorecardVersion scorecardCommit timeScanned aggregateScore ocd checks", "subjectId aggregateScore timeScanned scorecardVersion scorecardCommit ocd checks", (("CertifyScorecardSubject", "subject", "self"),)),
        Kind("CertifyLegal", 17, ("pkg", "src", "declared", "discovered"), ("pkg", "src"), None, "timeScanned", "subject declaredLicense discoveredLicense attribution justification timeScanned ocd declaredLicenses discoveredLicenses", "subjectId declaredLicense discoveredLicense attribution justification timeScanned ocd declaredLicenses discoveredLicenses", (("CertifyLegalSubject", "subject", "self"), ("CertifyLegalDeclaredLicense", "self", "declared"), ("CertifyLegalDiscoveredLicense", "self", "discovered"))),
    )
}

#: Types of columns that only some kinds have; what isn't named here is text.
TYPES = {"timeScanned": "timestamp", "knownSince": "timestamp", "timestamp": "timestamp", "since": "timestamp", "startedOn": "timestamp", "finishedOn": "timestamp", "scoreValue": "double", "aggregateScore": "double", "predicates": "array<struct<key:string,value:string>>", "checks": "array<struct<key:string,value:string>>", "includedSoftware": "array<string>", "includedDependencies": "array<string>", "includedOccurrences": "array<string>"}
DERIVED = {"subject", "object", "members", "subjectId", "objectId", "builtById", "builtFrom", "declaredLicenses", "discoveredLicenses", "ocd"}
