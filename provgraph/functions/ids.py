"""Ids of nodes and edges, derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provgraph.functions.text import canon_qualifiers, escape_edge, escape_identity, hash_parts, sorted_pairs, text

NO_VULNERABILITY = "vuln:novuln"


def package_name_id(p: Column | dict[str, Column]) -> Column:
    return F.concat(F.lit("pkg:n:"), escape_identity(p["type"]), F.lit("/"), escape_identity(p["namespace"]), F.lit("/"), escape_identity(p["name"]))


def package_version_id(p: Column | dict[str, Column], canonical: bool = False) -> Column:
    """`canonical`: the qualifiers are already the text that the id reads."""
    qualifiers = p["qualifiers"] if canonical else canon_qualifiers(p["qualifiers"])
    tail = [F.lit("+"), escape_identity(qualifiers), F.lit("+"), escape_identity(p["subpath"])]
    return F.concat(F.lit("pkg:v:"), escape_identity(p["type"]), F.lit("/"), escape_identity(p["namespace"]), F.lit("/"), escape_identity(p["name"]), F.lit("/"), escape_identity(p["version"]), *tail)


def source_id(s: Column) -> Column:
    return F.concat(F.lit("src:n:"), text(s["type"]), F.lit("/"), text(s["namespace"]), F.lit("/"), text(s["name"]), F.lit("@"), text(s["tag"]), F.lit("@"), text(s["commit"]))


def artifact_id(a: Column) -> Column:
    return F.concat(F.lit("art:"), F.lower(text(a["algorithm"])), F.lit(":"), F.lower(text(a["digest"])))


def builder_id(b: Column) -> Column:
    return F.concat(F.lit("bld:"), text(b["uri"]))


def is_no_vulnerability(v: Column) -> Column:
    return F.lower(text(v["type"])) == "novuln"


def vulnerability_id(v: Column) -> Column:
    return F.when(is_no_vulnerability(v), NO_VULNERABILITY).otherwise(F.concat(F.lit("vuln:"), F.lower(text(v["type"])), F.lit("/"), F.lower(text(v["vulnerabilityID"]))))


def license_id(x: Column) -> Column:
    return F.concat(F.lit("lic:"), F.when(text(x["inline"]) != "", hash_parts(F.lit("inline"), x["inline"])).otherwise(text(x["name"])))


def evidence_id(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), hash_parts(*parts))


def packed(id_: Column) -> Column:
    """An id as bytes, with a hash at its end in half the room; `unpacked` gives the same text again."""
    head = F.substring(id_, F.lit(1), F.length(id_) - 64)
    return F.when(id_.rlike("[0-9a-f]{64}$"), F.concat(F.lit(b"\x01"), head.cast("binary"), F.unhex(F.right(id_, F.lit(64))))).otherwise(F.concat(F.lit(b"\x00"), id_.cast("binary")))


def unpacked(bytes_: Column) -> Column:
    length = F.octet_length(bytes_)
    text_ = lambda begin, size: F.substring(bytes_, begin, size)
    hashed = F.concat(text_(F.lit(2), length - 33).cast("string"), F.lower(F.hex(text_(length - 31, F.lit(32)))))
    return F.when(text_(F.lit(1), F.lit(1)) == F.lit(b"\x01"), hashed).otherwise(text_(F.lit(2), length - 1).cast("string"))


def edge_id(src: Column, label: Column, dst: Column) -> Column:
    return F.concat_ws("|", escape_edge(src), escape_edge(label), escape_edge(dst))


def _purl_escape(value: Column) -> Column:
    """Percent-encoding of a purl component; `:` and `/` within qualifiers' values stay as they are read."""
    return F.replace(F.replace(F.url_encode(text(value)), F.lit("+"), F.lit("%20")), F.lit("%3A"), F.lit(":"))


def package_purl(p: Column) -> Column:
    """Package URL: type/namespace/name@version?qualifiers#subpath, empty parts left out."""

    def path(value: Column) -> Column:
        return F.replace(_purl_escape(value), F.lit("%2F"), F.lit("/"))

    kept = F.filter(sorted_pairs(p["qualifiers"]), lambda q: q["value"] != "")
    quals = F.array_join(F.transform(kept, lambda q: F.concat(F.lower(q["key"]), F.lit("="), F.replace(_purl_escape(q["value"]), F.lit("%2F"), F.lit("/")))), "&")

    def lead(mark: str, value: Column, shown: Column) -> Column:
        return F.when(value == "", "").otherwise(F.concat(F.lit(mark), shown))

    ns = text(p["namespace"])
    return F.concat(
        F.lit("pkg:"), F.lower(text(p["type"])), F.lit("/"), F.when(ns == "", "").otherwise(F.concat(path(ns), F.lit("/"))), _purl_escape(p["name"]),
        lead("@", text(p["version"]), _purl_escape(p["version"])), lead("?", quals, quals), lead("#", text(p["subpath"]), path(p["subpath"])),
    )
