"""Scalar functions of enrichment: severities, suppliers, package URLs, buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from provgraph.functions.text import float_text, text

#: Fixed rules (type, prefix of namespace/name, supplier, country).
SUPPLIER_RULES = (
    ("golang", "golang.org/x/", "Google LLC", "US"),
    ("golang", "github.com/golang/", "Google LLC", "US"),
    ("maven", "org.apache.", "The Apache Software Foundation", "US"),
    ("maven", "org.eclipse.", "Eclipse Foundation AISBL", "BE"),
    ("npm", "@angular/", "Google LLC", "US"),
    ("deb", "debian/", "Debian Project", ""),
    ("deb", "ubuntu/", "Canonical Ltd", "GB"),
    ("rpm", "opensuse/", "openSUSE Project", "DE"),
    ("rpm", "fedora/", "Fedora Project", "US"),
    ("rpm", "redhat/", "Red Hat, Inc.", "US"),
)
#: Bits of the hash that names a package's bucket, by ecosystem; 0 for all others.
BUCKET_BITS = {
    "alpm": 5,
    "bitbucket": 5,
    "cocoapods": 5,
    "composer": 5,
    "deb": 5,
    "docker": 5,
    "gem": 5,
    "generic": 5,
    "github": 10,
    "golang": 7,
    "huggingface": 5,
    "maven": 7,
    "mlflow": 5,
    "npm": 10,
    "nuget": 7,
    "perl": 7,
    "php": 7,
    "pub": 5,
    "pypi": 7,
    "rpm": 5,
    "ruby": 7,
}


def prop_text(props: Column, key: str, numbers: bool = False) -> Column:
    """First property with that key as text; null where there is none. Numbers are rendered only where they are asked for."""
    v = F.get(F.filter(props, lambda p: p["key"] == key), F.lit(0))["value"]
    return F.when(v["kind"] == "s", v["s"]).when(v["kind"] == "f", float_text(v["f"], "f")).when(v["kind"] == "i", v["i"].cast("string")) if numbers else v["s"]


#: How a number is written (decimal, hexadecimal with its exponent, or a name); nothing may stand around it.
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
HEXADECIMAL = r"^[+-]?0[xX](_?[0-9a-fA-F]+)*(\.[0-9a-fA-F]*)?(?<=[0-9a-fA-F.])(?<![xX]\.)[pP][+-]?[0-9]+$"
NAMED_NUMBER = r"^([+-]?(?i:inf|infinity)|(?i:nan))$"


def is_number(value: Column) -> Column:
    """Whether a text is a floating-point number in the reach of 64 bits."""
    size = F.abs(F.when(value.rlike(DECIMAL), value).try_cast("double"))
    return F.coalesce((size < F.lit(float("inf"))) | value.rlike(HEXADECIMAL) | value.rlike(NAMED_NUMBER), F.lit(False))


def first_cvss(severities: Column) -> Column:
    """First severity (system, score, vector) whose system begins with cvssv, as written, and whose score is a number."""
    return F.get(F.filter(severities, lambda s: F.coalesce(s["system"].startswith("cvssv"), F.lit(False)) & is_number(text(s["score"]))), F.lit(0))


def first_epss(severities: Column) -> Column:
    return F.get(F.filter(severities, lambda s: s["system"] == "epss"), F.lit(0))


def cvss_version(system: Column) -> Column:
    return F.regexp_extract(text(system), "^cvssv(.*)$", 1)


def supplier_name(raw: Column) -> Column:
    """A bare supplier: without a leading role, a trailing address in brackets, or a value that says nothing."""
    name = F.trim(text(raw))
    bare = F.regexp_replace(name, r"^.*?: ", "")
    shown = F.trim(F.regexp_replace(bare, r"^(.*) \(.*\)$", "$1"))
    return F.when(name.isin("", "NOASSERTION", "NONE"), "").otherwise(shown)


def purl_type(purl: Column) -> Column:
    return F.regexp_extract(text(purl), "^pkg:([^/]*)/", 1)


def purl_path(purl: Column) -> Column:
    """Namespace and name as they are written, up to the first of @, ? and #."""
    return F.regexp_extract(text(purl), "^pkg:[^/]*/([^@?#]*)", 1)


def _by_rule(purl: Column, made: Callable[[tuple[str, str, str, str]], Column], none: Column) -> Column:
    """What the longest rule of the same type whose prefix begins the path makes.

    The rules are ten constants, so they are a CASE by falling length and not a join.
    """
    kind, path = purl_type(purl), purl_path(purl)
    found = none
    for rule in sorted(SUPPLIER_RULES, key=lambda r: len(r[1])):
        found = F.when((kind == rule[0]) & path.startswith(rule[1]), made(rule)).otherwise(found)
    return found


def supplier_of(purl: Column) -> Column:
    """(supplier, country) by rule; null where none matches."""
    none = F.lit(None).cast("struct<supplier:string,country:string>")
    return _by_rule(purl, lambda r: F.struct(F.lit(r[2]).alias("supplier"), F.lit(r[3]).alias("country")), none)


def supplier_prefix(purl: Column) -> Column:
    """The prefix of the rule that matches."""
    return _by_rule(purl, lambda r: F.lit(r[1]), F.lit(None).cast("string"))


def core_purl(purl: Column) -> Column:
    return F.regexp_extract(text(purl), "^([^@?#]*)", 1)


def bucket_bits(kind: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for pair in BUCKET_BITS.items() for x in pair])[kind], F.lit(0))


def purl_hash(core: Column, bits: Column) -> Column:
    """SHA-256 of the core as one large number, modulo 2^bits, in as many hex digits as the bits need."""
    low = F.conv(F.substring(F.sha2(core, 256), -4, 4), 16, 10).cast("int")
    digits = F.greatest(F.lit(1), F.ceil(bits / 4).cast("int"))
    return F.lpad(F.lower(F.hex(low % F.pow(F.lit(2), bits).cast("int"))), digits, F.lit("0"))


def package_path(purl: Column) -> Column:
    """Where a federated mirror keeps a package's files: namespace and name without their escapes; null for what is no package URL."""
    kind = purl_type(purl)
    plain = F.try_url_decode(F.replace(purl_path(purl), F.lit("+"), F.lit("%2B")))
    path = F.concat(F.lit("aboutcode-packages-"), kind, F.lit("-"), purl_hash(core_purl(purl), bucket_bits(kind)), F.lit("/"), kind, F.lit("/"), plain)
    return F.when((kind != "") & (purl_path(purl) != ""), path)


def advisory_path(vcid: Column) -> Column:
    """File of an advisory, in a folder by the sixth and seventh characters of its id; null for ids that are too short."""
    return F.when(F.length(vcid) >= 7, F.concat(F.lit("aboutcode-vulnerabilities/"), F.substring(vcid, 6, 2), F.lit("/"), vcid, F.lit(".yml")))


def search_date(raw: Column) -> Column:
    """Dates as the European search prints them, as UTC."""
    return F.try_to_timestamp(raw, F.lit("MMM d, yyyy, h:mm:ss a"))


def matches_alias(wanted: Column, own: Column, aliases: Column) -> Column:
    """Whether a name is an entry's id or one of its aliases, one a line, whatever the case."""
    return (F.lower(own) == F.lower(wanted)) | F.exists(F.split(text(aliases), "\n"), lambda a: F.lower(F.trim(a)) == F.lower(wanted))


def vulnerability_of_name(name: Column) -> Column:
    """Node id of a vulnerability's name."""
    return F.concat(F.when(F.lower(name).startswith("euvd-"), "vuln:euvd/").otherwise("vuln:cve/"), F.lower(name))
