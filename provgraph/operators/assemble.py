"""Evidence tables to graph records.

One projection for each kind: resolve the valid time, derive the ids, and lay
out all records of a row as one array that is exploded once. No shuffle happens
before the merge.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.functions import ids
from provgraph.functions.schemas import ARTIFACT, BUILDER, COMMON, ENDPOINTS, LICENSE, PACKAGE, PROPS, SOURCE, VALUE, VULNERABILITY
from provgraph.functions.text import canon_qualifiers, encode_pairs, float_text, join_ids, optional_time, required_time, sorted_ids, text
from provgraph.operators.kinds import DERIVED, KINDS, TYPES, Kind

#: Ordinals: phase (0 for the packages' own pass), then the row's item (below 2^48), then the place among its records.
PHASE, PLACE = 1 << 58, 1 << 10
#: Begins the names of columns that follow from an evidence's id.
BY = "by_"
LABELS = {"src": "SrcName", "artifact": "Artifact", "builder": "Builder", "vulnerability": "Vulnerability", "license": "License"}


@dataclass(frozen=True)
class Graph:
    """Nodes and edges; `ord` orders records, so that the first of several with one id is defined."""

    nodes: DataFrame
    edges: DataFrame
    ends_hold = False

    def edges_of(self, label: str) -> DataFrame:
        return self.edges.where(F.col("label") == label)

    def nodes_of(self, label: str) -> DataFrame:
        return self.nodes.where(F.array_contains("labels", label) if "labels" in self.nodes.columns else F.col("label") == label)


@dataclass(frozen=True)
class Guard:
    """Times before `floor` or after now + skew are not believed."""

    now: datetime
    floor: datetime = datetime(2000, 1, 1, tzinfo=UTC)
    skew: timedelta = timedelta(minutes=5)

    def refused(self, at: Column) -> Column:
        return at.isNull() | (at < F.lit(self.floor)) | (at > F.lit(self.now + self.skew))

    def resolve(self, at: Column) -> Column:
        return F.when(self.refused(at), F.lit(self.now)).otherwise(at)


def value(kind: str, column: Column) -> Column:
    fields = {"s": "string", "i": "bigint", "f": "double", "b": "boolean"}
    return F.struct(F.lit(kind).alias("kind"), *[(column if k == kind else F.lit(None)).cast(t).alias(k) for k, t in fields.items()]).cast(VALUE)


def prop(key: str, column: Column, kind: str = "s") -> Column:
    return F.struct(F.lit(key).alias("key"), value(kind, column).alias("value"))


def without_empty(props: Column) -> Column:
    return F.filter(props, lambda p: ~((p["value"]["kind"] == "s") & (F.coalesce(p["value"]["s"], F.lit("")) == "")))


def node(id_: Column, label: str, props: list[Column]) -> Column:
    return F.struct(id_.alias("id"), F.array(F.lit(label)).alias("labels"), without_empty(F.array(*props)).cast(PROPS).alias("props"))


def _fields(c: Column, *names: str) -> list[Column]:
    return [prop(n, text(c[n])) for n in names]


def package_nodes(p: Column) -> list[Column]:
    version = [*_fields(p, "type", "namespace", "name", "version"), prop("qualifiers", canon_qualifiers(p["qualifiers"])), *_fields(p, "subpath"), prop("purl", ids.package_purl(p))]
    return [node(ids.package_version_id(p), "PkgVersion", version), node(ids.package_name_id(p), "PkgName", _fields(p, "type", "namespace", "name"))]


def identity_nodes(kind: str, c: Column) -> list[Column]:
    """Nodes of one endpoint; they are null where the endpoint is."""
    base = kind.removeprefix("equal_").removeprefix("dep_")
    if base == "pkg":
        found = package_nodes(c)
    elif base == "src":
        found = [node(ids.source_id(c), "SrcName", _fields(c, "type", "namespace", "name", "tag", "commit"))]
    elif base == "artifact":
        found = [node(ids.artifact_id(c), "Artifact", [prop("algorithm", F.lower(text(c["algorithm"]))), prop("digest", F.lower(text(c["digest"])))])]
    elif base == "builder":
        found = [node(ids.builder_id(c), "Builder", _fields(c, "uri"))]
    elif base == "license":
        found = [node(ids.license_id(c), "License", _fields(c, "name", "inline", "listVersion"))]
    else:
        none = ids.is_no_vulnerability(c)
        # Ids are compared without regard to case, so the properties are lower-case too.
        found = [node(ids.vulnerability_id(c), "Vulnerability", [prop("type", F.lower(text(c["type"]))), prop("vulnID", F.when(none, "").otherwise(F.lower(text(c["vulnerabilityID"]))))])]
    return [F.when(c.isNotNull(), n) for n in found]


def endpoint_id(kind: str, c: Column) -> Column:
    base = kind.removeprefix("equal_").removeprefix("dep_")
    make = {"pkg": ids.package_version_id, "src": ids.source_id, "artifact": ids.artifact_id, "builder": ids.builder_id, "vulnerability": ids.vulnerability_id, "license": ids.license_id}[base]
    return F.when(c.isNotNull(), make(c)).otherwise("")


def conformed(ir: DataFrame, kind: Kind, given: tuple[str, ...] = ()) -> DataFrame:
    """The evidence table with every column its kind may have, absent ones null; rows whose spec is missing (has_spec false) teach packages only."""
    wanted = dict(COMMON) | {e: ENDPOINTS[e] for e in kind.endpoints} | {"match": "string", "has_spec": "boolean"}
    for name in dict.fromkeys(f"{kind.parts} {kind.props}".split()):
        if name not in DERIVED and name not in wanted:
            wanted[name] = TYPES.get(name, "string")
    if kind.time:
        wanted[kind.time] = "timestamp"
    return ir.select(*[(F.col(n) if n in ir.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()], *[f"{e}_id" for e in given], *_by(ir))


def _by(ir: DataFrame) -> list[str]:
    return [c for c in ir.columns if c.startswith(BY)]


def _subject(kind: Kind, given: tuple[str, ...] = ()) -> Column:
    """Id of the first endpoint that is there; of all versions of a package where the match says so."""
    found = F.lit("")
    for name in reversed(kind.subject):
        own = F.col(f"{name}_id") if name in given else endpoint_id(name, F.col(name))
        if name == "pkg" and kind.name in {"HasSourceAt", "CertifyBad", "CertifyGood", "HasMetadata", "PointOfContact"}:
            own = F.when(F.col("match") == "ALL_VERSIONS", ids.package_name_id(F.col("pkg"))).otherwise(own)
        found = F.when(F.col(name).isNotNull(), own).otherwise(found)
    return found


def _is_stated(endpoints: tuple[str, ...], ir: DataFrame) -> Column:
    """Whether a row has one of some endpoints: an id is never empty, so it needn't be made to tell."""
    return reduce(lambda x, y: x | y, [F.col(n).isNotNull() for n in endpoints if n in ir.columns], F.lit(False))


def evidence(ir: DataFrame, kind_name: str, guard: Guard, given: tuple[str, ...] = ()) -> DataFrame:
    """`ir` with the derived ids, texts, valid time and the evidence id of each row; ids of `given` endpoints are columns of `ir`."""
    kind = KINDS[kind_name]
    df = conformed(ir, kind, given).where(F.coalesce("has_spec", F.lit(True)))
    made = {"subject": _subject(kind, given)}
    made["object"] = F.col(f"{kind.object}_id") if kind.object in given else endpoint_id(kind.object, F.col(kind.object)) if kind.object else F.lit("")
    if kind.members:
        made["member_ids"] = sorted_ids(F.array(*[endpoint_id(m, F.col(m)) for m in kind.members]))
    if "builder" in kind.endpoints:
        made["builtById"] = endpoint_id("builder", F.col("builder"))
    for name, base in (("materials", "artifact"), ("declared", "license"), ("discovered", "license")):
        if name in kind.endpoints:
            made[f"{name}_ids"] = _each(F.coalesce(F.col(name), F.array().cast(ENDPOINTS[name])), endpoint_id, base)
    at = F.col(kind.time) if kind.time else F.lit(None).cast("timestamp")
    df = df.withColumns(made | {"vf": guard.resolve(at), "fallback": guard.refused(at)})
    return df.withColumn("id", ids.evidence_id(kind.name, *[c for _, c in _values(kind, kind.parts, hashed=True)]))


def _values(kind: Kind, names: str, hashed: bool = False) -> list[tuple[str, Column]]:
    """(name, column) of each part or property."""
    packed = {"members": "member_ids", "builtFrom": "materials_ids", "declaredLicenses": "declared_ids", "discoveredLicenses": "discovered_ids"}
    found = []
    for name in names.replace("ocd", "origin collector documentRef").split():
        if name in packed:
            column = join_ids(F.col(packed[name]))
        elif name in ("subjectId", "objectId"):
            column = F.col(name.removesuffix("Id"))
        elif TYPES.get(name) == "timestamp":
            column = (optional_time if kind.optional_time else required_time)(F.col(name))
        elif TYPES.get(name) == "double":
            column = float_text(F.col(name)) if hashed else F.col(name)
        elif name in ("predicates", "checks"):
            column = encode_pairs(F.col(name))
        elif TYPES.get(name) == "array<string>":
            column = join_ids(F.col(name))
        else:
            column = text(F.col(name))
        found.append((name, column))
    return found


def _edge(src: Column, label: str, dst: Column) -> Column:
    return F.struct(ids.edge_id(src, F.lit(label), dst).alias("id"), F.lit(label).alias("label"), src.alias("src"), dst.alias("dst"))


def _each(items: Column, make: Callable, first: str) -> Column:
    """`make(first, item)` of every item; transform would take a second lambda argument for an index."""
    return F.transform(items, lambda x: make(first, x))


def _edge_from_self(label: str, to: Column) -> Column:
    return _edge(F.col("id"), label, to)


def _ordinal(phase: int, place: Column) -> Column:
    return F.lit(phase * PHASE) + F.coalesce("item", F.lit(0)) * PLACE + place


def _laid(kind: Kind) -> Column:
    """All edges that a row of `evidence` states, as an array."""
    ends = {"self": F.col("id"), "subject": F.col("subject"), "object": F.col("object")}
    single, more = [], []
    for label, src, dst in kind.edges:
        if dst == "member":
            more.append(_each(F.col("member_ids"), _edge_from_self, label))
        elif dst in _LISTS:
            more.append(_each(F.col(f"{dst}_ids"), _edge_from_self, label))
        else:
            single.append(_edge(ends[src], label, ends[dst] if dst in ends else F.col(dst)))
    for e in kind.endpoints:
        if e in ("pkg", "dep_pkg", "equal_pkg"):
            p = F.col(e)
            single.append(F.when(p.isNotNull(), _edge(ids.package_name_id(p), "PkgHasVersion", ids.package_version_id(p))))
    laid = F.concat(*([F.array(*single)] if single else []), *more)
    return F.filter(laid, lambda e: e.isNotNull() & (e["src"] != "") & (e["dst"] != ""))


def records(ir: DataFrame, kind_name: str, guard: Guard) -> Graph:
    """All nodes and edges that the rows of one kind state, repeats included."""
    kind = KINDS[kind_name]
    df = evidence(ir, kind_name, guard)
    own = [prop(n, c, "f" if TYPES.get(n) == "double" else "s") for n, c in _values(kind, kind.props)]
    lists = {"materials": "artifact", "declared": "license", "discovered": "license"}
    singles = [n for e in kind.endpoints if e not in lists for n in identity_nodes(e, F.col(e))]
    every = F.array(*singles, node(F.col("id"), kind.name, own))
    many = [_each(F.coalesce(F.col(e), F.array().cast(ENDPOINTS[e])), lambda b, x: identity_nodes(b, x)[0], lists[e]) for e in kind.endpoints if e in lists]
    every = F.filter(F.concat(every, *many), lambda n: n.isNotNull())
    nodes = df.select("item", "doc", "vf", F.posexplode(every).alias("place", "n")).select("n.*", F.col("vf").alias("valid_from"), _ordinal(kind.phase, F.col("place")).alias("ord"), "doc")

    laid = _laid(kind)
    edges = df.select("item", "doc", "vf", F.posexplode(laid).alias("place", "e")).select("e.*", F.array().cast(PROPS).alias("props"), F.col("vf").alias("valid_from"), _ordinal(kind.phase, F.col("place")).alias("ord"), "doc")
    return Graph(nodes, edges)


def edge_rows(ir: DataFrame, kind_name: str, guard: Guard, label: str) -> DataFrame:
    """(src, dst, valid_from) of one label, straight from the evidence, without the other records of its rows."""
    kind = KINDS[kind_name]
    if label == "PkgHasVersion":
        df = conformed(ir, kind).where(F.coalesce("has_spec", F.lit(True)))
        at = guard.resolve(F.col(kind.time) if kind.time else F.lit(None).cast("timestamp"))
        ends = [F.when(F.col(e).isNotNull(), F.struct(ids.package_name_id(F.col(e)).alias("src"), ids.package_version_id(F.col(e)).alias("dst"))) for e in kind.endpoints if e.endswith("pkg")]
        return df.select(at.alias("valid_from"), F.explode(F.filter(F.array(*ends), lambda x: x.isNotNull())).alias("e")).select("e.src", "e.dst", "valid_from")
    df = evidence(ir, kind_name, guard)
    ends = {"self": "id", "subject": "subject", "object": "object", "member": "member_ids"} | {n: f"{n}_ids" for n in ("materials", "declared", "discovered")}
    _, src, dst = next(e for e in kind.edges if e[0] == label)
    to = F.col(ends.get(dst, dst))
    rows = df.select(F.col(ends.get(src, src)).alias("src"), (F.explode(to) if ends.get(dst, "").endswith("_ids") else to).alias("dst"), F.col("vf").alias("valid_from"))
    return rows.where("src <> '' AND dst <> ''")


class Tables(dict):
    """Evidence tables by kind, with what their maker knows of them.

    A column whose name begins with BY follows from the evidence's id: rows of one
    id agree on it. Where rows already lie by such columns, they are united with no
    further shuffle. `packages` has, for some kinds, fewer rows that name the same
    packages, at the same earliest times and least items; `others` such rows for all
    else that a kind names (their places among a row's records may be other ones).
    """

    def __init__(self, tables: dict[str, DataFrame], packages: dict[str, DataFrame] | None = None, others: dict[str, DataFrame] | None = None):
        super().__init__(tables)
        self.packages, self.others = packages or {}, others or {}


class EvidenceGraph:
    """A graph read off evidence tables label by label, for pattern queries: no record is built that a pattern doesn't ask for.

    Every edge is stated by the row that states its ends, at the same time, so
    the ends hold whenever the edge does; `ends_hold` spares their joins.
    """

    ends_hold = True

    def __init__(self, tables: dict[str, DataFrame], guard: Guard):
        self.tables, self.guard = tables, guard

    def edges_of(self, label: str) -> DataFrame:
        """(src, dst, valid_from): each pair once, at its earliest."""
        stating = [n for n in self.tables if any(e[0] == label for e in KINDS[n].edges) or label == "PkgHasVersion" and any(e.endswith("pkg") for e in KINDS[n].endpoints)]
        rows = reduce(DataFrame.unionByName, [edge_rows(self.tables[n], n, self.guard, label) for n in stating])
        return rows.groupBy("src", "dst").agg(F.min("valid_from").alias("valid_from"))

    def pairs_of(self, kind_name: str, among: DataFrame | None = None) -> DataFrame:
        """(subject, object, valid_from) of a kind's rows: two edges at once, without the evidence node between them.

        With `among` (one column of ids) only rows whose object is one of them. Where a table states the id of
        an endpoint (`dep_pkg_id` beside `dep_pkg`), that is taken: the lens makes it once for each
        package, and not for each row that names it.
        """
        kind, ir = KINDS[kind_name], self.tables[kind_name]
        given = tuple(e for e in kind.endpoints if f"{e}_id" in ir.columns)
        if among is not None:
            to = F.col(f"{kind.object}_id") if kind.object in given else endpoint_id(kind.object, F.col(kind.object))
            ir = ir.withColumn("__object", to).join(among.toDF("__object"), "__object", "left_semi")
        ir = ir.where(_is_stated(kind.subject, ir) & _is_stated((kind.object,), ir))
        return evidence(ir, kind.name, self.guard, given).select("subject", "object", F.col("vf").alias("valid_from"))

    def subjects_of(self, kind_name: str) -> DataFrame:
        """(subject, valid_from) of a kind's rows."""
        ir = self.tables[kind_name]
        return evidence(ir.where(_is_stated(KINDS[kind_name].subject, ir)), kind_name, self.guard).select("subject", F.col("vf").alias("valid_from"))

    def nodes_of(self, label: str) -> DataFrame:
        """(label, id, valid_from) of one label, each id once."""
        return self.nodes().where(F.col("label") == label)

    def nodes(self) -> DataFrame:
        """(label, id, valid_from) of all labels, each id once."""
        return nodes_once(self.tables, self.guard).select("label", "id", "valid_from")

    def edges(self) -> DataFrame:
        """(label, src, dst, valid_from) of all labels, each pair once."""
        return edges_once(self.tables, self.guard).select("label", "src", "dst", "valid_from")


def once_by_id(ir: DataFrame, kind: Kind, guard: Guard, *columns: str) -> DataFrame:
    """(id, columns that follow from it, valid_from, ord): each evidence id once. Its hash is shuffled as bytes, half of its text, and not at all where rows lie by columns that follow from it."""
    by = _by(ir)
    rows = evidence(ir, kind.name, guard).select(*by, F.unhex(F.substring("id", len(kind.name) + 2, 64)).alias("hash"), *columns, F.col("vf").alias("valid_from"), _ordinal(kind.phase, F.lit(0)).alias("ord"))
    once = rows.groupBy(*by, "hash", *columns).agg(F.min("valid_from").alias("valid_from"), F.min("ord").alias("ord"))
    return once.select(F.concat(F.lit(f"{kind.name}:"), F.lower(F.hex("hash"))).alias("id"), *columns, "valid_from", "ord")


def package_versions(tables: dict[str, DataFrame], guard: Guard, prepass: bool = False) -> DataFrame | None:
    """(the parts of a version's id, valid_from, ord): each version of a package once; None if no table names packages.

    The parts are united as the id reads them. An id tells its parts, so that no
    two rows have one id, and it is made of the rows that are left.
    """
    found = []
    for name, ir in tables.items():
        kind, ir = KINDS[name], getattr(tables, "packages", {}).get(name, ir)
        places = {e: i for i, e in enumerate(kind.endpoints) if e.endswith("pkg")}
        if not places:
            continue
        df, spec = conformed(ir, kind), F.coalesce("has_spec", F.lit(True))
        at, now = guard.resolve(F.col(kind.time) if kind.time else F.lit(None).cast("timestamp")), F.lit(guard.now).cast("timestamp")
        if prepass:
            at = F.when(spec, F.least(at, now)).otherwise(now)
        else:
            df = df.where(spec)
        named = F.array(*[F.struct(F.col(e).alias("p"), _ordinal(kind.phase, F.lit(i)).alias("ord")) for e, i in places.items()])
        rows = df.select(at.alias("valid_from"), F.explode(named).alias("x")).where("x.p IS NOT NULL").select("valid_from", "x.p", "x.ord")
        p = F.col("p")
        found.append(rows.select(*[(canon_qualifiers(p[c]) if c == "qualifiers" else text(p[c])).alias(c) for c in _PARTS], "valid_from", "ord"))
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).groupBy(*_PARTS).agg(F.min("valid_from").alias("valid_from"), F.min("ord").alias("ord"))


_PARTS = ("type", "namespace", "name", "version", "qualifiers", "subpath")


def _edge_to(label: str, src: Column) -> Callable[[Column], Column]:
    return lambda dst: F.struct(F.lit(label).alias("label"), src.alias("src"), dst.alias("dst"))


def edges_once(tables: dict[str, DataFrame], guard: Guard, prepass: bool = False) -> DataFrame:
    """(label, src, dst, valid_from, ord): every edge of all kinds once.

    One end of an edge is an evidence node, whose id hashes the other; rows are
    united by that id before their edges are laid out, with no shuffle of edges.
    """
    found = []
    for name, ir in tables.items():
        kind = KINDS[name]
        ends = {"self": "id", "member": "member_ids"} | {n: f"{n}_ids" for n in _LISTS}
        columns = dict.fromkeys(ends.get(e, e) for _, *both in kind.edges for e in both if e != "self")
        single, many = [], []
        for label, src, dst in kind.edges:
            laid = _edge_to(label, F.col(ends.get(src, src)))
            if ends.get(dst, "").endswith("_ids"):
                many.append(F.transform(F.array_distinct(ends[dst]), laid))
            else:
                single.append(laid(F.col(ends.get(dst, dst))))
        every = F.concat(*([F.array(*single)] if single else []), *many) if many else F.array(*single)
        once = once_by_id(ir, kind, guard, *columns)
        found.append(once.select(F.explode(every).alias("e"), "valid_from", "ord").select("e.*", "valid_from", "ord").where("src <> '' AND dst <> ''"))
    versions = package_versions(tables, guard, prepass)
    if versions is not None:
        p = {c: F.col(c) for c in _PARTS}
        found.append(versions.select(F.lit("PkgHasVersion").alias("label"), ids.package_name_id(p).alias("src"), ids.package_version_id(p, canonical=True).alias("dst"), "valid_from", "ord"))
    return reduce(DataFrame.unionByName, found)


def nodes_once(tables: dict[str, DataFrame], guard: Guard, prepass: bool = False) -> DataFrame:
    """(label, id, valid_from, ord): every node of all kinds once, without properties."""
    found = [once_by_id(ir, KINDS[n], guard).select(F.lit(n).alias("label"), "id", "valid_from", "ord") for n, ir in tables.items()]
    first = [F.min("valid_from").alias("valid_from"), F.min("ord").alias("ord")]
    versions = package_versions(tables, guard, prepass)
    if versions is not None:
        p = {c: F.col(c) for c in _PARTS}
        names = versions.groupBy("type", "namespace", "name").agg(*first)
        found.append(versions.select(F.lit("PkgVersion").alias("label"), ids.package_version_id(p, canonical=True).alias("id"), "valid_from", "ord"))
        found.append(names.select(F.lit("PkgName").alias("label"), ids.package_name_id(p).alias("id"), "valid_from", "ord"))
    fewer = getattr(tables, "others", {})
    others = [rows for n, ir in tables.items() if (rows := _other_rows(fewer.get(n, ir), KINDS[n], guard)) is not None]
    if others:
        rows = reduce(DataFrame.unionByName, others).withColumn("id", ids.packed(F.col("id")))
        found.append(rows.groupBy("label", "id").agg(*first).select("label", ids.unpacked(F.col("id")).alias("id"), "valid_from", "ord"))
    return reduce(DataFrame.unionByName, found)


def _other_rows(ir: DataFrame, kind: Kind, guard: Guard) -> DataFrame | None:
    """(label, id, valid_from, ord) of what a kind's rows name besides packages."""
    one, many, begin = [], [], F.lit(len(kind.endpoints))

    def named(base: str, id_: Column, place: Column) -> Column:
        return F.struct(F.lit(LABELS[base]).alias("label"), id_.alias("id"), _ordinal(kind.phase, place).alias("ord"))

    def listed(base: str, items: Column, begin: Column) -> Column:
        return F.transform(items, lambda x, i: named(base, endpoint_id(base, x), begin + i))

    for place, e in enumerate(kind.endpoints):
        if e in _LISTS:
            items = F.coalesce(F.col(e), F.array().cast(ENDPOINTS[e]))
            many.append(listed(_LISTS[e], items, begin))
            begin = begin + F.size(items)
        elif not e.endswith("pkg"):
            one.append(named(e.removeprefix("equal_"), endpoint_id(e, F.col(e)), F.lit(place)))
    if not one and not many:
        return None
    at = guard.resolve(F.col(kind.time) if kind.time else F.lit(None).cast("timestamp"))
    every = F.concat(*([F.array(*one)] if one else []), *many) if many else F.array(*one)
    rows = conformed(ir, kind).where(F.coalesce("has_spec", F.lit(True))).select(at.alias("valid_from"), F.explode(every).alias("x"))
    return rows.select("x.label", "x.id", "valid_from", "x.ord").where("id <> ''")


def evidence_nodes(ir: DataFrame, kind_name: str, guard: Guard) -> DataFrame:
    """Only the evidence nodes of a kind: one for each row, no identity nodes and nothing to explode."""
    kind = KINDS[kind_name]
    own = [prop(n, c, "f" if TYPES.get(n) == "double" else "s") for n, c in _values(kind, kind.props)]
    return evidence(ir, kind_name, guard).select(node(F.col("id"), kind.name, own).alias("n"), F.col("vf").alias("valid_from"), _ordinal(kind.phase, F.lit(0)).alias("ord")).select("n.*", "valid_from", "ord")


def package_pass(tables: dict[str, DataFrame], guard: Guard) -> Graph:
    """Identity records of every package that any table names, stamped now; they don't count as fallbacks."""
    named = []
    for name, ir in tables.items():
        kind = KINDS[name]
        df = conformed(ir, kind)
        named += [df.select("doc", F.col(e).alias("p")).where(F.col("p").isNotNull()) for e in kind.endpoints if e in ("pkg", "dep_pkg", "equal_pkg")]
    p = F.col("p")
    every = reduce(DataFrame.unionByName, named)
    now = F.lit(guard.now).cast("timestamp")
    nodes = every.select("doc", F.posexplode(F.array(*package_nodes(p))).alias("place", "n")).select("n.*", now.alias("valid_from"), F.col("place").cast("bigint").alias("ord"), "doc")
    edge = _edge(ids.package_name_id(p), "PkgHasVersion", ids.package_version_id(p))
    edges = every.select("doc", edge.alias("e")).select("e.*", F.array().cast(PROPS).alias("props"), now.alias("valid_from"), F.lit(0).cast("bigint").alias("ord"), "doc")
    return Graph(nodes, edges)


#: Columns of entities, and the endpoints that each is found at.
ENTITIES = {"pkg": PACKAGE, "src": SOURCE, "artifact": ARTIFACT, "builder": BUILDER, "vulnerability": VULNERABILITY, "license": LICENSE}
_LISTS = {"materials": "artifact", "declared": "license", "discovered": "license"}


def entity_rows(ir: DataFrame, kind_name: str, guard: Guard, prepass: bool) -> DataFrame:
    """(one column for each type of entity, all but one null; valid_from, ord): what the rows of a kind name, without ids or properties.

    With `prepass` every package is known from now on at the latest, even where a row's spec is missing.
    """
    kind = KINDS[kind_name]
    df = conformed(ir, kind)
    spec = F.coalesce("has_spec", F.lit(True))
    stated = guard.resolve(F.col(kind.time) if kind.time else F.lit(None).cast("timestamp"))
    now = F.lit(guard.now).cast("timestamp")

    def entity(base: str, c: Column, place: Column) -> Column:
        at = F.when(spec, F.least(stated, now)).otherwise(now) if prepass and base == "pkg" else F.when(spec, stated)
        own = [(c if b == base else F.lit(None)).cast(t).alias(b) for b, t in ENTITIES.items()]
        return F.struct(*own, at.alias("valid_from"), _ordinal(kind.phase, place).alias("ord"))

    def entities(base: str, items: Column, begin: Column) -> Column:
        return F.transform(items, lambda x, i: entity(base, x, begin + i))

    one, many, begin = [], [], F.lit(len(kind.endpoints))
    for place, e in enumerate(kind.endpoints):
        base = _LISTS.get(e) or e.removeprefix("equal_").removeprefix("dep_")
        if e in _LISTS:
            # Entities of lists come after the others, in the order of lists and their elements.
            items = F.coalesce(F.col(e), F.array().cast(ENDPOINTS[e]))
            many.append(entities(base, items, begin))
            begin = begin + F.size(items)
        else:
            one.append(F.when(F.col(e).isNotNull(), entity(base, F.col(e), F.lit(place))))
    rows = df.select(F.explode(F.concat(F.array(*one), *many)).alias("x"))
    return rows.select("x.*").where("valid_from IS NOT NULL")


def entity_nodes(rows: DataFrame) -> DataFrame:
    """Identity nodes of entity rows. Equal entities are united before anything is made of them: keys and times only, in a hash aggregation."""
    once = rows.groupBy(*ENTITIES).agg(F.min("valid_from").alias("valid_from"), F.min("ord").alias("ord"))
    made = F.filter(F.array(*[n for base in ENTITIES for n in identity_nodes(base, F.col(base))]), lambda n: n.isNotNull())
    return once.select(F.explode(made).alias("n"), "valid_from", "ord").select("n.*", "valid_from", "ord")


def follows_from_id(kind: Kind) -> bool:
    """Whether a kind's id hashes all of its properties, so that rows of one id have one payload."""
    bare = lambda names: {n.removesuffix("Id") if n in ("subjectId", "objectId") else n for n in names.split()}
    return bare(kind.props) <= bare(kind.parts)


def evidence_once(ir: DataFrame, kind_name: str, guard: Guard) -> DataFrame:
    """Evidence nodes of a kind whose payload follows from the id: rows are united by id and plain values, and properties are laid out afterwards."""
    kind = KINDS[kind_name]
    values = [(n, c, "f" if TYPES.get(n) == "double" else "s") for n, c in _values(kind, kind.props)]
    rows = evidence(ir, kind_name, guard).select("id", *[c.alias(f"v_{n}") for n, c, _ in values], F.col("vf").alias("valid_from"), _ordinal(kind.phase, F.lit(0)).alias("ord"))
    once = rows.groupBy("id", *[f"v_{n}" for n, _, _ in values]).agg(F.min("valid_from").alias("valid_from"), F.min("ord").alias("ord"))
    own = [prop(n, F.col(f"v_{n}"), k) for n, _, k in values]
    return once.select(node(F.col("id"), kind.name, own).alias("n"), "valid_from", "ord").select("n.*", "valid_from", "ord")


def assemble(tables: dict[str, DataFrame], guard: Guard, prepass: bool = True) -> Graph:
    """Records of all kinds, not merged yet."""
    parts = [records(ir, name, guard) for name, ir in sorted(tables.items(), key=lambda x: KINDS[x[0]].phase)]
    if prepass and any(e.endswith("pkg") for name in tables for e in KINDS[name].endpoints):
        parts.insert(0, package_pass(tables, guard))
    return Graph(reduce(DataFrame.unionByName, [p.nodes for p in parts]), reduce(DataFrame.unionByName, [p.edges for p in parts]))


def fallbacks(tables: dict[str, DataFrame], guard: Guard) -> DataFrame:
    """kind, assertions and how many of them fell back to now, before any merge."""
    parts = [evidence(ir, name, guard).groupBy(F.lit(name).alias("kind")).agg(F.count("*").alias("assertions"), F.sum(F.col("fallback").cast("long")).alias("fallbacks")) for name, ir in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def document_valid_time(tables: dict[str, DataFrame], guard: Guard) -> DataFrame:
    """doc, its earliest believed time, else now, and whether it fell back."""
    times = reduce(DataFrame.unionByName, [evidence(ir, name, guard).select("doc", F.when(~F.col("fallback"), F.col("vf")).alias("t")) for name, ir in tables.items()])
    return times.groupBy("doc").agg(F.min("t").alias("t")).select("doc", F.coalesce("t", F.lit(guard.now)).alias("valid_from"), F.col("t").isNull().alias("fallback"))
