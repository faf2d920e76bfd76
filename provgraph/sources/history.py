"""Histories: the objects of a git repository, its commits, what they changed and its files as of a commit, as DataFrames.

A repository is a folder that Spark can read (a bare one, or the .git folder of
another) with SHA-1 names. A pack is read whole by one task and so must be below
2 GB (`git repack --max-pack-size` splits larger ones); all else is dealt by
object, commit or path. Whatever is read by rounds is stored round by round in the
shared folder, so no plan grows and lost executors repeat one round at most.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph import shared
from provgraph.functions.enrichment import advisory_path, cvss_version, first_cvss, first_epss, package_path
from provgraph.functions.yaml import yaml_leaves

#: Numbers of the kinds of objects in a pack; 6 and 7 are deltas against a place and against a name.
KINDS = {1: "commit", 2: "tree", 3: "blob", 4: "tag", 6: "delta", 7: "delta"}
_ENTRY = "place string, at bigint, kind string, base_at bigint, base_oid string, data binary, error string"
_ARROW = pa.schema([("place", pa.string()), ("at", pa.int64()), ("kind", pa.string()), ("base_at", pa.int64()), ("base_oid", pa.string()), ("data", pa.binary()), ("error", pa.string())])
#: Bytes of one batch that a task hands on.
BATCH_BYTES = 32 << 20
#: Blocks that the names asked of one folder are dealt over.
NAME_BLOCKS = 64


def _inflated(content: memoryview, at: int) -> tuple[bytes, int]:
    """A compressed stream, and where it ends."""
    machine, parts = zlib.decompressobj(), []
    while not machine.eof:
        if at >= len(content):
            raise ValueError("cut off")
        chunk = content[at : at + 65536]
        parts.append(machine.decompress(chunk))
        at += len(chunk) - len(machine.unused_data)
    return b"".join(parts), at


def _pack(content: memoryview) -> Iterator[tuple]:
    """(at, kind, base_at, base_oid, data) of every entry, in order."""
    if bytes(content[:4]) != b"PACK" or int.from_bytes(content[4:8]) not in (2, 3):
        raise ValueError("not a pack")
    at = 12
    for _ in range(int.from_bytes(content[8:12])):
        start, byte = at, content[at]
        at += 1
        kind = byte >> 4 & 7
        while byte & 128:
            byte, at = content[at], at + 1
        base_at = base_oid = None
        if kind == 6:
            byte, at = content[at], at + 1
            back = byte & 127
            while byte & 128:
                byte, at = content[at], at + 1
                back = (back + 1 << 7) | byte & 127
            base_at = start - back
        elif kind == 7:
            base_oid, at = bytes(content[at : at + 20]).hex(), at + 20
        data, at = _inflated(content, at)
        yield start, KINDS[kind], base_at, base_oid, data


def _loose(content: memoryview) -> Iterator[tuple]:
    data, _ = _inflated(content, 0)
    head, _, body = data.partition(b"\0")
    kind, size = head.decode("ascii").split(" ")
    if kind not in KINDS.values() or int(size) != len(body):
        raise ValueError("not an object")
    yield 0, kind, None, None, body


def _entries(reader):
    """A mapInArrow function over (path, content) files; a damaged file gives what comes before the damage, and an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                try:
                    for at, kind, base_at, base_oid, data in reader(memoryview(content.as_buffer())):
                        rows.append((path, at, kind, base_at, base_oid, data, None))
                        size += len(data)
                        if size > BATCH_BYTES or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                            rows, size = [], 0
                except (ValueError, KeyError, IndexError, zlib.error) as error:
                    rows.append((path, None, None, None, None, None, f"{type(error).__name__}: {error}"))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return run


def patched(base: bytes | None, delta: bytes | None) -> bytes | None:
    """What a delta makes of its base; null for one that doesn't fit."""
    if base is None or delta is None:
        return None
    at = 0

    def size() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = delta[at], at + 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    try:
        if size() != len(base):
            return None
        wanted, out = size(), []
        while at < len(delta):
            byte, at = delta[at], at + 1
            if byte & 128:
                number = [0] * 7
                for i in range(7):
                    if byte >> i & 1:
                        number[i], at = delta[at], at + 1
                start = int.from_bytes(number[:4], "little")
                length = int.from_bytes(number[4:], "little") or 65536
                if start + length > len(base):
                    return None
                out.append(base[start : start + length])
            elif byte:
                out.append(delta[at : at + byte])
                at += byte
            else:
                return None
    except IndexError:
        return None
    made = b"".join(out)
    return made if len(made) == wanted else None


def _name() -> Column:
    """An object's name: the digest of its kind, its size and its bytes."""
    head = F.encode(F.concat(F.col("kind"), F.lit(" "), F.octet_length("data").cast("string")), "UTF-8")
    return F.sha1(F.concat(head, F.lit(bytearray(1)), F.col("data")))


@dataclass
class Tables:
    """Tables in the shared folder that belong to one reader."""

    spark: SparkSession
    paths: list[str] = field(default_factory=list)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        rows, path = shared.kept(df, name)
        self.paths.append(path)
        return rows

    def rounds(self, name: str) -> Rounds:
        where = f"{shared.folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(where)
        return Rounds(self.spark, where)

    def close(self) -> None:
        shared.removed(self.spark, *self.paths)
        self.paths.clear()


@dataclass
class Rounds:
    """A table that is written round by round."""

    spark: SparkSession
    where: str
    schema: object = None
    n: int = 0

    def add(self, df: DataFrame) -> DataFrame:
        """Store a round and read it again."""
        self.schema = self.schema or df.schema
        path = f"{self.where}/round={self.n}"
        df.write.parquet(path)
        self.n += 1
        return self.spark.read.schema(self.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.where}/round={i}" for i in range(self.n)])


def objects(tables: Tables, repo: str) -> tuple[DataFrame, DataFrame]:
    """(oid, kind, data) of every object, once each, and (place, at, error) of what can't be read.

    A delta is joined with its base, in its own pack, as soon as the base is
    known: as many rounds as the longest chain has links, and each delta is in
    one of them only. A delta without a base, or one that doesn't fit, is lost
    with those that build on it.
    """
    files = tables.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    loose = files.option("pathGlobFilter", "[0-9a-f]" * 38).load(f"{repo}/objects").select("path", "content").mapInArrow(_entries(_loose), _ENTRY)
    packs = files.option("pathGlobFilter", "*.pack").load(f"{repo}/objects").select("path", "content").mapInArrow(_entries(_pack), _ENTRY)
    entries = tables.kept(loose.unionByName(packs), "entries")
    deltas = entries.where("kind = 'delta'")
    by_name = not deltas.where("base_oid IS NOT NULL").isEmpty()
    patch = F.udf(patched, "binary", useArrow=True)
    rounds = tables.rounds("objects")
    known = rounds.add(entries.where("kind <> 'delta'").select("place", "at", "kind", _name().alias("oid"), "data"))
    while not known.isEmpty():
        base = known.where("oid IS NOT NULL").select(F.col("place").alias("p"), F.col("at").alias("a"), F.col("oid").alias("o"), F.col("kind").alias("k"), F.col("data").alias("d"))
        met = deltas.join(base, (F.col("place") == F.col("p")) & (F.col("base_at") == F.col("a")))
        if by_name:
            met = met.unionByName(deltas.join(base, (F.col("place") == F.col("p")) & (F.col("base_oid") == F.col("o"))))
        made = met.select("place", "at", F.col("k").alias("kind"), patch("d", "data").alias("data"))
        known = rounds.add(made.select("place", "at", "kind", F.when(F.col("data").isNotNull(), _name()).alias("oid"), "data"))
    every = rounds.all()
    found = every.where("oid IS NOT NULL")
    missing = deltas.select("place", "at").join(found.select("place", "at"), ["place", "at"], "left_anti")
    lost = entries.where("error IS NOT NULL").select("place", "at", "error").unionByName(missing.withColumn("error", F.lit("no base that fits")))
    count = found.agg(F.count("oid"), F.count_distinct("oid")).first()
    one = found if count[0] == count[1] else found.dropDuplicates(["oid"])
    return one.select("oid", "kind", "data"), lost


def tip(spark: SparkSession, repo: str) -> str | None:
    """The commit that a repository is read at: the remote's copy of the checked-out branch, else the remote's own head, else the head."""
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "{HEAD,packed-refs}").load(repo)
    own = plain.where(F.col("path").endswith("/HEAD")).select(F.lit("HEAD").alias("name"), F.trim(F.regexp_replace(F.decode("content", "UTF-8"), r"\s+$", "")).alias("value"), F.lit(0).alias("rank"))
    packed = plain.where(F.col("path").endswith("/packed-refs")).select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where(F.col("line").rlike("^[0-9a-f]{40} "))
    packed = packed.select(F.substring("line", 42, 1 << 20).alias("name"), F.substring("line", 1, 40).alias("value"), F.lit(1).alias("rank"))
    loose = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{repo}/refs")
    loose = loose.select(F.regexp_extract("path", "^.*/(refs/(?:heads|remotes|tags)/.*)$", 1).alias("name"), F.regexp_replace(F.decode("content", "UTF-8"), r"\s+$", "").alias("value"), F.lit(0).alias("rank"))
    named = own.unionByName(packed).unionByName(loose)

    def value(name: str, steps: int = 5) -> str | None:
        row = named.where(F.col("name") == name).orderBy("rank").first()
        if row is None or not steps:
            return None
        return value(row["value"][5:].strip(), steps - 1) if row["value"].startswith("ref: ") else row["value"]

    head = named.where("name = 'HEAD'").first()
    wanted = ["refs/remotes/origin/HEAD", "HEAD"]
    if head is not None and head["value"].startswith("ref: refs/heads/"):
        wanted.insert(0, "refs/remotes/origin/" + head["value"].removeprefix("ref: refs/heads/"))
    return next((v for v in map(value, wanted) if v), None)


def commits(found: DataFrame) -> DataFrame:
    """(commit, tree, parents, committed_at) of the commits among objects."""
    head = F.substring_index(F.decode("data", "ISO-8859-1"), "\n\n", 1)
    rows = found.where("kind = 'commit'").select(F.col("oid").alias("commit"), head.alias("head"))
    at = F.regexp_extract("head", r"(?m)^committer .* (-?\d+) [+-]\d{4}$", 1).try_cast("bigint")
    return rows.select("commit", F.regexp_extract("head", "^tree ([0-9a-f]{40})", 1).alias("tree"), F.regexp_extract_all("head", F.lit(r"(?m)^parent ([0-9a-f]{40})$"), F.lit(1)).alias("parents"), F.timestamp_seconds(at).alias("committed_at"))


def reachable(tables: Tables, every: DataFrame, start: str) -> DataFrame:
    """The commits that a commit descends from, with itself.

    First parents are doubled to jumps of 1, 2, 4 ... commits, so that the walk takes
    a number of rounds that grows with the logarithm of the history, and with
    how deep branches lie in branches, not with its length.
    """
    step = tables.rounds("jumps")
    last = step.add(every.select(F.col("commit").alias("s"), F.explode("parents").alias("t")))
    first = tables.kept(every.where(F.size("parents") > 0).select(F.col("commit").alias("s"), F.get("parents", F.lit(0)).alias("t")), "parents")
    last = first
    while not last.isEmpty():
        last = step.add(last.join(last.select(F.col("s").alias("t"), F.col("t").alias("u")), "t").select("s", F.col("u").alias("t")))
    jumps = step.all()
    seen = tables.rounds("reached")
    new = seen.add(tables.spark.createDataFrame([(start,)], "s string"))
    while not new.isEmpty():
        new = seen.add(jumps.join(new, "s", "left_semi").select(F.col("t").alias("s")).distinct().join(seen.all(), "s", "left_anti"))
    return every.join(seen.all().select(F.col("s").alias("commit")), "commit", "left_semi")


_SLOT = "array<struct<name:string,oid:string,folder:boolean>>"
_CHANGE = "array<struct<name:string,a:string,a_folder:boolean,b:string,b_folder:boolean>>"


def folder_entries(data: bytes | None) -> list[tuple[str, str, bool]]:
    """(name, oid, whether it is a folder) of a tree; bytes that are no UTF-8 are written as escapes."""
    out, at, data = [], 0, data or b""
    while at < len(data):
        blank, zero = data.index(b" ", at), data.index(b"\0", at)
        out.append((data[blank + 1 : zero].decode("utf-8", "backslashreplace"), data[zero + 1 : zero + 21].hex(), data[at:blank] in (b"40000", b"040000")))
        at = zero + 21
    return out


def _differing(a: bytes | None, b: bytes | None) -> list[tuple]:
    left, right = ({n: (o, f) for n, o, f in folder_entries(x)} for x in (a, b))
    none = (None, False)
    return [(n, *left.get(n, none), *right.get(n, none)) for n in sorted(left.keys() | right.keys()) if left.get(n) != right.get(n)]


def _asked(data: bytes | None, names: list[str]) -> list[tuple]:
    wanted = set(names)
    return [e for e in folder_entries(data) if e[0] in wanted]


def changes(tables: Tables, found: DataFrame, walked: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(commit, path, blob, committed_at) of files that a commit changed; blob is null where the file went.

    A file counts for a commit if it differs from that of each of its parents; a
    parent that isn't there (a shallow clone) has no files. Two folders are
    compared only where their names differ, level by level, and only differences
    leave the task. `wanted` (path) keeps the walk to the folders above those files.
    """
    trees = found.where("kind = 'tree'").select("oid", "data")
    above = files = None
    if wanted is not None:
        files = tables.kept(wanted.select("path").distinct(), "wanted")
        parts = F.split("path", "/")
        above = tables.kept(files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("path")).distinct(), "above")
    known = walked.select(F.col("commit").alias("parent"), F.col("tree").alias("b"))
    pairs = walked.select("commit", F.col("tree").alias("a"), F.greatest(F.size("parents"), F.lit(1)).alias("n"), F.explode_outer("parents").alias("parent")).join(known, "parent", "left")
    level = pairs.where(~F.col("a").eqNullSafe(F.col("b"))).select("commit", "n", F.lit("").alias("path"), "a", "b")
    differing = F.udf(_differing, _CHANGE, useArrow=True)
    steps = tables.rounds("changes")
    while True:
        both = level.join(trees.select(F.col("oid").alias("a"), F.col("data").alias("x")), "a", "left").join(trees.select(F.col("oid").alias("b"), F.col("data").alias("y")), "b", "left")
        whole = lambda o, d: F.when(F.col(o).isNotNull() & F.col(d).isNull(), F.raise_error(F.concat(F.lit("a folder is not in the repository: "), F.col(o)))).otherwise(F.col(d))
        each = both.withColumn("d", F.explode(differing(whole("a", "x"), whole("b", "y")))).select("commit", "n", F.when(F.col("path") == "", F.col("d.name")).otherwise(F.concat_ws("/", "path", "d.name")).alias("path"), "d.a", "d.a_folder", "d.b", "d.b_folder")
        if above is not None:
            each = each.join(above, "path", "left_semi")
        step = steps.add(each)
        level = step.where("a_folder OR b_folder").select("commit", "n", "path", F.when(F.col("a_folder"), F.col("a")).alias("a"), F.when(F.col("b_folder"), F.col("b")).alias("b"))
        if level.isEmpty():
            break
    left, right = F.when(~F.col("a_folder"), F.col("a")), F.when(~F.col("b_folder"), F.col("b"))
    changed = steps.all().where(~left.eqNullSafe(right)).groupBy("commit", "path").agg(F.count("*").alias("differ"), F.first("n").alias("n"), F.first(left).alias("blob")).where("differ = n")
    if files is not None:
        changed = changed.join(files, "path", "left_semi")
    return changed.join(walked.select("commit", "committed_at"), "commit").select("commit", "path", "blob", "committed_at")


def blobs_at(tables: Tables, found: DataFrame, walked: DataFrame, asked: DataFrame) -> DataFrame:
    """(commit, path, blob) of the files asked for (commit, path) that are there as of those commits.

    Folders go down level by level; each folder is read once for a block of the
    names that are asked of it, whatever the number of commits that have it.
    """
    trees = found.where("kind = 'tree'").select(F.col("oid").alias("dir"), "data")
    rows = tables.kept(asked.select("commit", "path").distinct().join(walked.select("commit", F.col("tree").alias("dir")), "commit").withColumn("parts", F.split("path", "/")), "asked")
    depth = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    look = F.udf(_asked, _SLOT, useArrow=True)
    ends = tables.rounds("blobs")
    for i in range(depth):
        level = rows.withColumn("name", F.get("parts", F.lit(i)))
        names = level.select("dir", "name").distinct().groupBy("dir", F.pmod(F.xxhash64("name"), F.lit(NAME_BLOCKS)).alias("block")).agg(F.collect_set("name").alias("names"))
        slots = names.join(trees, "dir").select("dir", F.explode(look("data", "names")).alias("s")).select("dir", "s.name", "s.oid", "s.folder")
        met = tables.kept(level.join(slots, ["dir", "name"]), "level")
        ends.add(met.where((F.size("parts") == i + 1) & ~F.col("folder")).select("commit", "path", F.col("oid").alias("blob")))
        rows = met.where((F.size("parts") > i + 1) & F.col("folder")).select("commit", "path", F.col("oid").alias("dir"), "parts")
    return ends.all() if depth else asked.select("commit", "path", F.lit(None).cast("string").alias("blob")).limit(0)


def read_leaves(tables: Tables, found: DataFrame, blobs: DataFrame, name: str) -> DataFrame:
    """(blob, leaves) of YAML files, each read once; null leaves where it can't be read."""
    texts = found.where("kind = 'blob'").join(blobs.select(F.col("blob").alias("oid")).distinct(), "oid", "left_semi")
    return tables.kept(texts.select(F.col("oid").alias("blob"), yaml_leaves(F.col("data")).alias("leaves")), name)


def package_entries(read: DataFrame) -> DataFrame:
    """(blob, purl, affected_by) of the entries of package files."""
    each = read.select("blob", F.explode("leaves").alias("x")).where(F.col("x.path").isin("[].purl", "[].affected_by_vulnerabilities[]"))
    at = lambda i: F.get("x.place", F.lit(i))
    listed = F.array_sort(F.collect_list(F.when(F.col("x.path") != "[].purl", F.struct(at(1).alias("place"), F.col("x.value").alias("v")))))
    rows = each.groupBy("blob", at(0).alias("entry")).agg(F.max(F.when(F.col("x.path") == "[].purl", F.col("x.value"))).alias("purl"), listed.alias("l"))
    return rows.select("blob", "purl", F.transform("l", lambda s: s["v"]).alias("affected_by"))


def advisory_contents(read: DataFrame) -> DataFrame:
    """(blob, vulnerability_id, aliases, summary, cvss, cvss_version, cvss_vector, epss, references, fixed_by) of advisories."""
    of = lambda path: F.filter("leaves", lambda x: x["path"] == path)
    values = lambda path: F.transform(of(path), lambda x: x["value"])
    one = lambda path: F.coalesce(F.get(values(path), F.lit(0)), F.lit(""))
    by_place = lambda path: F.map_from_entries(F.transform(of(path), lambda x: F.struct(F.get(x["place"], F.lit(0)), x["value"])))
    last = F.array_max(F.transform(F.filter("leaves", lambda x: x["path"].startswith("severities[].")), lambda x: F.get(x["place"], F.lit(0))))
    kept = read.where("leaves IS NOT NULL").select(
        "blob", one("vulnerability_id").alias("vulnerability_id"), values("aliases[]").alias("aliases"), one("summary").alias("summary"), values("references[].url").alias("references"), last.alias("last"),
        *[by_place(f"severities[].{n}").alias(a) for n, a in (("scoring_system", "systems"), ("score", "scores"), ("scoring_elements", "vectors"))],
    )
    places = F.when(F.col("last").isNotNull(), F.sequence(F.lit(0), F.col("last"))).otherwise(F.array().cast("array<int>"))
    severities = F.transform(places, lambda i: F.struct(F.try_element_at("systems", i).alias("system"), F.try_element_at("scores", i).alias("score"), F.try_element_at("vectors", i).alias("vector")))
    scored = kept.withColumn("severities", severities).withColumns({"c": first_cvss(F.col("severities")), "e": first_epss(F.col("severities"))})
    return scored.select("blob", "vulnerability_id", "aliases", "summary", F.col("c.score").alias("cvss"), cvss_version(F.col("c.system")).alias("cvss_version"), F.col("c.vector").alias("cvss_vector"), F.col("e.score").alias("epss"), "references", F.array().cast("array<string>").alias("fixed_by"))


@dataclass
class Replay:
    """What `enrichers.replayed` needs of a repository; (path, commit) of the files that can't be read, which count as empty."""

    commits: DataFrame
    advisories: DataFrame
    subjects: DataFrame
    stated: DataFrame
    unread: DataFrame


def replay(tables: Tables, repo: str, subjects: DataFrame) -> Replay:
    """The history of the package files of `subjects` (purl, subject), and of every advisory that they have named."""
    start = tip(tables.spark, repo)
    found, _ = objects(tables, repo)
    walked = tables.kept(reachable(tables, commits(found), start or ""), "commits")
    subjects = tables.kept(subjects.withColumn("path", F.concat(package_path(F.col("purl")), F.lit("/vulnerabilities.yml"))), "subjects")
    touched = tables.kept(changes(tables, found, walked, subjects), "touched")
    read = read_leaves(tables, found, touched, "packages")
    listed = touched.join(package_entries(read), "blob").join(subjects.select("path", "purl"), ["path", "purl"], "left_semi")
    none = touched.select("path", "commit", "committed_at", F.lit(None).cast("string").alias("purl"), F.array().cast("array<string>").alias("affected_by"))
    history = tables.kept(listed.select(none.columns).unionByName(none), "history")
    named = tables.kept(history.select("commit", F.explode("affected_by").alias("vcid")).withColumn("path", advisory_path(F.col("vcid"))).where("path IS NOT NULL").distinct(), "named")
    told = tables.kept(changes(tables, found, walked, named), "told")
    then = tables.kept(blobs_at(tables, found, walked, named), "then")
    texts = read_leaves(tables, found, told.select("blob").unionByName(then.select("blob")), "advisories")
    facts = tables.kept(advisory_contents(texts), "facts")
    empty = F.array().cast("array<string>")
    advisories = told.withColumn("vcid", F.regexp_extract("path", r"([^/]+)\.yml$", 1)).join(facts, "blob", "left").withColumn("aliases", F.when(F.col("vulnerability_id") != "", F.col("aliases")).otherwise(empty))
    stated = then.join(facts.select("blob", "aliases"), "blob").join(named, ["commit", "path"]).select("vcid", "commit", "aliases")
    unread = touched.join(read.where("leaves IS NULL"), "blob", "left_semi").unionByName(told.join(texts.where("leaves IS NULL"), "blob", "left_semi"))
    return Replay(history, advisories, subjects, stated, unread.select("path", "commit"))
