"""Bitemporal store on Parquet: base and delta files in buckets, and a log of commits.

Versions have valid and system intervals; `None` ends are open. Writing a batch
replaces what the store holds now for the batch's ids: the new version is valid
from its own time on, an earlier version keeps the time before, and versions that
changed are closed on the system axis, never removed. An identical batch changes
nothing.

Rows lie in buckets by a hash of their id. A write reads only the buckets that its
batch falls in and adds a delta to them: the versions it closed, and all open
versions of the ids that changed. Readers take an id's open versions from the last
delta that names it, else from the bucket's base; closed versions are never stated
again. A bucket whose deltas have grown in number or size is written anew as a base
by the write that found it so.

A commit is one small entry in the log, made whole under a number that nobody has
taken (the file system must refuse to link or rename onto an existing name, as HDFS
and local disks do). It names every file of all tables, so tables change together
and a reader keeps the state it began with. Writers fill folders of their own. One
that finds its number taken looks at what came between: if the buckets differ, its
files stand as they are; if not, it merges its batch again over the new state. An
entry remembers the last batch of each source, so that a batch which is delivered
again is recognised.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from provgraph import shared

AXES = ("valid_to", "system_from", "system_to")
#: Buckets of a new table.
BUCKETS = 32
#: Deltas of a bucket, or their share of the base's bytes (once they are worth it), beyond which it is written anew.
DELTAS, SHARE, LEAST_BYTES = 8, 0.5, 4 << 20
#: The number of the write that states a row of a bucket's open versions, 0 for its base.
STATED = "__stated"
#: Commits that are tried against other writers.
ATTEMPTS = 50


def with_axes(records: DataFrame, at: datetime) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    return records.withColumns({"valid_to": none, "system_from": F.lit(at).cast("timestamp"), "system_to": none})


def _outcome(columns: list[str], payload: list[str], at: datetime) -> tuple[Column, Column]:
    """(whether an id changes, its versions afterwards) of a row with `versions`, the open ones, and `fresh`, the batch's record as a version; either may be null."""
    now = F.lit(at).cast("timestamp")
    came = F.col("fresh")["valid_from"]

    def says_so(v: Column) -> Column:
        # In force, with the same payload, and begun no later.
        equal = F.struct(*[v[c] for c in payload]).eqNullSafe(F.struct(*[F.col("fresh")[c] for c in payload]))
        return v["valid_to"].isNull() & equal & F.coalesce(v["valid_from"] <= came, v["valid_from"].isNull())

    def restated(v: Column, **changed: Column) -> Column:
        return F.struct(*[changed.get(c, v[c]).alias(c) for c in columns])

    # A version that ended before the new one begins isn't touched.
    over = lambda v: F.coalesce(v["valid_to"] <= came, F.lit(False))
    held = F.coalesce("versions", F.array())
    stay = F.filter(held, over)
    ended = F.transform(F.filter(held, lambda v: ~over(v)), lambda v: restated(v, system_to=now))
    before = F.transform(F.filter(held, lambda v: ~over(v) & F.coalesce(v["valid_from"] < came, F.lit(False))), lambda v: restated(v, valid_to=came, system_from=now))
    changes = F.col("fresh").isNotNull() & ~F.exists(held, says_so)
    return changes, F.concat(stay, ended, before, F.array("fresh"))


def _grouped(versions: DataFrame, columns: list[str]) -> DataFrame:
    """An id's open versions in one row; they are few, one for each time at which what is known of it changed. Of rows with a STATED number only those of the last count."""
    if STATED not in versions.columns:
        return versions.groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("versions"))
    every = versions.groupBy("id").agg(F.collect_list(F.struct(STATED, *columns)).alias("every"), F.max(STATED).alias("last"))
    last = F.filter("every", lambda v: v[STATED] == F.col("last"))
    return every.select("id", F.transform(last, lambda v: F.struct(*[v[c].alias(c) for c in columns])).alias("versions"))


def changes(current: DataFrame | None, batch: DataFrame, at: datetime) -> DataFrame:
    """Versions of the ids that a batch changes: those it closes, and all that are open afterwards. Ids are unique within it.

    Only rows of the batch's ids are moved, once. `current` are open versions; rows
    that later ones replace may be among them, if STATED numbers tell which are the last."""
    fresh = with_axes(batch, at)
    if current is None:
        return fresh
    columns, payload = fresh.columns, [c for c in batch.columns if c not in ("id", "valid_from", "ord")]
    touched = current.select(*columns, *[c for c in current.columns if c == STATED]).join(batch.select("id"), "id", "left_semi")
    both = fresh.select("id", F.struct(*columns).alias("fresh")).join(_grouped(touched, columns), "id", "left")
    changed, after = _outcome(columns, payload, at)
    return both.where(changed).select(F.explode(after).alias("v")).select("v.*")


def upsert(store: DataFrame | None, batch: DataFrame, at: datetime) -> DataFrame:
    """All versions after the batch, in one pass: a full outer join on the id."""
    fresh = with_axes(batch, at)
    if store is None:
        return fresh
    columns, payload = fresh.columns, [c for c in batch.columns if c not in ("id", "valid_from", "ord")]
    incoming = fresh.select("id", F.struct(*columns).alias("fresh"))
    both = _grouped(store.where("system_to IS NULL").select(*columns), columns).join(incoming, "id", "full")
    changed, after = _outcome(columns, payload, at)
    current = both.select(F.explode(F.when(changed, after).otherwise(F.col("versions"))).alias("v")).select("v.*")
    return store.where("system_to IS NOT NULL").select(*columns).unionByName(current)


@dataclass
class State:
    """What an entry of the log says: the files of each table's buckets (base first), the last batch of each source, and its time in microseconds."""

    number: int = 0
    at: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)

    def buckets(self, table: str) -> dict[str, list[dict]]:
        return self.tables.get(table, {}).get("buckets", {})


_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def _micros(at: datetime) -> int:
    return (at.replace(tzinfo=at.tzinfo or UTC) - _EPOCH) // timedelta(microseconds=1)


def _later(state: State, at: datetime) -> datetime:
    """The write's system time: after that of the commit in force, or a version would begin and end at one instant, which no reader could name."""
    return max(at.replace(tzinfo=at.tzinfo or UTC), _EPOCH + timedelta(microseconds=state.at + 1)) if state.number else at


class Conflict(RuntimeError):
    """Another writer took the number."""


class Store:
    """Nodes and edges of named graphs under one folder, any that Spark can write."""

    def __init__(self, spark: SparkSession, path: str, graph: str = "", buckets: int = BUCKETS):
        if graph.startswith("__"):
            raise ValueError("names of graphs mustn't start with __")
        self.spark, self.path, self.graph, self.n_buckets = spark, path.rstrip("/"), graph or "default", buckets

    # --- files ---------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    @property
    def _base(self) -> str:
        return f"{self.path}/graph={self.graph}"

    def _listed(self, path: str) -> list:
        fs, p = self._fs(path)
        return list(fs.listStatus(p)) if fs.exists(p) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n) for s in self._listed(f"{self._base}/log") if (n := s.getPath().getName()).isdigit())

    def _entry(self, number: int) -> State:
        # Entries are small, whole when they appear, and never change.
        text = self.spark.read.text(f"{self._base}/log/{number:020d}", wholetext=True).first()[0]
        return State(**json.loads(text))

    def state(self, number: int | None = None) -> State:
        """What is in force (or was, at that number)."""
        numbers = self._numbers()
        if number is not None and number not in numbers and number != 0:
            raise ValueError(f"no commit {number}")
        last = max(numbers, default=0) if number is None else number
        return self._entry(last) if last else State()

    def current(self) -> int:
        """Number of the commit in force, 0 for none."""
        return max(self._numbers(), default=0)

    def _claim(self, number: int, state: State) -> None:
        """Make the entry visible, whole, under its number; fails if that is taken."""
        fs, folder = self._fs(f"{self._base}/log")
        fs.mkdirs(folder)
        _, draft = self._fs(f"{self._base}/log/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(vars(state)).encode()))
        out.close()
        _, entry = self._fs(f"{self._base}/log/{number:020d}")
        jvm = self.spark._jvm
        try:
            if fs.getScheme() == "file":
                # Local disks replace what a rename meets; a link never does.
                at = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (entry, draft)]
                jvm.java.nio.file.Files.createLink(*at)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), self.spark._jsc.hadoopConfiguration())
                rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                context.rename(draft, entry, self.spark.sparkContext._gateway.new_array(rename, 0))
        except Exception as error:
            if fs.exists(entry):
                raise Conflict(number) from error
            raise
        finally:
            fs.delete(draft, False)

    # --- reading -------------------------------------------------------------

    def _files(self, table: str, schema: StructType, files: list[tuple[str, dict]], closed: bool) -> DataFrame | None:
        """Rows of some buckets' files, with their bucket and the folder of their write."""
        kind = "closed" if closed else "open"
        paths = [f"{self._base}/{table}/write={f['write']}/bucket={b}/kind={kind}" for b, f in files if kind in f["kinds"]]
        if not paths:
            return None
        full = StructType([*schema.fields, *StructType.fromDDL("write string, bucket int, kind string").fields])
        return self.spark.read.schema(full).option("basePath", f"{self._base}/{table}").parquet(*paths)

    def _open(self, state: State, table: str, buckets: list[str]) -> DataFrame | None:
        """Open versions of some buckets."""
        schema = StructType.fromJson(state.tables[table]["schema"])
        held = {b: state.buckets(table).get(b, []) for b in buckets}
        base = self._files(table, schema, [(b, f) for b, files in held.items() for f in files[:1]], False)
        later = [(b, f) for b, files in held.items() for f in files[1:]]
        columns = schema.fieldNames()
        delta = self._files(table, schema, later, False)
        if delta is None:
            return base if base is None else base.select(*columns)
        order = {f["write"]: f["number"] for _, f in later}
        number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("write")]
        if max(len(files) for files in held.values()) > 2:
            last = delta.groupBy("id").agg(F.max(number).alias("last"))
            delta = delta.withColumn("number", number).join(last, "id").where("number = last")
        if base is None:
            return delta.select(*columns)
        return base.join(delta.select("id"), "id", "left_anti").select(*columns).unionByName(delta.select(*columns))

    def _stated(self, state: State, table: str, buckets: list[str]) -> DataFrame | None:
        """Rows of some buckets' bases and deltas as they lie, with the number of their write where there are deltas: `changes` tells the last of an id as it groups them, without a join."""
        schema = StructType.fromJson(state.tables[table]["schema"])
        held = [(b, f, i) for b in buckets for i, f in enumerate(state.buckets(table).get(b, []))]
        base = self._files(table, schema, [(b, f) for b, f, i in held if not i], False)
        delta = self._files(table, schema, [(b, f) for b, f, i in held if i], False)
        if delta is None:
            return base if base is None else base.select(*schema.fieldNames())
        order = {f["write"]: f["number"] for _, f, i in held if i}
        number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])[F.col("write")]
        later = delta.select(*schema.fieldNames(), number.cast("long").alias(STATED))
        return later if base is None else base.select(*schema.fieldNames(), F.lit(0).cast("long").alias(STATED)).unionByName(later)

    def read(self, table: str, number: int | None = None, history: bool = True) -> DataFrame | None:
        """All versions (or the open ones) as the commit in force, or an earlier one, left them."""
        return self._read(self.state(number), table, history)

    def _read(self, state: State, table: str, history: bool = True) -> DataFrame | None:
        if table not in state.tables:
            return None
        buckets = state.buckets(table)
        current = self._open(state, table, list(buckets))
        schema = StructType.fromJson(state.tables[table]["schema"])
        closed = self._files(table, schema, [(b, f) for b, files in buckets.items() for f in files], True) if history else None
        parts = [p.select(*schema.fieldNames()) for p in (current, closed) if p is not None]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # --- writing -------------------------------------------------------------

    def _bucket(self, state: State, table: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(state.tables.get(table, {}).get("n", self.n_buckets))).cast("int")

    def _written(self, table: str, rows: DataFrame, state: State) -> dict[str, dict]:
        """Write versions to a folder of this write's own: bucket -> its write, kinds and bytes."""
        write = uuid.uuid4().hex
        folder = f"{self._base}/{table}/write={write}"
        dealt = rows.withColumns({"bucket": self._bucket(state, table), "kind": F.when(F.col("system_to").isNull(), "open").otherwise("closed")})
        # In order of labels, which pattern queries prune on.
        order = ["label"] if "label" in rows.columns else ["labels"] if "labels" in rows.columns else []
        dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", "kind", *order, "id").write.option("compression", shared.COMPRESSION).partitionBy("bucket", "kind").parquet(folder)
        found = {}
        for b in self._listed(folder):
            if b.getPath().getName().startswith("bucket="):
                kinds = self._listed(b.getPath().toString())
                size = sum(f.getLen() for k in kinds for f in self._listed(k.getPath().toString()))
                found[b.getPath().getName().removeprefix("bucket=")] = {"write": write, "kinds": [k.getPath().getName().removeprefix("kind=") for k in kinds], "bytes": size}
        return found

    def _merged(self, state: State, batches: dict[str, DataFrame], at: datetime) -> dict[str, dict]:
        """Files that the batches add to the state: table -> schema, number of buckets, deltas and new bases by bucket."""
        found = {}
        for table, batch in batches.items():
            known = StructType.fromJson(state.tables[table]["schema"]).fieldNames() if table in state.tables else None
            if known and known != [*batch.columns, *AXES]:
                raise ValueError(f"columns of {table} are {known}, not {[*batch.columns, *AXES]}")
            held = state.buckets(table)
            # A table that holds nothing takes all of the batch; which buckets it falls in shows when it is written.
            touched = [str(r[0]) for r in batch.select(self._bucket(state, table)).distinct().collect()] if held else None
            there = [b for b in touched or () if b in held]
            after = changes(self._stated(state, table, there) if there else None, batch, at)
            delta = self._written(table, after, state)
            touched = list(delta) if touched is None else touched
            worn = [b for b in delta if (files := held.get(b)) and (len(files) > DELTAS or sum(f["bytes"] for f in [*files[1:], delta[b]]) > max(LEAST_BYTES, SHARE * files[0]["bytes"]))]
            found[table] = {"schema": after.schema.jsonValue(), "n": state.tables.get(table, {}).get("n", self.n_buckets), "delta": delta, "worn": worn, "read": touched}
        return found

    def _after(self, state: State, added: dict[str, dict], at: datetime) -> State:
        number = state.number + 1
        tables = dict(state.tables)
        for table, new in added.items():
            buckets = dict(state.buckets(table))
            for b, files in new["delta"].items():
                buckets[b] = [*buckets.get(b, []), files | {"number": number}]
            tables[table] = {"schema": tables.get(table, new)["schema"], "n": new["n"], "buckets": buckets}
        return State(number, _micros(at), tables, dict(state.sources))

    def write(self, batches: dict[str, DataFrame], at: datetime, source: str | None = None, batch: int = 0) -> int:
        """Upsert batches of tables in one commit and return its number.

        A batch of a source that the log already holds (its number isn't above
        the last one) changes nothing. What a writer lost in the midst has
        written is in no entry, and so is not there.
        """
        state = self.state()
        added = None
        for _ in range(ATTEMPTS):
            if source is not None and state.sources.get(source, -1) >= batch:
                self._dropped(added)
                return state.number
            added = self._merged(state, batches, _later(state, at)) if added is None else added
            if source is None and not any(new["delta"] for new in added.values()) and all(t in state.tables for t in added):
                return state.number
            after = self._after(state, added, _later(state, at))
            if source is not None:
                after.sources[source] = batch
            try:
                self._claim(after.number, after)
            except Conflict:
                newest = self.state()
                if self._overlap(state, newest, added):
                    self._dropped(added)
                    added = None
                state = newest
                continue
            if worn := {t: new["worn"] for t, new in added.items() if new["worn"]}:
                self.compact(worn)
            return after.number
        raise Conflict(f"{ATTEMPTS} commits met other writers")

    @staticmethod
    def _overlap(before: State, now: State, added: dict[str, dict]) -> bool:
        """Whether buckets that a merge has read have changed since, or a table of it was made by another writer."""
        return any(now.buckets(t).get(b) != before.buckets(t).get(b) for t, new in added.items() for b in new["read"]) or any(now.tables.get(t, {}).get("n", new["n"]) != new["n"] for t, new in added.items())

    def _dropped(self, added: dict[str, dict] | None) -> None:
        for table, new in (added or {}).items():
            for write in {f["write"] for f in new["delta"].values()}:
                fs, folder = self._fs(f"{self._base}/{table}/write={write}")
                fs.delete(folder, True)

    def compact(self, buckets: dict[str, list[str]] | None = None) -> int:
        """Write buckets (all that have deltas, if none are named) anew as bases; returns the number in force afterwards. It gives way to other writers of the same buckets."""
        state = self.state()
        bases = {}
        for table in buckets or state.tables:
            named = (buckets or {}).get(table) or [b for b, files in state.buckets(table).items() if len(files) > 1]
            if named:
                schema = StructType.fromJson(state.tables[table]["schema"])
                closed = self._files(table, schema, [(b, f) for b in named for f in state.buckets(table)[b]], True)
                rows = self._open(state, table, named)
                rows = rows if closed is None else rows.unionByName(closed.select(*schema.fieldNames()))
                bases[table] = {"delta": self._written(table, rows, state), "n": state.tables[table]["n"], "read": named, "schema": None}
        began = state
        for _ in range(ATTEMPTS if bases else 0):
            if self._overlap(began, state, bases):
                self._dropped(bases)
                return state.number
            tables = dict(state.tables)
            for table, new in bases.items():
                tables[table] = tables[table] | {"buckets": state.buckets(table) | {b: [f | {"number": state.number + 1}] for b, f in new["delta"].items()}}
            try:
                self._claim(state.number + 1, State(state.number + 1, state.at, tables, dict(state.sources)))
                return state.number + 1
            except Conflict:
                state = self.state()
        return state.number

    def vacuum(self, keep: int = 2, lost: datetime | None = None) -> int:
        """Remove folders of writes that only commits before the last `keep` name, and those commits; returns how many folders went.

        Readers of older commits must have ended. Folders that no commit names
        belong to writers under way or lost; with `lost`, those untouched since
        that time go too.
        """
        numbers = self._numbers()
        recent, old = numbers[-max(1, keep):], numbers[: -max(1, keep)]
        named = lambda which: {(t, f["write"]) for n in which for t, x in self._entry(n).tables.items() for files in x["buckets"].values() for f in files}
        needed, past = named(recent), named(old)
        gone = 0
        for at in self._listed(self._base):
            table = at.getPath().getName()
            for folder in self._listed(f"{self._base}/{table}") if table != "log" else ():
                key = (table, folder.getPath().getName().removeprefix("write="))
                idle = datetime.fromtimestamp(folder.getModificationTime() / 1000, UTC)
                if key not in needed and (key in past or lost is not None and idle < lost):
                    self._fs(self._base)[0].delete(folder.getPath(), True)
                    gone += 1
        for n in old:
            fs, entry = self._fs(f"{self._base}/log/{n:020d}")
            fs.delete(entry, False)
        return gone
