"""Vector code compression: a codebook for each part of the vectors, by Lloyd's rounds whose sums are maintained by changes.

Vectors become whole numbers and are cut into equal parts; each part position
has its own codebook, which starts as that part of the first vectors by id. A
round assigns every part to its nearest entry and replaces each entry by the
floor of its parts' mean. All of it is whole-number arithmetic, so results
don't depend on the order or number of tasks.

A round is one pass over the stored state (vector, code): tasks compare the new
assignment with the one stored before and add up plus and minus contributions of
the parts that moved; only these sums (a row for each batch, part, entry and
component that changed) are shuffled, added, and applied to running sums and
counts at the driver, whose size is that of the codebooks. The state is written
for the next round before the older one is removed: a lost executor repeats tasks,
never a round.

Defined results: vectors that are null or hold null or non-finite components are
dropped; fewer kept rows than entries give as many entries; the first vectors are
those of the smallest ids, nulls last, of one id by their components; vectors of
unequal lengths count as filled up with zeros to the longest, and to a multiple of
the number of parts; scaled components are held to vectors.MOST either way. Repeated
rows are rows like any other; other columns are ignored. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from provgraph.llm.common import removed, stored_at
from provgraph.llm.vectors import VECTOR_ROWS, floors, matrix, products, whole

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

MOVES = "moves array<struct<part:int,entry:int,n:bigint,sums:array<bigint>>>"


@dataclass(frozen=True)
class Codebooks:
    """`entries[part, entry]` are the whole-number components of an entry; vectors are scaled by `scale`."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def width(self) -> int:
        """Components of a whole vector."""
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances) of each row's parts; ties go to the lower index."""
        n, (parts, _, width) = len(vectors), self.entries.shape
        codes, errors = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
        for p in range(parts):
            x, c = vectors[:, p * width : (p + 1) * width], self.entries[p]
            # |x - c|^2 less |x|^2, which all entries share.
            d = (c * c).sum(1) - 2 * products(x, c)
            best = d.argmin(1) if n else np.zeros(0, np.int64)
            codes[:, p], errors[:, p] = best, d[np.arange(n), best] + (x * x).sum(1)
        return codes, errors

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        return (self.entries[np.arange(len(self.entries)), list(bytes.fromhex(code))] / self.scale).ravel().tolist()


def contributions(vectors: np.ndarray, before: np.ndarray | None, after: np.ndarray, entries: int) -> list[dict]:
    """What the parts that moved add to the entries they came to and take from those they left."""
    found = []
    width = vectors.shape[1] // after.shape[1]
    for p in range(after.shape[1]):
        moved = np.ones(len(after), bool) if before is None else before[:, p] != after[:, p]
        x = vectors[moved, p * width : (p + 1) * width]
        sums, n = np.zeros((entries, width), np.int64), np.zeros(entries, np.int64)
        np.add.at(sums, after[moved, p], x)
        n += np.bincount(after[moved, p], minlength=entries)
        if before is not None:
            np.subtract.at(sums, before[moved, p], x)
            n -= np.bincount(before[moved, p], minlength=entries)
        found += [{"part": p, "entry": e, "n": int(n[e]), "sums": sums[e].tolist()} for e in range(entries) if n[e] or sums[e].any()]
    return found


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """`state` with new codes, and in the first row of each batch what its parts' moves add and take."""
    schema = StructType([*[f for f in state.schema.fields if f.name != "moves"], *StructType.fromDDL(MOVES).fields])
    types = to_arrow_schema(schema)
    parts, entries, _ = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"), books.width)
            old = batch.column("code")
            before = None if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(-1, parts)
            codes, _ = books.assign(x)
            made = {"code": [c.tobytes() for c in codes], "moves": [contributions(x, before, codes, entries), *[None] * (len(x) - 1)]}
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name) for f in types], schema=types)

    return state.mapInArrow(run, schema)


def _changes(state: DataFrame) -> list[Row]:
    """Contributions of all batches, added up: a row for each entry and component that changed."""
    each = state.where("moves IS NOT NULL").select(F.explode("moves").alias("m")).select("m.part", "m.entry", "m.n", F.posexplode("m.sums").alias("at", "s"))
    return each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Codebooks | None, DataFrame, str]:
    """(codebooks, state, its path) of rows with vec_id, label and v (whole numbers); no codebooks if there are no rows."""
    spark = rows.sparkSession
    state, path = stored_at(rows.withColumn("code", F.lit(None).cast("binary")), "vectors")
    longest = state.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None, state, path
    width = max(1, -(-longest // parts))
    first = state.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r["v"])] = r["v"]
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
    for _ in range(rounds):
        after, at = stored_at(_assigned(state, Codebooks(books, scale)), "vectors")
        for r in _changes(after):
            sums[r["part"], r["entry"], r["at"]] += r["s"]
            if r["at"] == 0:
                counts[r["part"], r["entry"]] += r["n"]
        removed(spark, path)
        state, path = after, at
        used = counts[..., None]
        books = np.where(used > 0, sums // np.maximum(used, 1), books)
    return Codebooks(books, scale), state, path


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Rows with vec_id, label and v as vec_id, label, code (two hex digits a part) and error."""
    schema = StructType([*[rows.schema[c] for c in ("vec_id", "label")], *StructType.fromDDL("code string, error long").fields])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.assign(matrix(batch.column("v"), books.width))
            made = [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors.sum(1), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *made], schema=types)

    return rows.select("vec_id", "label", "v").mapInArrow(run, schema)


def vector_codes(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256, one row for each vector that is kept."""
    spark = table.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(VECTOR_ROWS))
    rows = table.where(whole(vector)).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), floors(vector, scale).alias("v"))
    books, state, path = train(rows, parts, entries, rounds, scale)
    if books is None:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))]
        return state.select("vec_id", *none)
    found, _ = stored_at(encoded(state, books), "codes")
    removed(spark, path)
    # Stored, so that a label with a third of the rows meets its sum in a join that Spark can split, or broadcast if it proves small.
    totals, _ = stored_at(found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "errors")
    return found.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same for vectors of one length that the number of parts divides: one round after the other, all distances each time."""

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) * {entries} + e) AS m
  FROM parts JOIN b{k} USING (p) GROUP BY r, p
)"""

    steps = []
    for k in range(rounds):
        steps += [assigned(k), f"""s{k} AS (
  SELECT p, e, list(floor(total / n) ORDER BY j) AS c
  FROM (SELECT p, m % {entries} AS e, j, sum(x[j]) AS total, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS j) GROUP BY ALL) GROUP BY p, e
)""", f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(s{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN s{k} USING (p, e))"]  # fmt: skip
    return f"""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v, row_number() OVER (ORDER BY vec_id) AS r
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS p)
), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries}),
{", ".join(steps)}, {assigned(rounds)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM a{rounds} JOIN kept USING (r) GROUP BY r, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded"""
