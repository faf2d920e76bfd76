"""Exact top-k search by inner product, block at a time.

Vectors become whole numbers, components are the terms. Rows are sorted by id and
cut into blocks (document ranges): a block holds its rows' components (its
forward index) and the largest and smallest value of every component. The sum of
a query's largest possible products with these is a bound on its score with any
row of the block.

1. Blocks are stored once. Each query is scored against the blocks that lie beside
   its own in one Arrow batch, which needs no shuffle; its k-th best score there is
   a first lower limit.
2. Batches of queries meet packs of block summaries; a block goes on to a batch only
   if the bound of some query reaches that query's limit.
3. Blocks that are left are brought to the batch, pack by pack. Each query takes
   them from the highest bound down, until the next bound falls below its k-th best
   score; queries that take the same block in one step are one matrix product.
4. The k best of every pack meet in one ranking for each query, cut down to k rows a
   query before the shuffle.

No row is passed over that could be among the k best (a bound equal to the k-th
score still counts, because of ties), so the result is exact. Where bounds never
fall below the k-th score, as with components that are all alike in every block,
every block is scored: then the work is that of all products, in blocks.

Defined results: vectors that are null or hold null or non-finite components take no
part; of vectors of unequal lengths the missing components count as zero; scaled
components are held to vectors.MOST either way. A row is a query if `chosen` says so
(a null id chooses nothing); it is no candidate of its own, but rows that repeat its
id or vector are. Candidates without an id come last among ties and have a null
vec_id. Fewer candidates than k give as many rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provgraph.llm.common import removed, stored_at
from provgraph.llm.vectors import VECTOR_ROWS, floors, matrix, products, whole

SCALE, K = 256, 5
#: Rows of a block, and components that it holds at most (unless one row has more).
ROWS, CELLS = 128, 1 << 18
#: Blocks of a pack, queries of a batch (on average).
PACK, BATCH = 64, 512
#: Stands for no score, and for the id of a row without one.
LOWEST, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max

BLOCKS = "block long, width int, ids binary, chosen array<boolean>, v binary, high binary, low binary"
QUERIES = "query_id long, block long, place int, width int, v binary, least long"


class Best:
    """The k best (score, id) of each of n queries: higher scores first, of equal ones the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((n, k), LOWEST), np.full((n, k), NO_ID)

    def take(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, least: np.ndarray) -> None:
        """Scores of the given queries (no query twice) with rows of these ids; those below a query's `least` can't matter."""
        q, c = np.nonzero((scores >= np.maximum(least, self.scores[queries, -1])[:, None]) & (scores > LOWEST))
        if not len(q):
            return
        some = np.unique(q)
        old = queries[some]
        owner = np.concatenate([q, np.repeat(some, self.k)])
        score = np.concatenate([scores[q, c], self.scores[old].ravel()])
        number = np.concatenate([ids[c], self.ids[old].ravel()])
        order = np.lexsort((number, ~score, owner))
        owner, score, number = owner[order], score[order], number[order]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        kept = first[:, None] + np.arange(self.k)
        self.scores[old], self.ids[old] = score[kept], number[kept]


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The largest inner product that each query could have with a row of each block."""
    w = min(queries.shape[1], high.shape[1])
    q = queries[:, :w]
    return products(np.maximum(q, 0), high[:, :w]) + products(np.minimum(q, 0), low[:, :w])


def scores_of(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    w = min(queries.shape[1], rows.shape[1])
    return products(queries[:, :w], rows[:, :w])


def visit(queries: np.ndarray, own: list[tuple[int, int]], least: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], blocks: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> tuple[Best, int]:
    """The best rows of `blocks` (number, ids, components) for each query, and how many (query, block) pairs were scored.

    `pairs` are (query, place in blocks, bound); `own` is the block and place of each query's own row.
    """
    best, scored = Best(len(queries), k), 0
    order = np.lexsort((pairs[1], ~pairs[2], pairs[0]))
    query, block, bound = (x[order] for x in pairs)
    at = np.searchsorted(query, np.arange(len(queries)))
    end = np.searchsorted(query, np.arange(len(queries)), side="right")
    active = np.flatnonzero(at < end)
    while len(active):
        active = active[bound[at[active]] >= np.maximum(least, best.scores[:, -1])[active]]
        now = block[at[active]]
        for b in np.unique(now):
            some = active[now == b]
            number, ids, rows = blocks[b]
            found = scores_of(queries[some], rows)
            for i, q in enumerate(some):
                if own[q][0] == number:
                    found[i, own[q][1]] = LOWEST
            best.take(some, found, ids, least[some])
            scored += len(some)
        at[active] += 1
        active = active[at[active] < end[active]]
    return best, scored


def _bytes(numbers: np.ndarray, kind: type = np.int32) -> bytes:
    return numbers.astype(kind).tobytes()


def _numbers(data: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(data, kind).astype(np.int64)


def _filled(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of unequal lengths, filled up with zeros."""
    found = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        found[i, : len(r)] = r
    return found


def blocked(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, chosen, v), sorted by id, as blocks; the ends of a row's vector don't reach into another's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            step = max(1, min(ROWS, CELLS // max(1, int(sizes.max(initial=0)))))
            out = []
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = matrix(part.column("v"), int(sizes[start : start + step].max()))
                ids = part.column("vec_id").fill_null(NO_ID).to_numpy()
                out.append((number, x.shape[1], _bytes(ids, np.int64), part.column("chosen").to_pylist(), _bytes(x), _bytes(x.max(0)), _bytes(x.min(0))))
                number += 1
            if out:
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one id are spread by their vectors.
    spread = rows.repartitionByRange(partitions, "vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id", "v")
    return spread.mapInArrow(run, BLOCKS)


def _known(number: int) -> int | None:
    return None if number == NO_ID else int(number)


def _block(row: dict) -> tuple[int, np.ndarray, np.ndarray]:
    ids = _numbers(row["ids"], np.int64)
    return row["block"], ids, _numbers(row["v"]).reshape(len(ids), row["width"])


def queries_of(blocks: DataFrame, k: int) -> DataFrame:
    """Chosen rows with their vector, and their k-th best score among the blocks of the same Arrow batch (the lowest number if there are fewer rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            held = [_block(r) for r in rows]
            found = [(i, p) for i, r in enumerate(rows) for p, c in enumerate(r["chosen"]) if c]
            for start in range(0, len(found), BATCH):
                some = found[start : start + BATCH]
                x = _filled([held[i][2][p] for i, p in some])
                best, every, none = Best(len(some), k), np.arange(len(some)), np.full(len(some), LOWEST)
                for i, (_, ids, v) in enumerate(held):
                    score = scores_of(x, v)
                    for q, (own, p) in enumerate(some):
                        if own == i:
                            score[q, p] = LOWEST
                    best.take(every, score, ids, none)
                columns = [[_known(held[i][1][p]) for i, p in some], [held[i][0] for i, _ in some], [p for _, p in some], [x.shape[1]] * len(some), [_bytes(v) for v in x], best.scores[:, -1]]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in QUERIES.split(", ")])

    return blocks.mapInArrow(run, QUERIES)


def _left(queries: DataFrame, blocks: DataFrame, n_queries: int, n_blocks: int) -> DataFrame:
    """(batch, pack, block, picks, bounds, queries): blocks that some queries of a batch still have to see; the first row of a batch and pack has the batch's queries."""
    batches, packs = -(-n_queries // BATCH), -(-n_blocks // PACK)
    batch = F.pmod(F.xxhash64("block", "place"), F.lit(batches)).alias("batch")
    packed = queries.select(batch, F.struct(*queries.columns).alias("q")).groupBy("batch").agg(F.collect_list("q").alias("queries"))
    dealt = packed.withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(packs - 1).cast("long"))))
    summary = F.struct("block", "high", "low")
    summaries = blocks.select(F.pmod(F.xxhash64("block"), F.lit(packs)).alias("pack"), summary.alias("s")).groupBy("pack").agg(F.collect_list("s").alias("blocks"))
    made = f"batch long, pack long, block long, picks binary, bounds binary, queries {packed.schema['queries'].dataType.simpleString()}"

    def run(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            for at in range(group.num_rows):
                row = group.slice(at, 1)
                asked, held = row.column("queries")[0].as_py(), row.column("blocks")[0].as_py()
                x, least = _filled([_numbers(q["v"]) for q in asked]), np.array([q["least"] for q in asked])
                bound = bounds(x, _filled([_numbers(b["high"]) for b in held]), _filled([_numbers(b["low"]) for b in held]))
                out = []
                for b in range(len(held)):
                    picks = np.flatnonzero(bound[:, b] >= least)
                    if len(picks):
                        out.append((held[b]["block"], _bytes(picks), _bytes(bound[picks, b], np.int64)))
                if out:
                    columns = [[row.column(c)[0].as_py()] * len(out) for c in ("batch", "pack")]
                    columns += [*zip(*out, strict=True), [asked, *[None] * (len(out) - 1)]]
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), group.schema.field("queries").type]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["batch", "pack", "block", "picks", "bounds", "queries"])

    return dealt.join(summaries, "pack").select("batch", "pack", "queries", "blocks").mapInArrow(run, made)


def _found(left: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(block, place, query_id, vec_id, score): the k best rows of each pack for each query."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = next(q for q in pdf["queries"] if q is not None)
        x = _filled([_numbers(q["v"]) for q in asked])
        held = [_block(r) for r in pdf[["block", "ids", "v", "width"]].to_dict("records")]
        picks = [_numbers(p) for p in pdf["picks"]]
        place = np.repeat(np.arange(len(held)), [len(p) for p in picks])
        own = [(q["block"], q["place"]) for q in asked]
        least = np.array([q["least"] for q in asked], np.int64)
        best, _ = visit(x, own, least, (np.concatenate(picks), place, np.concatenate([_numbers(b, np.int64) for b in pdf["bounds"]])), held, k)
        q, r = np.nonzero(best.scores > LOWEST)
        ids = {"query_id": [asked[i]["query_id"] for i in q], "vec_id": [_known(i) for i in best.ids[q, r]]}
        places = {"block": [own[i][0] for i in q], "place": [own[i][1] for i in q]}
        return pd.DataFrame(places | {c: pd.array(x, "Int64") for c, x in ids.items()} | {"score": best.scores[q, r]}).astype({"block": "int64", "place": "int32"})

    brought = left.join(blocks.select("block", "ids", "v", "width"), "block")
    return brought.groupBy("batch", "pack").applyInPandas(run, "block long, place int, query_id long, vec_id long, score long")


def top_k(table: DataFrame, chosen: Column, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the highest inner product with each row that `chosen` names by its vec_id."""
    spark = table.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(VECTOR_ROWS))
    rows = table.where(whole(vector)).select(F.col(vec_id).cast("long").alias("vec_id"), floors(vector, scale).alias("v"))
    rows = rows.withColumn("chosen", F.coalesce(chosen, F.lit(False)))
    blocks, blocks_path = stored_at(blocked(rows), "blocks")
    queries, queries_path = stored_at(queries_of(blocks, k), "queries")
    left = _left(queries, blocks, max(1, queries.count()), max(1, blocks.count()))
    found, _ = stored_at(_found(left, blocks, k), "found")
    for path in (queries_path, blocks_path):
        removed(spark, path)
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM kept q JOIN kept c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}
"""
