"""Stateful de-duplication of a stream of records: what merging all of it in one batch would give, kept up to date.

The state of an id is its first payload (that of the smallest ordinal seen) and
its earliest valid time, each with the time of the batch that brought it: an
aggregation of Spark's own, in the state store, by default RocksDB, so that it
lies on disk and comes back after a lost executor. No row passes through Python.
Records may come in any order and more than once; there is no watermark, because
a late one may still lower a time. Only ids for which this batch brought a lower
ordinal or an earlier time leave, so that a repeated batch causes no writes behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Stands for a missing ordinal or time, which comes after all others.
LAST = (1 << 63) - 1


def prepare(spark: SparkSession) -> None:
    """State on disk, so that it isn't bounded by the executors' memory; copies that ended runs have left on executors go within seconds, not a minute."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "5s")


def merged_stream(records: DataFrame) -> DataFrame:
    """A stream of nodes or edges (with id, ord, valid_from and payload) as the stream of those that are new or changed, in update mode.

    Rows of one id and ordinal have one payload. Downstream, the last row of an
    id counts: `Store.write` takes each batch as it comes. A batch's time is the
    same for all of its rows, and when it is run again; should two batches share
    one, ids leave that needn't, and none is missed.
    """
    names = [f.name for f in records.schema.fields if f.name not in ("id", "ord", "valid_from", "doc")]
    order, at = F.coalesce("ord", F.lit(LAST)), F.coalesce(F.unix_micros("valid_from"), F.lit(LAST))
    rows = records.select("id", order.alias("ord"), at.alias("at"), F.struct(*names).alias("payload"), F.current_timestamp().alias("batch"))
    first = F.min_by(F.struct("payload", "ord", "batch"), F.struct("ord", "batch")).alias("first")
    held = rows.groupBy("id").agg(first, F.min(F.struct("at", "batch")).alias("early"))
    now = held.withColumn("now", F.current_timestamp()).where("first.batch = now OR early.batch = now")
    opened = {"id": F.col("id"), "ord": F.nullif(F.col("first.ord"), F.lit(LAST)), "valid_from": F.timestamp_micros(F.nullif(F.col("early.at"), F.lit(LAST)))}
    return now.select(*[opened.get(f.name, F.col(f"first.payload.{f.name}")).alias(f.name) for f in records.schema.fields if f.name != "doc"])
