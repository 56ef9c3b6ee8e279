"""Incremental indexing: cursors by channel, idempotent batches, late rows aside, as batch jobs and as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronolith.functions import time
from chronolith.operators.order import positions
from chronolith.sources import versions


def cursors(events: DataFrame) -> DataFrame:
    """channel, us and seq of the last event of each channel: a cursor orders equal instants by seq, so none is lost."""
    return events.groupBy("channel").agg(F.max(F.struct("us", "seq")).alias("last")).select("channel", "last.us", "last.seq")


def advanced(old: DataFrame, new: DataFrame) -> DataFrame:
    """The further of two cursors of each channel; channels of either stay."""
    both = old.select("channel", "us", "seq").unionByName(new.select("channel", "us", "seq"))
    return cursors(both)


def split(events: DataFrame, cursor: DataFrame, default_us: int = time.CUTOVER_US) -> tuple[DataFrame, DataFrame]:
    """events after their channel's cursor, and those that come late; without a cursor the default instant bounds."""
    c = cursor.select("channel", F.col("us").alias("_us"), F.col("seq").alias("_seq"))
    rows = events.join(c, "channel", "left")
    after = F.when(F.col("_us").isNull(), F.col("us") > default_us).otherwise(F.struct("us", "seq") > F.struct("_us", "_seq"))
    return rows.where(after).drop("_us", "_seq"), rows.where(~F.coalesce(after, F.lit(False))).drop("_us", "_seq")


def pending(events: DataFrame, cursor: DataFrame, default_us: int = time.CUTOVER_US) -> DataFrame:
    """How many events of each channel wait behind the cursor."""
    return split(events, cursor, default_us)[0].groupBy("channel").agg(F.count("*").alias("pending"))


#: Cursors of so many batches are kept; a batch that is replayed needs those of the one before it.
KEPT = 3


def _name(batch_id: int) -> str:
    return f"{batch_id:012d}"


def cursor_before(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """The cursors (channel, us, seq) that the batch before left behind; none before the first."""
    parts = versions.state(spark, state)["parts"]
    if earlier := [n for n in parts if n < _name(batch_id)]:
        return spark.read.schema(CURSOR).parquet(f"{state}/{parts[max(earlier)]['folder']}")
    return spark.createDataFrame([], CURSOR)


CURSOR = "channel string, us bigint, seq bigint"


def index_batch(events: DataFrame, shards: str, state: str, batch_id: int, late: str | None = None, default_us: int = time.CUTOVER_US, limit: int | None = None) -> None:
    """Appends what is new to the day shards (a versioned table, by batch) and moves the cursors on.

    A batch is compared with the cursors that the one before it left. It becomes part of the shards in one step, before its
    cursors are stored: one that fails leaves no rows behind, and one that is replayed finds its part there, by itself or
    in a compacted one, and changes nothing. limit keeps the first events in time.
    """
    spark = events.sparkSession
    cursor = cursor_before(spark, state, batch_id)
    fresh, behind = split(events, cursor, default_us)
    if limit is not None:
        names = fresh.columns
        fresh = positions(fresh, "us", ["channel", "seq"], "_at").where(F.col("_at") < limit).select(*names)
    fresh = fresh.persist()
    try:
        by_day = fresh.withColumn("local_day", time.local_day(F.col("us"), time.LOCAL_ZONE))
        versions.add(by_day, shards, _name(batch_id), by_shard)
        if late:
            versions.add(behind, late, _name(batch_id))
        versions.add(advanced(cursor, cursors(fresh)), state, _name(batch_id), drop=lambda n: n < _name(max(0, batch_id - KEPT + 1)))
    finally:
        fresh.unpersist()


def by_shard(rows: DataFrame, path: str) -> None:
    """rows (channel, local_day, us, ...) into a new folder, partitioned by channel and day, in the order of time."""
    rows.repartition("channel", "local_day").sortWithinPartitions("us").write.partitionBy("channel", "local_day").parquet(path)


def compact(spark: SparkSession, shards: str, most: int = 128 * 1024 * 1024) -> int:
    """Brings the small files that many batches have left together, by channel and day; see versions.compact."""
    return versions.compact(spark, shards, most, by_shard)


def index_stream(stream: DataFrame, shards: str, state: str, checkpoint: str, late: str | None = None, default_us: int = time.CUTOVER_US, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """The same as a stream of micro-batches; one that failed is replayed under its number and changes nothing twice."""

    def each(batch: DataFrame, number: int) -> None:
        index_batch(batch, shards, state, number, late, default_us)
        if then:
            then(number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(query: StreamingQuery) -> dict:
    """Rows in and rates of the last micro-batch."""
    last = query.lastProgress or {}
    return {k: last.get(k) for k in ("batchId", "numInputRows", "inputRowsPerSecond", "processedRowsPerSecond")}
