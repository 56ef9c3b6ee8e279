"""Logs that are tailed: a stream of new files, and each channel's cursor as state of the stream.

Streamed files become events with their line positions, the state store holds the (instant, sequence) cursor of each
channel, and every batch of events leaves it as fresh or late. Rows of a channel meet in one task, one at a time: what is
held is the cursor. Fresh rows become a part of the sharded log under the batch's number, so a batch that is run again
after a failure finds its part there.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from chronolith.functions import time
from chronolith.sources import readers, versions
from chronolith.streaming.incremental import _name, by_shard

#: The state store that holds state by key: fixed.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a line of a channel log must be, for the schema check.
REQUIRED = ("timestamp",)


class Cursors(StatefulProcessor):
    """Tells rows behind their channel's cursor from those that come late, and moves the cursor on when the batch has ended."""

    def __init__(self, default_us: int):
        self.default_us = default_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", "us long, seq long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = tuple(self.cursor.get()) if self.cursor.exists() else None
        last = known
        for row in rows:
            at = None if row["us"] is None or row["seq"] is None else (row["us"], row["seq"])
            fresh = at is not None and (at > known if known else at[0] > self.default_us)
            if fresh and (last is None or at > last):
                last = at
            yield Row(**row.asDict(), late=not fresh)
        if last is not None and last != known:
            self.cursor.update(last)

    def close(self) -> None:
        pass


def judged(events: DataFrame, default_us: int = time.CUTOVER_US) -> DataFrame:
    """A stream of events (channel, us, seq, ...) with late: at or before the cursor that their channel had before the batch
    (without one: the default instant), or without an instant or sequence."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    schema = StructType([*events.schema.fields, StructField("late", BooleanType())])
    return events.groupBy("channel").transformWithState(Cursors(default_us), schema, "Append", "None")


def index(events: DataFrame, shards: str, late: str, checkpoint: str, default_us: int = time.CUTOVER_US, at_once: bool = True) -> StreamingQuery:
    """Appends a stream's fresh events to the day shards and the others to late, both versioned tables by batch."""

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            fresh = batch.where("NOT late").drop("late").withColumn("local_day", time.local_day(F.col("us"), time.LOCAL_ZONE))
            versions.add(fresh, shards, _name(number), by_shard)
            versions.add(batch.where("late").drop("late"), late, _name(number))
        finally:
            batch.unpersist()

    out = judged(events, default_us).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if at_once else out).start()


def channel_log(spark: SparkSession, path: str, pattern: str = "*.jsonl", cutover_us: int = time.CUTOVER_US, files_at_once: int | None = None) -> DataFrame:
    """A stream of the channel logs below path (a folder for each channel): channel, us, seq, text, name and line_no of the
    lines of new files. A file is read once, as a row of the stream, when it has its name; files must therefore be
    complete when they appear, and fit in a task.

    seq orders the lines of one instant by file name and line. A line that isn't an object with a timestamp is an error
    that names its place: the schema of a log must not change unseen."""
    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    reader = reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader
    files = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value")
    lines = files.select("path", "name", F.posexplode(F.split("value", "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]")).alias("at", "value"))
    lines = lines.where(F.trim("value") != "").withColumn("line_no", (F.col("at") + 1).cast("long"))
    place = F.concat(F.col("path"), F.lit(", line "), F.col("line_no").cast("string"))
    lines = lines.withColumn("doc", readers.parsed(F.trim("value"), place))
    checked = readers.is_object(F.col("doc"))
    for field in REQUIRED:
        checked &= F.try_variant_get("doc", f"$.{field}", "variant").isNotNull()
    lines = lines.where(F.when(checked, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not a line of a channel log: "), place)).cast("boolean")))
    us = time.seconds_to_micros(readers.number(F.col("doc"), "$.timestamp"))
    # Files of a channel are named in the order of time; of 63 bits the line has 31.
    number = F.coalesce(F.regexp_extract("name", r"(\d+)\D*$", 1).try_cast("long"), F.lit(0))
    seq = number.bitwiseAND(F.lit((1 << 32) - 1)) * F.lit(1 << 31) + F.col("line_no")
    rows = lines.select(F.element_at(F.split("path", "/"), -2).alias("channel"), us.alias("us"), seq.alias("seq"), F.coalesce(readers.string(F.col("doc"), "$.text"), F.lit("")).alias("text"), "name", "line_no")
    return rows.where(F.col("us") >= cutover_us)
