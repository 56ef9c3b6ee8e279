"""Writers: day shards, JSON lines with sorted keys, single documents, reports; and results that are kept while a job runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import time
from chronolith.sources import versions


def day_shards(events: DataFrame, path: str, zone: str = time.LOCAL_ZONE, mode: str = "append") -> None:
    """events (us, channel, ...) appended to a table that is partitioned by channel and local day; nothing is read back."""
    rows = events.withColumn("local_day", time.local_day(F.col("us"), zone))
    rows.repartition("channel", "local_day").sortWithinPartitions("us").write.mode(mode).partitionBy("channel", "local_day").parquet(path)


def empty_shards(events: DataFrame, path: str) -> None:
    """The empty table that shards are appended to."""
    events.limit(0).withColumn("local_day", F.lit("")).drop("channel", "local_day").write.mode("ignore").parquet(f"{path}/_schema")


def sorted_json(rows: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One object a line, keys sorted, and the folder that holds them: mode append adds to the ledger at path, overwrite makes
    a new version of the table there, and what was there stays until that is complete."""
    rows = rows.select(*sorted(rows.columns))
    write = lambda df, to: df.write.mode("append").option("ignoreNullFields", False).json(to)
    if mode == "append":
        write(rows, path)
        return path
    versions.replace(rows, path, write=write)
    return versions.folders(rows.sparkSession, path)[0]


def text_lines(rows: DataFrame, column: str, path: str, *order: str) -> str:
    """The column's lines as one ordered text (reports and training rows), and the folder that holds them: a new version of
    the text at path. Ranges of the order are written in turn."""
    ordered = rows.orderBy(*order) if order else rows
    versions.replace(ordered.select(F.col(column).cast("string").alias("value")), path, write=lambda df, to: df.write.text(to))
    return versions.folders(rows.sparkSession, path)[0]


def table(rows: DataFrame, path: str) -> DataFrame:
    """rows in place of what was there, nothing if there are none: a stale result never stays, and if the job fails what was
    there does. The rows as they are stored now."""
    return versions.read(rows.sparkSession, path, versions.replace(rows, path))


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: the one that spark.checkpoint.dir names. In local mode, where there
    is but one machine, one of our own will do."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def stored(rows: DataFrame, name: str = "rows") -> DataFrame:
    """rows, computed once, as a Parquet table in the shared folder: what reads them later sees the same rows."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
