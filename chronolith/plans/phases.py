"""The engine's jobs in order: indexing of all channels, and the phases of a discovery run, whole or one by one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import time
from chronolith.operators import generate, ingest, validate
from chronolith.sources import readers
from chronolith.streaming import incremental

#: Phases of a run and what each makes, in order: setup indexes the channels and cuts the log into intervals; each interval's
#: questions; themes, combined and linked; opportunities of these, the manifest of which themes have any, and their ranking;
#: questions of the opportunities; seeds' questions, and all questions as training rows.
PHASES: dict[str, tuple[str, ...]] = {
    "setup": ("indexing", "intervals"),
    "01": ("interval_qa",),
    "02": ("themes", "combined", "links"),
    "03": ("opportunities", "manifest", "ranking"),
    "04": ("questions",),
    "05": ("seed_qa", "training_rows"),
}


def chosen(phase: str) -> list[str]:
    """The phases that a name stands for: itself, or all of them in order."""
    if phase == "all":
        return list(PHASES)
    if phase not in PHASES:
        raise ValueError(f"unknown phase {phase!r}: all, {', '.join(PHASES)}")
    return [phase]


def run(phase: str, modes: Mapping[str, Callable[[], None]], manifest: dict | None = None, dry_run: bool = False) -> dict:
    """Runs the modes of the chosen phases in order and returns the run's manifest with the state of each; with dry_run
    nothing is called. A mode that fails ends the run, and its phase is marked failed."""
    names = [m for p in chosen(phase) for m in PHASES[p]]
    if lacking := [m for m in names if m not in modes]:
        raise ValueError(f"no way to run {', '.join(lacking)}")
    for p in chosen(phase):
        for m in PHASES[p]:
            if dry_run:
                manifest = generate.manifest(manifest, m, "planned")
                continue
            try:
                modes[m]()
            except Exception:
                generate.manifest(manifest, m, "failed")
                raise
            manifest = generate.manifest(manifest, m, "done")
    return manifest or generate.manifest(None, phase, "planned" if dry_run else "done")


def bounds(fraction: float = 1.0, jobs: int = 1, batch: int = 1, pairs: int = 3, kind: str = "interval") -> None:
    """An error for options out of bounds: a share of (0, 1], at least one job and row, and pairs a call by kind."""
    least, most = {"interval": (1, validate.MOST), "seed": (validate.LEAST, validate.MOST), "threaded": (validate.THREADS * validate.LEAST, validate.MOST)}[kind]
    for ok, what in ((0 < fraction <= 1, "fraction"), (jobs > 0, "jobs"), (batch > 0, "batch"), (least <= pairs <= most, "pairs")):
        if not ok:
            raise ValueError(f"{what} is out of bounds")


def events(spark: SparkSession, logs: Mapping[str, str], transcripts: str | None = None, cutover_us: int = time.CUTOVER_US, pattern: str = "*.jsonl") -> DataFrame:
    """us, channel, text, source (JSON) and seq of the channels' raw logs (paths by channel) and of transcripts. seq tells
    events of one instant apart: a hash of what they hold."""
    found = []
    for channel, path in logs.items():
        rows = ingest.normalised(readers.channel_logs(spark, path, cutover_us, pattern=pattern), channel)
        found.append(rows.select("us", "channel", "text", F.to_json("source").alias("source")))
    if transcripts:
        rows = ingest.since(ingest.chunks(readers.transcripts(spark, transcripts)), cutover_us)
        found.append(rows.select("us", "channel", "text", F.to_json("source").alias("source")))
    if not found:
        raise ValueError("no logs and no transcripts")
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out.withColumn("seq", F.xxhash64("text", "source"))


def index_all(spark: SparkSession, logs: Mapping[str, str], shards: str, state: str, batch_id: int, transcripts: str | None = None, late: str | None = None, **options) -> None:
    """Normalises all channels, cuts transcripts and appends what is new to the day shards: one batch of the log."""
    incremental.index_batch(events(spark, logs, transcripts, **options), shards, state, batch_id, late=late)
