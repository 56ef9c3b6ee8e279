"""Generation: rows to prompts to documents through a pluggable callable, with resume, ledger and an error policy."""

from __future__ import annotations

import json
import os
import subprocess
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronolith.functions import text as words
from chronolith.operators import validate
from chronolith.sources import files
from chronolith.sources.sinks import shared_folder, stored

Generator = Callable[[str], str]
RESULT = "output string, status string, error string"


def template(body: str, required: tuple[str, ...], common: str = "") -> str:
    """common and body as one template that has every required placeholder."""
    whole = "\n\n".join(filter(None, (common, body)))
    if lacking := [name for name in required if "{" + name + "}" not in whole]:
        raise ValueError(f"the template lacks {', '.join(lacking)}")
    return whole


def prompts(rows: DataFrame, text: str, name: str = "prompt", **columns: str) -> DataFrame:
    """rows with the filled template; structs, arrays and maps are written as JSON."""
    def value(c: str):
        return F.to_json(c) if rows.schema[c].dataType.typeName() in ("struct", "array", "map", "variant") else F.col(c)

    return rows.withColumn(name, words.fill(text, **{k: value(c) for k, c in columns.items()}))


def preview(rows: DataFrame, name: str = "prompt", size: int = 1200) -> DataFrame:
    """What would be asked: the prompts' first characters, nothing is called."""
    return rows.withColumn(name, F.substring(name, 1, size))


def work_items(rows: DataFrame, kinds: list[str], name: str = "qa_type") -> DataFrame:
    """Every row with every kind, of which there are a few."""
    return rows.withColumn(name, F.explode(F.array(*(F.lit(k) for k in kinds))))


def todo(items: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Items that have no result yet."""
    return items.join(done.select(*keys).distinct(), list(keys), "left_anti")


def run(rows: DataFrame, generator: Generator, jobs: int | None = None, name: str = "prompt", stop: bool = False) -> DataFrame:
    """rows with output, status (ok or failed) and error, each prompt given to the generator once a row. jobs spreads the
    calls over so many tasks; with stop a task makes no call after one that failed, and returns the rows up to it. Whoever
    reads the result twice should read it stored."""
    kept = rows.drop("output", "status", "error")
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(RESULT).fields])

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = False
        for frame in frames:
            out = []
            for prompt in frame[name]:
                if failed and stop:
                    break
                try:
                    out.append((generator(prompt), "ok", None))
                except Exception as e:
                    out.append((None, "failed", f"{type(e).__name__}: {e}"))
                    failed = True
            frame = frame.iloc[: len(out)]
            yield frame.assign(**{k: pd.Series([o[i] for o in out], index=frame.index, dtype=object) for i, k in enumerate(("output", "status", "error"))})

    return (kept.repartition(jobs) if jobs else kept).mapInPandas(each, schema)


def results(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What has been committed at path so far: a row for each call that came to its end."""
    found = [f"{path}/{n}" for n in files.names(spark, path) if n.startswith("chunk=") and "_SUCCESS" in files.names(spark, f"{path}/{n}")]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def resumed(rows: DataFrame, generator: Generator, path: str, *keys: str, chunk: int = 16, jobs: int = 4, keep_going: bool = False, name: str = "prompt") -> DataFrame:
    """The results (rows with output) of all rows, each key called until it has one; calls that came to their end in an earlier
    try, at path, aren't made again.

    Rows are dealt into chunks of about so many, jobs of them are worked on at a time, and each is committed as it ends: a
    task that is lost repeats the calls of its own chunk. A call that fails ends its chunk, stops all others by their tag
    and is an error, unless keep_going; what had been committed stays. Failed calls are kept too, and are made again by
    the next try."""
    if chunk <= 0 or jobs <= 0:
        raise ValueError("chunk and jobs must be positive")
    spark = rows.sparkSession
    schema = StructType([*rows.drop("output", "status", "error").schema.fields, *StructType.fromDDL(RESULT).fields])
    done = results(spark, path, schema).where("status = 'ok'")
    left = todo(rows.select(*(c for c in schema.names if c in rows.columns)), done, *keys)
    size = left.count()
    folder, number = f"{shared_folder(spark)}/calls-{uuid.uuid4().hex}", -(-size // chunk)
    if size:
        dealt = left.withColumn("_chunk", F.pmod(F.xxhash64(*keys), F.lit(number)).cast("int"))
        dealt.repartition("_chunk").write.partitionBy("_chunk").parquet(folder)
    tag, stop, context = f"calls-{uuid.uuid4().hex}", threading.Event(), spark.sparkContext

    def one(at: str) -> str | None:
        if stop.is_set():
            return None
        context.addJobTag(tag)
        try:
            part = spark.read.schema(left.schema).parquet(f"{folder}/{at}").coalesce(1)
            to = f"{path}/chunk={uuid.uuid4().hex}"
            run(part, generator, name=name, stop=not keep_going).write.parquet(to)
            bad = None if keep_going else spark.read.schema(schema).parquet(to).where("status <> 'ok'").select("error").first()
            if bad:
                stop.set()
                context.cancelJobsWithTag(tag)
                return bad.error
        except Exception:
            if not stop.is_set():  # else it was stopped
                stop.set()
                context.cancelJobsWithTag(tag)
                raise
        finally:
            context.removeJobTag(tag)
        return None

    with ThreadPoolExecutor(jobs) as pool:
        errors = [e for e in pool.map(one, [n for n in files.names(spark, folder) if n.startswith("_chunk=")] if size else []) if e]
    if errors:
        raise RuntimeError(f"a call failed: {errors[0]}")
    return results(spark, path, schema).where("status = 'ok'")


def run_batches(rows: DataFrame, generator: Generator, text: str, key: str, order: str) -> DataFrame:
    """One call for each group of key (batches of a fixed size): the group's rows, in order, as JSON in the template's {rows};
    key, output, status and error."""
    item = F.struct(order, *(c for c in rows.columns if c not in (key, order)))
    grouped = rows.groupBy(key).agg(F.to_json(F.sort_array(F.collect_list(item))).alias("rows"))
    return run(grouped.select(key, words.fill(text, rows=F.col("rows")).alias("prompt")), generator).drop("prompt")


LINKS = "struct<links: array<struct<members: array<bigint>, name: string>>>"


def links(themes: DataFrame, generator: Generator, text: str, group: str, key: str) -> DataFrame:
    """Links between the themes (key, other columns) of each group, by one call for the group: group, position (from 0),
    members, name and violations. A link needs two members or more, different ones, all of its group's themes; an answer
    that isn't JSON of LINKS fails its call."""
    results = published(run_batches(themes, generator, text, group, key))
    parsed = F.from_json("output", LINKS, {"mode": "PERMISSIVE"})
    results = results.withColumn("_answer", parsed)
    shape = F.col("_answer.links").isNotNull()
    results = results.where(F.when(shape, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no links in the answer for "), F.col(group).cast("string"))).cast("boolean")))
    rows = results.select(group, F.posexplode("_answer.links").alias("position", "_link")).select(group, F.col("position").cast("long").alias("position"), "_link.*")
    # Members are looked up as rows: a group may have any number of themes.
    known = themes.select(F.col(group), F.col(key).alias("_member"), F.lit(1).alias("_known")).distinct()
    spread = rows.select(group, "position", F.explode("members").alias("_member")).join(known, [group, "_member"], "left")
    counted = spread.groupBy(group, "position").agg(F.sum(F.coalesce("_known", F.lit(0))).alias("_there"), F.count_distinct("_member").alias("_apart"))
    rows = rows.join(counted, [group, "position"], "left")
    size = F.size("members")
    checks = (validate.bad(size >= 2, "members"), validate.bad(F.coalesce("_apart", F.lit(0)) == size, "repeated"), validate.bad(F.coalesce("_there", F.lit(0)) == size, "unknown"))
    return rows.select(group, "position", "members", "name", validate.all_of(*checks).alias("violations"))


def published(results: DataFrame, keep_going: bool = False) -> DataFrame:
    """The results if none failed; with keep_going those that didn't. They are stored first: each call is made once, and
    what is returned is what was looked at."""
    results = stored(results, "generated")
    if not keep_going and (bad := results.where("status <> 'ok'").select("error").first()):
        raise RuntimeError(f"a call failed: {bad.error}")
    return results.where("status = 'ok'")


def ranked_at_once(rows: DataFrame, generator: Generator, text: str, order: str, most: int = 5000) -> DataFrame:
    """One call for the whole set, which must not be larger than most: all rows, in order, as JSON in the template's
    {rows}; output, status and error."""
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one call")
    return run_batches(rows.withColumn("_all", F.lit(0)), generator, text, "_all", order).drop("_all")


def ledger(results: DataFrame, *keys: str) -> DataFrame:
    """A record for each call, to be appended to a log of them; results should be stored, else the calls are made again."""
    return results.select(*keys, "status", "error", F.length("output").cast("long").alias("output_chars"), F.current_timestamp().alias("at"))


def command(argv: list[str], timeout: float | None = None) -> Generator:
    """A generator that runs a command in a folder of its own, the prompt on its input, and takes what it prints."""

    def call(prompt: str) -> str:
        with tempfile.TemporaryDirectory() as folder:
            done = subprocess.run(argv, input=prompt, capture_output=True, text=True, cwd=folder, timeout=timeout, env=dict(os.environ))
        if done.returncode:
            raise RuntimeError(f"exit code {done.returncode}: {done.stderr[-500:]}")
        return done.stdout

    return call


def stub(prompt: str) -> str:
    """A deterministic stand-in for a model: three pairs about the prompt."""
    size = len(prompt)
    pairs = [{"q_id": i, "question": f"Question {i} of {size} characters?", "answer": f"Answer {size + i}."} for i in range(3)]
    return json.dumps({"qa_pairs": pairs}, sort_keys=True)


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def scope(first: int, last: int) -> str:
    return f"intervals_{first}-{last}"


def manifest(old: dict | None, stage: str, status: str, **fields: object) -> dict:
    """A run's manifest with a stage's state set."""
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    out = {"created_at": now, "stages": {}, **(old or {}), **fields}
    return out | {"stages": out["stages"] | {stage: {"updated_at": now, "status": status}}}
