"""Validation as data: each check adds a name to a row's violations; strict() turns any into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.operators.pairs import all_pairs

#: Fixed names.
ANSWER_BASES = ("H", "F", "H+F")
TIMESCALES = ("micro", "short", "medium", "long")
INTERVAL_TYPES = ("activity_window", "todo", "predictive_actions", "verbatim_textbox", "predictive_struggles", "assistant_utility", "affective_state", "cognitive_state", "dropped_commitments", "identity", "hypothetical", "recall", "current_state", "priority")
SPARSE_TYPES = ("verbatim_textbox",)
SEED_TYPES = ("timing", "curiosity", "disregard", "value", "threaded")
MOST_CONTEXT = 100
TOLERANCE_US = 1_000
THREADS, LEAST, MOST = 3, 3, 10


def bad(condition: Column, name: str) -> Column:
    """name where the condition doesn't hold (or is null)."""
    return F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))


def all_of(*checks: Column) -> Column:
    return F.array_compact(F.array(*checks))


def strict(rows: DataFrame, column: str = "violations") -> DataFrame:
    """rows, or an error that names the first violations met."""
    text = F.concat(F.lit("violations: "), F.array_join(column, ", "))
    return rows.where(F.when(F.size(column) > 0, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))


def pair_budget(kind: Column, asked: Column) -> Column:
    """Pairs that are asked for of a type: of the threaded type the largest number, of others what is asked for within bounds."""
    return F.when(kind == "threaded", F.lit(MOST)).otherwise(F.greatest(F.lit(LEAST), F.least(asked, F.lit(MOST)))).cast("long")


def parse_types(raw: str | None, known: tuple[str, ...]) -> list[str]:
    """Types of a comma list in its order, without repeats; none or all means every type."""
    names = list(dict.fromkeys(filter(None, (p.strip() for p in (raw or "").split(",")))))
    if not names or names == ["all"]:
        return list(known)
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown types: {', '.join(unknown)}")
    return names


def context_ok(context: Column) -> Column:
    """At most MOST_CONTEXT events whose indexes are their positions."""
    return (F.size(context) <= MOST_CONTEXT) & F.forall(F.transform(context, lambda e, i: e["index"].eqNullSafe(i.cast("long"))), lambda ok: ok)


def texts_ok(pair: Column, *fields: str) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & (F.length(F.coalesce(pair[f], F.lit(""))) > 0)
    return out


def basis_ok(pair: Column, context_size: Column) -> Column:
    """A reason, and at least one index, each of an event of the context."""
    basis = pair["question_basis"]
    indexes = basis["context_event_indexes"]
    inside = F.forall(indexes, lambda i: F.coalesce((i >= 0) & (i < context_size), F.lit(False)))
    return F.coalesce((F.length(basis["reason"]) > 0) & (F.size(indexes) > 0) & inside, F.lit(False))


def grounded(basis: Column, verify_us: Column, cutoff_us: Column) -> Column:
    """Hindsight is verified by the cutoff, foresight from it on; a millisecond either way is allowed."""
    past = verify_us <= cutoff_us + TOLERANCE_US
    future = verify_us >= cutoff_us - TOLERANCE_US
    return F.when(basis == "H", past).when(basis.isin("F", "H+F"), future).otherwise(F.lit(False))


def pair_ok(pair: Column, cutoff_us: Column, context_size: Column) -> Column:
    """A complete pair whose time fits its basis and whose evidence exists."""
    return (
        pair["q_id"].isNotNull()
        & texts_ok(pair, "question", "answer", "category", "why_it_matters", "evidence_grounding")
        & F.coalesce(pair["timescale"].isin(*TIMESCALES), F.lit(False))
        & F.coalesce(pair["answer_basis"].isin(*ANSWER_BASES), F.lit(False))
        & pair["verify_at_iso"].isNotNull()
        & F.coalesce(grounded(pair["answer_basis"], pair["verify_us"], cutoff_us), F.lit(False))
        & pair["question_difficulty"].isNotNull()
        & basis_ok(pair, context_size)
    )


def _common(types: tuple[str, ...]) -> list[Column]:
    return [bad(F.col("qa_type").isin(*types), "qa_type"), bad(F.col("cutoff_us").isNotNull(), "cutoff"), bad(context_ok(F.col("context")), "context")]


def interval_documents(documents: DataFrame) -> DataFrame:
    """Documents about intervals: 3 to 10 pairs, flat or threaded; 0 to 10 for the sparse type."""
    pairs = all_pairs(F.col("qa_pairs"), F.col("threads"))
    size = F.size("context").cast("long")
    least = F.when(F.col("qa_type").isin(*SPARSE_TYPES), 0).otherwise(LEAST)
    ok = F.forall(pairs, lambda p: pair_ok(p, F.col("cutoff_us"), size))
    return documents.withColumn("violations", all_of(*_common(INTERVAL_TYPES), bad(F.size(pairs).between(least, F.lit(MOST)), "pair_count"), bad(ok, "pair")))


def threads_ok(threads: Column, most_in_all: int | None) -> Column:
    """Three threads, numbered from 0, of 3 to 10 pairs each; in all 9 to most_in_all."""
    ids = F.forall(F.transform(threads, lambda t, i: t["thread_id"].eqNullSafe(i.cast("long"))), lambda ok: ok)
    each = F.forall(threads, lambda t: F.coalesce(F.size(t["qa_pairs"]).between(LEAST, MOST), F.lit(False)))
    total = F.aggregate(threads, F.lit(0), lambda a, t: a + F.coalesce(F.size(t["qa_pairs"]), F.lit(0)))
    ok = (F.size(threads) == THREADS) & ids & each
    return ok if most_in_all is None else ok & total.between(THREADS * LEAST, most_in_all)


def seed_documents(documents: DataFrame) -> DataFrame:
    """Documents about seeds: flat 3 to 10 pairs, or for the threaded type three threads of 9 to 10 pairs in all."""
    size = F.size("context").cast("long")
    threaded = F.col("qa_type") == "threaded"
    pairs = F.when(threaded, all_pairs(F.lit(None).cast(documents.schema["qa_pairs"].dataType), F.col("threads"))).otherwise(F.col("qa_pairs"))
    shape = F.when(threaded, threads_ok(F.col("threads"), MOST)).otherwise(F.size("qa_pairs").between(LEAST, MOST))
    ok = F.forall(pairs, lambda p: pair_ok(p, F.col("cutoff_us"), size))
    return documents.withColumn("violations", all_of(*_common(SEED_TYPES), bad(shape, "pair_count"), bad(ok, "pair")))


def question_documents(documents: DataFrame) -> DataFrame:
    """Question threads: three of 3 to 10 pairs, ids are positions, texts and evidence complete."""
    size = F.size("context").cast("long")
    q_ids = F.forall("threads", lambda t: F.forall(F.transform(t["qa_pairs"], lambda p, i: p["q_id"].eqNullSafe(i.cast("long"))), lambda ok: ok))
    pairs = all_pairs(F.lit(None).cast(documents.schema["qa_pairs"].dataType), F.col("threads"))
    ok = F.forall(pairs, lambda p: texts_ok(p, "question", "answer", "why_it_matters", "evidence_grounding") & p["question_difficulty"].isNotNull() & basis_ok(p, size))
    return documents.withColumn("violations", all_of(bad(context_ok(F.col("context")), "context"), bad(threads_ok(F.col("threads"), None), "threads"), bad(q_ids, "q_id"), bad(ok, "pair")))


def enough_members(links: DataFrame, column: str = "members") -> DataFrame:
    return links.withColumn("violations", all_of(bad(F.size(column) >= 2, column)))


def variant_is(column: Column, kind: str) -> Column:
    """Whether a variant is an array, an object or another kind."""
    return F.schema_of_variant(column).startswith(kind)
