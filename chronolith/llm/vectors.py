"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

Equal vectors of a label are one class. Each class is turned by random signs and Hadamard transforms, several times over;
the nearest signed axis of two turns gives its bucket in a table. It is also sent to the next likely buckets, and
compared there with the vectors that belong to them. A pair may meet in several buckets; it is counted in the first one
that both know of, which their codes tell. What leaves a task are numbers of links and the edges of a forest, never all
pairs of a dense group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm import cells, common
from chronolith.llm.components import components

COSINE = 0.93
PROBES = 4
#: Tables by the largest width that they are for: with 4 buckets each they find 99.8 % of the pairs that are exactly at the
#: bound, or more (tests/llm/test_similarity.py).
TABLES = {64: 6, 128: 8, 256: 9}
WIDER = 12
TURNS = 2


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    x = x.copy()
    h = 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        h *= 2
    return x


def tables_for(width: int) -> int:
    return next((n for most, n in TABLES.items() if width <= most), WIDER)


def codes(x: np.ndarray, tables: int, probes: int = PROBES, seed: int = 23) -> np.ndarray:
    """For each row (of unit length) and table its bucket, then the next likely ones: tables * probes numbers."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    rng = np.random.default_rng([seed, width])
    out = np.empty((len(x), tables, probes), np.int32)
    depth = min(3, width)
    for t in range(tables):
        best, gap = [], []
        for _ in range(TURNS):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, :depth]
            value = np.take_along_axis(y, top, 1)
            best.append(top * 2 + (value < 0))
            gap.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
        # The combinations of axes, cheapest first; the first is the bucket itself.
        cost = (gap[0][:, :, None] + gap[1][:, None, :]).reshape(len(x), -1)
        both = (best[0][:, :, None] * (2 * width) + best[1][:, None, :]).reshape(len(x), -1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        found = np.take_along_axis(both, order, 1)
        out[:, t, : found.shape[1]] = found
        out[:, t, found.shape[1] :] = found[:, :1]
    return out.reshape(len(x), -1)


def _first_meeting(a: np.ndarray, b: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """table * 2**32 + bucket of the first bucket in which rows of codes a and b are compared; -1 where there is none."""
    a, b = a.reshape(-1, tables, probes), b.reshape(-1, tables, probes)
    out = np.full(len(a), -1, np.int64)
    for t in range(tables - 1, -1, -1):
        ma, mb = a[:, t, 0].astype(np.int64), b[:, t, 0].astype(np.int64)
        in_a, in_b = (b[:, t] == a[:, t, :1]).any(1), (a[:, t] == b[:, t, :1]).any(1)
        here = np.where(in_a & in_b, np.minimum(ma, mb), np.where(in_a, ma, mb))
        out = np.where(in_a | in_b, t * 2**32 + here, out)
    return out


def _codes_of(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, np.uint16 if len(packed) == 2 * count else np.int32).astype(np.int32)


def _units(raw: list[bytes], dtype: str) -> list[np.ndarray]:
    """The vectors at unit length, in double precision."""
    out = []
    for r in raw:
        x = np.frombuffer(r, dtype).astype(np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def _rows(vectors: DataFrame, dtype: str) -> DataFrame:
    """vec_id, key (null where the vector can't link), group and the vector's bytes, in its own precision, of each row."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, groups, units = [], [], []
        for v, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
            key = group = unit = None
            if label is not None and v and None not in v:
                x = np.array(v, np.float64)
                if np.isfinite(x).all() and x.any():
                    unit = x.astype(dtype).tobytes()
                    group = f"{label}/{len(x)}"
                    key = int.from_bytes(hashlib.blake2b(group.encode() + np.array(v, np.float64).tobytes(), digest_size=8).digest(), "little", signed=True)
            keys.append(key)
            groups.append(group)
            units.append(unit)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(groups, pa.string()), pa.array(units, pa.binary())], names=["vec_id", "key", "group", "unit"])

    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    return common.arrow_map(chosen, "vec_id long, key long, group string, unit binary", each)


def linked(vectors: DataFrame, cosine: float = COSINE, tables: int | None = None, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding, label).

    Rows link when labels and lengths are equal and the cosine, in double precision, is at least the bound. Null labels
    and vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own
    component. Each row counts: rows that repeat a vector link with each other. A row with a null vec_id is counted by
    others, and its component is the least id among the rest. An empty table gives no rows. Other columns are not read.
    tables: as many as the widest vector needs, if not given.
    """
    tables = tables or tables_for(vectors.agg(F.max(F.size("embedding"))).first()[0] or 1)
    dtype = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    rows = common.cut(_rows(vectors, dtype))
    classes = rows.where("key IS NOT NULL").groupBy("key", "group").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.max("unit").alias("unit"))

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        units = _units(batch.column("unit").to_pylist(), dtype)
        out: list[bytes] = [b""] * len(units)
        for width in {len(u) for u in units}:
            at = [i for i, u in enumerate(units) if len(u) == width]
            for i, c in zip(at, codes(np.array([units[i] for i in at]), tables, probes), strict=True):
                out[i] = c.astype(np.uint16 if c.max() < 65536 else np.int32).tobytes()
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary()), pa.array([_codes_of(c, tables * probes).tolist() for c in out], pa.list_(pa.int32()))], names=[*batch.schema.names, "packed", "codes"])

    classes = common.cut(common.arrow_map(classes, "key long, group string, least long, n long, unit binary, packed binary, codes array<int>", coded))
    slim = classes.select("key", "group", F.posexplode("codes").alias("pos", "code"))
    slim = slim.withColumn("table", F.expr(f"pos div {probes}")).withColumn("main", F.col("pos") % probes == 0)
    slim = slim.groupBy("key", "group", "table", "code").agg(F.max("main").alias("main"))
    meeting = F.col("table").cast("long") * F.lit(2**32) + F.col("code")
    slim = slim.select("key", "main", meeting.alias("meeting"), F.xxhash64("group", "table", "code").alias("bucket"))
    dealt = cells.dealt(slim, "bucket", "key", useful="max(main)").join(classes.select("key", "n", "unit", "packed"), "key")

    def work(table: pa.Table) -> pa.RecordBatch | None:
        key, cell, side = (table.column(c).to_numpy() for c in ("key", "cell", "side"))
        main, n, here = table.column("main").to_numpy(zero_copy_only=False), table.column("n").to_numpy(), table.column("meeting").to_numpy()
        units = _units(table.column("unit").to_pylist(), dtype)
        packed = np.array([_codes_of(c, tables * probes) for c in table.column("packed").to_pylist()])
        starts = cells.bounds(cell)
        one_width = len({len(u) for u in units}) == 1
        x = np.array(units) if one_width else None
        found = []

        def keep(i: np.ndarray, j: np.ndarray) -> None:
            ok = (main[i] | main[j]) & ((side[i] < 0) | (side[i] != side[j])) & (key[i] != key[j])
            i, j = i[ok], j[ok]
            for k in range(0, len(i), 100_000):
                a, b = i[k : k + 100_000], j[k : k + 100_000]
                near = np.einsum("ij,ij->i", x[a], x[b]) >= cosine if one_width else np.array([len(units[p]) == len(units[q]) and units[p] @ units[q] >= cosine for p, q in zip(a, b, strict=True)], bool)
                a, b = a[near], b[near]
                mine = _first_meeting(packed[a], packed[b], tables, probes) == here[a]
                found.append((a[mine], b[mine]))

        for i, j in cells.small_pairs(starts, 48):
            keep(i, j)
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if e - s > 48:
                if one_width:
                    i, j = np.nonzero(np.triu(x[s:e] @ x[s:e].T >= cosine - 1e-9, 1))
                else:
                    i, j = np.triu_indices(e - s, 1)
                keep(i + s, j + s)
        if not found:
            return None
        i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        if not len(i):
            return None
        nodes, at = np.unique(np.concatenate([key[i], key[j]]), return_inverse=True)
        links = np.bincount(at, weights=np.concatenate([n[j], n[i]])).astype(np.int64)
        a, b = cells.forest(key, i, j)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes, a])), pa.array([None] * len(nodes) + b.tolist(), pa.int64()), pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]))], names=["a", "b", "links"])

    found = common.cut(cells.compared(dealt, work, "a long, b long, links long"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("others"))
    parts = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "key")
    of_class = classes.select("key", "least", "n").join(links, "key", "left").join(parts, "key", "left").withColumn("root", F.coalesce("root", "key"))
    ids = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    result = common.cut(common.cut(of_class).join(common.cut(ids), "root").select("key", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    out = rows.select("vec_id", "key").join(result, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
