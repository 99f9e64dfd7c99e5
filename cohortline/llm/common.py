"""Shared helpers: scratch tables, streamed key groups, tiles, components.

Every intermediate table lives under ``spark.checkpoint.dir`` (shared by the
driver and all executors), so a lost executor never takes the only copy of a
result with it.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import checkpoint_dir

#: Rows of one key that are compared in one piece; larger keys are tiled.
TILE_ROWS = 4096
#: Bytes of a batch that are Python objects at a time, about (one row at least).
SLICE_BYTES = 2_000_000
#: Rows in an Arrow batch between the JVM and Python.
BATCH_ROWS = 1000


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def drop_stage(df: DataFrame) -> None:
    """Delete a table written by :func:`stage` once nothing reads it any more."""
    path = getattr(df, "_llm_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def release(*tables: DataFrame) -> None:
    """Delete staged tables that are used up, and let the driver forget the
    shuffles behind them, so that their files go now and not at the next
    collection of garbage."""
    for table in tables:
        drop_stage(table)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


def hand_back() -> None:
    """Return freed memory to the system. A Python worker is kept for later
    tasks, and what its allocators hold on to would be counted with theirs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no such call but in glibc
        pass


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Have Arrow batches of at most ``rows`` rows where the session does not say otherwise.

    A batch of texts is held by the JVM and by Python at once, and Spark's default of 10,000
    rows is 35 MB and more of ordinary documents on either side of every task.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, rows)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows and about ``size`` bytes, so that only a
    piece's texts are Python objects at a time. Memory is handed back behind the last."""
    for batch in batches:
        step = max(1, min(rows, size * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    hand_back()


def chunked(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 65536
            ) -> Iterator[pa.Table]:
    """Re-cut sorted batches into tables that hold whole key groups.

    The input is sorted by ``key``. A table is yielded as soon as at least
    ``rows`` rows are complete; a group is never split.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = group_starts(table, key)[-1]
        if last:
            yield table.slice(0, last)
            rest = table.slice(last).combine_chunks().to_batches()
            held, count = list(rest), table.num_rows - last
        else:
            held = table.to_batches()
            rows = max(rows, 2 * count)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, key: list[str]) -> np.ndarray:
    """Row indices at which a new key begins (the first is 0)."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for name in key:
        v = table.column(name).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def pair_blocks(left: np.ndarray, right: np.ndarray, limit: int = 2_000_000
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, i, j) index arrays of left[g] x right[g] products, in blocks."""
    size = left * right
    begin = 0
    total = np.cumsum(size)
    while begin < len(size):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + limit, "right")))
        own = size[begin:end]
        g = np.repeat(np.arange(begin, end), own)
        k = np.arange(len(g)) - np.repeat(np.cumsum(own) - own, own)
        yield g, k // np.maximum(right[g], 1), k % np.maximum(right[g], 1)
        begin = end


def local_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, smallest member) with the connectivity of (u, v)."""
    if not len(u):
        return u[:0], v[:0]
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(ids))
    return ids[far], ids[label[far]]


def tile_hot_keys(rows: DataFrame, key: str, member: str, first: str,
                  tile: int = TILE_ROWS) -> DataFrame:
    """Deal each key's rows out to bounded tiles ``(key, ti, tj)``.

    Rows with ``first`` true are the left sides of the key's comparisons, all
    rows are right sides. A key of more than ``tile`` rows is cut into g
    pieces by a hash of ``member``; piece i of the left meets piece j of the
    right in tile (i, j), so every left-right pair still meets exactly once
    and no task holds more than about two pieces. Adds ``is_left`` and
    ``is_right``.
    """
    # Written first, so that the planner knows its size: a short list is broadcast and the rows
    # are not shuffled for the join.
    large = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > tile)
                  .select(F.col(key).alias("_hot"), F.ceil(F.col("n") / tile).cast("int").alias("_g")), "hot")
    dealt = rows.join(large, rows[key] == large["_hot"], "left")
    piece = F.pmod(F.xxhash64(member), F.coalesce("_g", F.lit(1))).cast("int")
    cold = F.array(F.struct(F.lit(0).alias("ti"), F.lit(0).alias("tj"),
                            F.col(first).alias("is_left"), F.lit(True).alias("is_right")))
    each = F.sequence(F.lit(0), F.col("_g") - 1)
    left = F.when(F.col(first), F.transform(each, lambda x: F.struct(
        piece.alias("ti"), x.alias("tj"),
        F.lit(True).alias("is_left"), (x == piece).alias("is_right"))))
    right = F.transform(each, lambda x: F.struct(
        x.alias("ti"), piece.alias("tj"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right")))
    # The tile (piece, piece) of a left row is the one where it is also a right row.
    right = F.when(F.col(first), F.filter(right, lambda s: s["ti"] != s["tj"])).otherwise(right)
    tiles = F.when(F.col("_g").isNull(), cold).otherwise(
        F.concat(F.coalesce(left, F.expr("filter(array(struct(0 as ti, 0 as tj, false as is_left, true as is_right)), x -> false)")), right))
    return (dealt.withColumn("_t", F.explode(tiles))
            .select(*rows.columns, "_t.ti", "_t.tj", "_t.is_left", "_t.is_right"))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = local_components(batch.column("u").to_numpy(), batch.column("v").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``(id, component_id)`` of every end of ``edges(u, v)``; the component id
    is its smallest member.

    Alternating large-star and small-star rounds (Kiveris et al. 2014) over
    tables in the shared folder; a round only groups by a vertex with
    map-side minima and joins that minimum back, which adaptive execution can
    split for a vertex with very many neighbours. Self links are ignored.
    """
    current = stage(edges.where("u <> v").select("u", "v").mapInArrow(_stars, "u long, v long"), name)
    before = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        after = stage(small, name)
        drop_stage(current)
        current = after
    member = current.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    root = current.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return member.unionByName(root)
