"""Embedding near-duplicates: random hyperplanes, exact cosines, components.

Each of several tables cuts the space by ``bits`` random hyperplanes; the
signs of a vector are its bucket in that table. Vectors that share a bucket in any
table are compared by their exact cosine in double precision, and linked from
``threshold`` up. The number of tables follows from the bits, so that a pair at
the threshold itself shares a bucket with probability ``recall``:
1 - (1 - p^bits)^tables with p = 1 - acos(threshold) / pi. The bits grow with the
logarithm of the rows, which keeps the usual bucket at about ``BUCKET_ROWS``.

Equal vectors are one class and are compared once. Large buckets are cut into
tiles. A tile emits a link count per vector and a spanning forest of its
links, never all pairs; a pair that meets in several tables is counted in the
first one only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import chunked, connected_components, group_starts, local_components, stage, tile_hot_keys

THRESHOLD = 0.9
#: Probability that a pair exactly at the threshold meets in some table.
RECALL = 0.999
#: Rows in a usual bucket.
BUCKET_ROWS = 64
SEED = 20


def plan(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for that many vectors."""
    bits = min(30, max(4, ceil(log2(max(rows, 1) / BUCKET_ROWS)) if rows > BUCKET_ROWS else 4))
    p = 1 - acos(threshold) / pi
    return bits, max(1, ceil(log(1 - recall) / log(1 - p ** bits)))


@cache
def hyperplanes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED + dimension).standard_normal((dimension, bits * tables))


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each list as float64, None for a null list or one with a null component."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not column.null_count and not column.values.null_count:
        values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
        edge = column.offsets.to_numpy()
        return [values[a:b] for a, b in zip(edge, edge[1:])]
    return [None if v is None or None in v else np.array(v, np.float64) for v in column.to_pylist()]


def number_type(table: DataFrame, vector_col: str) -> str:
    """Four bytes a number for a float column (exact), eight for any other."""
    return "<f4" if dict(table.dtypes)[vector_col] == "array<float>" else "<f8"


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, key, vec)``: the bytes of each usable vector, as wide as the column's
    numbers, and their 128-bit hash; both null where the vector (or the id) cannot be linked."""
    kind = number_type(table, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, vecs = batch.column(0).to_pylist(), [], []
            for i, v in zip(ids, _rows(batch.column(1))):
                norm = 0.0 if i is None or v is None or not len(v) or not np.isfinite(v).all() else np.abs(v).max()
                raw = (v + 0.0).astype(kind).tobytes() if norm > 0 else None
                vecs.append(raw)
                keys.append(hashlib.blake2b(raw, digest_size=16).digest() if raw else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())],
                                             names=["id", "key", "vec"])

    return (table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .mapInArrow(run, "id long, key binary, vec binary"))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that very
    large and very small vectors neither overflow nor vanish."""
    m = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def buckets(classes: DataFrame, bits: int, tables: int, kind: str) -> DataFrame:
    """``(bucket, t, rep, n, vec, signs)``: each class in every table ``t``."""
    width, packing = np.dtype(kind).itemsize, sign_type(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = batch.column(2).to_pylist()
            size = np.array([len(r) // width for r in raw])
            for dim in np.unique(size):
                own = np.flatnonzero(size == dim)
                for at in range(0, len(own), 1024):
                    part = own[at:at + 1024]
                    m = unit(np.frombuffer(b"".join(raw[i] for i in part), kind).astype(np.float64).reshape(len(part), dim))
                    sign = (m @ hyperplanes(int(dim), bits, tables) >= 0).reshape(len(part), tables, bits)
                    signs = (sign * (1 << np.arange(bits))).sum(axis=2).astype(packing)
                    packed = pa.array([s.tobytes() for s in signs], pa.binary())
                    vec = pa.array([raw[i] for i in part], pa.binary())
                    for t in range(tables):
                        key = signs[:, t].astype(np.int64) | (np.int64(t) << 30) | (np.int64(dim) << 42)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key), pa.array(np.full(len(part), t, np.int32)), pa.array(rep[part]),
                             pa.array(n[part]), vec, packed], names=["bucket", "t", "rep", "n", "vec", "signs"])

    return classes.select("rep", "n", "vec").mapInArrow(
        run, "bucket long, t int, rep long, n long, vec binary, signs binary")


def sign_type(bits: int) -> str:
    return "<u2" if bits <= 16 else "<u4"


def _compare(threshold: float, kind: str, packing: str):
    key = ["bucket", "ti", "tj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, key, 4096):
            start = group_starts(table, key)
            end = np.append(start[1:], table.num_rows)
            left, right = table.column("is_left").to_numpy(), table.column("is_right").to_numpy()
            rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
            t = table.column("t").to_numpy()
            vec, signs = table.column("vec").combine_chunks(), table.column("signs").combine_chunks()
            found, counts = [(rep[:0], rep[:0])], np.zeros(table.num_rows, np.int64)
            for a, b in zip(start, end):
                if b - a < 2:
                    continue
                m = unit(np.frombuffer(b"".join(vec[a:b].to_pylist()), kind).astype(np.float64).reshape(b - a, -1))
                s = np.frombuffer(b"".join(signs[a:b].to_pylist()), packing).reshape(b - a, -1)[:, :t[a]]
                l, r = np.flatnonzero(left[a:b]), np.flatnonzero(right[a:b])
                for at in range(0, len(l), 512):
                    x = l[at:at + 512]
                    i, j = np.nonzero(m[x] @ m[r].T >= threshold)
                    i, j = x[i], r[j]
                    fresh = i != j
                    i, j = i[fresh], j[fresh]
                    seen = np.zeros(len(i), bool)
                    for c in range(s.shape[1]):
                        seen |= s[i, c] == s[j, c]
                    i, j = a + i[~seen], a + j[~seen]
                    counts += np.bincount(i, n[j], minlength=len(counts)).astype(np.int64)
                    found.append(local_components(rep[i], rep[j]))
            u, v = local_components(*map(np.concatenate, zip(*found)))
            own = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([u, rep[own]])),
                 pa.array(np.concatenate([v, rep[own]])), pa.array(np.concatenate([u * 0, counts[own]]))],
                names=["u", "v", "n"])

    return run


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per input row: ``(id, n_links, component_id)``.

    ``n_links`` counts the other vectors linked directly, copies included;
    ``component_id`` is the smallest id reachable. Vectors that are null, empty, zero or
    hold a null or non-finite component, and rows with a null id, link with nothing and are
    their own component. Vectors of different lengths never link. Rows that
    share an id are one node, listed once each. Other columns are ignored; an empty table gives
    an empty result.
    """
    rows = stage(vectors(table, id_col, vector_col), "vectors")
    classes = stage(rows.where("key is not null").groupBy("key")
                    .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")), "classes")
    bits, tables = plan(classes.count(), threshold, recall)
    kind = number_type(table, vector_col)
    tiles = tile_hot_keys(buckets(classes, bits, tables, kind).withColumn("first", F.lit(True)), "bucket", "rep", "first")
    met = stage(tiles.repartition("bucket", "ti", "tj").sortWithinPartitions("bucket", "ti", "tj")
                .mapInArrow(_compare(threshold, kind, sign_type(bits)), "u long, v long, n long"), "links")
    counts = met.where("n > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("far"))
    label = connected_components(met.where("u <> v"), "embeddings")
    of_class = (classes.select("key", "rep", "n").join(counts, "rep", "left")
                .join(label.withColumnRenamed("id", "rep"), "rep", "left")
                .select("key", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
                        F.coalesce("component_id", "rep").alias("component_id")))
    return (rows.select("id", "key").join(of_class, "key", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id")))


def op6_hyperplane_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``embeddings`` (contract of the query)."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        (F.col("id") == F.col("component_id")).alias("kept"))
