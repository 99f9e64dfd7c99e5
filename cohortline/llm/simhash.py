"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majority votes over XXH64 hashes of word shingles. Two
fingerprints within ``max_bits`` of each other must, in one of the ``PARTS``
of the 64 bits, be within that part's share of the distance (pigeonhole: the
shares plus one each add up to ``max_bits + 1``). Every part has a covering
code whose codewords are the anchors: each point is within the code's covering
radius R of its home anchor, so a partner within t bits is within R + t of the
same anchor. A fingerprint is replicated to every anchor within R + t of it
and compared, anchor by anchor, with the fingerprints at home there. Nothing
is lost, and no anchor sees unrelated fingerprints.

Equal fingerprints are collapsed before the replication. An anchor with many
fingerprints is cut into bounded tiles (``common.tile_hot_keys``). A tile
emits a spanning forest of its links rather than all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import (chunked, connected_components, group_starts, local_components,
                                   pair_blocks, slices, stage, tile_hot_keys)

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42


@dataclass(frozen=True)
class Part:
    """``width`` bits from bit ``low`` up, of which ``share`` may differ.

    ``hamming`` low bits of the part carry the perfect Hamming code of length
    2^r - 1 (covering radius 1); the other bits are their own anchor (radius
    0). With ``hamming`` 0 the anchors are all points of the part.
    """

    low: int
    width: int
    share: int
    hamming: int = 0

    def syndromes(self, x: np.ndarray) -> np.ndarray:
        s = np.zeros(len(x), np.uint64)
        for i in range(self.hamming):
            s ^= ((x >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
        return s

    def home(self, x: np.ndarray) -> np.ndarray:
        """The nearest codeword: the bit that the syndrome names is flipped."""
        if not self.hamming:
            return x
        s = self.syndromes(x)
        return np.where(s > 0, x ^ (np.uint64(1) << (s - np.minimum(s, np.uint64(1)))), x)

    def reached(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, anchors) of all anchors a fingerprint within ``share`` of a
        row can have as home: flip up to ``share`` bits, then go home."""
        seen = np.empty((0, len(x)), np.uint64)
        for flips in range(self.share + 1):
            for bits in combinations(range(self.width), flips):
                a = self.home(x ^ np.uint64(sum(1 << b for b in bits)))
                fresh = ~(seen == a).any(axis=0) if len(seen) else np.ones(len(x), bool)
                yield np.flatnonzero(fresh), a[fresh]
                seen = np.vstack([seen, a])


#: 4 bits: one of the first two parts differs in at most 1 bit, or the third in none.
PARTS = (Part(0, 24, 1, 15), Part(24, 24, 1, 15), Part(48, 16, 0))


def covers(parts: tuple[Part, ...], max_bits: int) -> bool:
    """Whether the parts tile 64 bits and their shares rule out every miss."""
    ends = [p.low + p.width for p in parts]
    tiled = [p.low for p in parts] == [0, *ends[:-1]] and ends[-1] == 64
    return tiled and sum(p.share + 1 for p in parts) >= max_bits + 1


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of one text; 0 for a text without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED)
                  for a, b in zip(start[:len(tokens) - words + 1].tolist(), end[words - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
    vote = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(vote).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)`` per row; fp is the fingerprint's bits as a signed long.
    A null text counts as empty and gets 0. Rows are never merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.fromiter((fingerprint((t or "").encode(), words)
                               for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "id long, fp long"))


def _keyed_fingerprints(keyed: DataFrame, words: int) -> DataFrame:
    """``(id, h, fp)`` per row of ``keyed(id, h, t)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.fromiter((fingerprint((t or "").encode(), words)
                               for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], names=["id", "h", "fp"])

    return keyed.select("id", "h", "t").mapInArrow(run, "id long, h long, fp long")


def replicas(distinct: DataFrame, parts: tuple[Part, ...] = PARTS) -> DataFrame:
    """``(anchor, fp, rep, home)``: each fingerprint at all anchors it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                fp = piece.column(0).to_numpy().astype(np.int64)
                rep = piece.column(1).to_numpy()
                for number, part in enumerate(parts):
                    x = (fp.view(np.uint64) >> np.uint64(part.low)) & np.uint64((1 << part.width) - 1)
                    home = part.home(x)
                    rows, anchors = map(np.concatenate, zip(*part.reached(x)))
                    key = (anchors | np.uint64(number << 60)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(fp[rows]), pa.array(rep[rows]),
                         pa.array(anchors == home[rows])], names=["anchor", "fp", "rep", "home"])

    return distinct.select("fp", "rep").mapInArrow(run, "anchor long, fp long, rep long, home boolean")


def _compare(max_bits: int):
    key = ["anchor", "ti", "tj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches, key):
            start = group_starts(table, key)
            size = np.diff(np.append(start, table.num_rows))
            left = table.column("is_left").to_numpy()
            right = table.column("is_right").to_numpy()
            fp = table.column("fp").to_numpy().view(np.uint64)
            rep = table.column("rep").to_numpy()
            group = np.repeat(np.arange(len(start)), size)
            li, ri = np.flatnonzero(left), np.flatnonzero(right)
            ln = np.bincount(group[li], minlength=len(start))
            rn = np.bincount(group[ri], minlength=len(start))
            l0, r0 = np.cumsum(ln) - ln, np.cumsum(rn) - rn
            found = [(rep[:0], rep[:0])]
            for g, i, j in pair_blocks(ln, rn):
                a, b = li[l0[g] + i], ri[r0[g] + j]
                near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
                near &= rep[a] != rep[b]
                found.append(local_components(rep[a[near]], rep[b[near]]))
            u, v = local_components(*map(np.concatenate, zip(*found)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, parts: tuple[Part, ...] = PARTS) -> DataFrame:
    """Edges ``(u, v)`` between representatives that span all links of
    ``distinct(fp, rep)`` within ``max_bits``."""
    if not covers(parts, max_bits):
        raise ValueError("the parts do not guarantee that every pair within max_bits meets")
    tiles = tile_hot_keys(replicas(distinct, parts), "anchor", "fp", "home")
    return (tiles.repartition("anchor", "ti", "tj").sortWithinPartitions("anchor", "ti", "tj")
            .mapInArrow(_compare(max_bits), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    parts: tuple[Part, ...] = PARTS) -> DataFrame:
    """One row per input row: ``(id, fp, component_id)``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits. Null and wordless texts have fingerprint 0
    and link like any other. Rows with a null id keep their row; their class
    is that of their fingerprint (null if no other id has it). Repeated ids
    keep one row each. Other columns of ``docs`` are ignored; an empty table
    gives an empty result.
    """
    fps = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("rep")).where("rep is not null"), "distinct")
    label = connected_components(links(distinct, max_bits, parts), "simhash")
    classes = (distinct.join(label, distinct["rep"] == label["id"], "left")
               .select(F.col("fp").alias("class_fp"), F.coalesce("component_id", "rep").alias("component_id")))
    return (fps.join(classes, fps["fp"] == classes["class_fp"], "left")
            .select("id", "fp", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS, parts: tuple[Part, ...] = PARTS) -> DataFrame:
    """The row with the smallest id of every near-duplicate class, columns unchanged.

    Classes are those of the rows' fingerprints, whatever their ids: rows that share an id but
    not a class are judged apart. Of a class's rows with the smallest id the one whose text has the
    smallest XXH64 stays, and of equal texts the first by the other columns. A row without an id
    stays only in a class of such rows, chosen likewise.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    fps = stage(_keyed_fingerprints(keyed, words), "fingerprints")
    best = stage(fps.groupBy("fp", F.col("id").isNull().alias("nameless")).agg(F.min(F.struct("id", "h")).alias("best")), "best")
    distinct = stage(best.select("fp").distinct().withColumn("rep", F.col("fp")), "distinct")
    label = connected_components(links(distinct, max_bits, parts), "simhash").select(F.col("id").alias("linked"), "component_id")
    keep = (best.join(label, best["fp"] == label["linked"], "left")
            .groupBy(F.coalesce("component_id", "fp").alias("class")).agg(F.min(F.struct("nameless", "best")).alias("b"))
            .select(F.col("b.best.id").alias("keep"), F.col("b.best.h").alias("keep_h")).distinct())
    ties = [F.col("row").getField(f.name) for f in docs.schema.fields
            if "map" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    first = F.row_number().over(Window.partitionBy("id", "h").orderBy(*ties))
    named = (keyed.where("id is not null")
             .join(keep, (F.col("id") == F.col("keep")) & (F.col("h") == F.col("keep_h")), "left_semi")
             .withColumn("k", first).where("k = 1"))
    # Any number of copies may lack an id: they are one row a task before they are dealt.
    nameless = (keyed.where("id is null").withColumn("k", first).where("k = 1")
                .join(keep.where("keep is null"), F.col("h") == F.col("keep_h"), "left_semi"))
    return named.select("row.*").union(nameless.select("row.*"))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` (contract of the query)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
