"""Chunks of documents and an exchange of packed messages with buckets.

Some operators look up, for every position of every text, something that
depends on the whole corpus. One row per position would be a shuffle hundreds of times the
corpus. Here documents are packed into chunks of some megabytes, a chunk sends each bucket one
message with what it has and what it wants to know (each distinct thing once), the
bucket merges all chunks' messages into a model, and replies.

Messages of a bucket are merged in groups of chunks first, then the groups;
replies are made from the model and a few messages at a time. So a
task holds one bucket's model and a bounded number of message bytes, however
many chunks there are. A bucket with many message bytes is answered in several parts, each with a copy of the model;
the parts are so large that the copies together are no more bytes than the messages. What is
shuffled grows with the messages, and so with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import slices, stage

#: Text bytes in a chunk, about; a longer document is a chunk of its own.
CHUNK_BYTES = 14_000_000
#: Chunks whose messages to one bucket are merged in one task.
GROUP_CHUNKS = 512
#: Message bytes held while merging or replying.
HELD_BYTES = 8_000_000
#: Message bytes that are answered in one task, about, and at least the size of the bucket's model.
PART_BYTES = 128_000_000

_MESSAGE = "bucket int, chunk long, body binary"
_NAMES = ["bucket", "chunk", "body"]


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unsqueeze(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def dump(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays of whole or real numbers (as byte planes) and bytes, compressed."""
    out = []
    for a in arrays:
        if isinstance(a, bytes):
            kind, raw = "S1", a
        else:
            kind = a.dtype.str[1:]
            raw = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes()
        packed = squeeze(raw)
        out += [kind.encode().ljust(3), len(packed).to_bytes(6, "little"), packed]
    return b"".join(out)


def load(blob: bytes) -> list:
    """The inverse of :func:`dump`."""
    out, at = [], 0
    while at < len(blob):
        kind, n = blob[at:at + 3].strip().decode(), int.from_bytes(blob[at + 3:at + 9], "little")
        raw = unsqueeze(blob[at + 9:at + 9 + n])
        at += 9 + n
        if kind == "S1":
            out.append(raw)
        else:
            dtype = np.dtype("<" + kind)
            planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1)
            out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
    return out


# --- chunks ------------------------------------------------------------------

def pack(docs: DataFrame, id_col: str, text_col: str, flag: Column, lower: bool, chunk_bytes: int = CHUNK_BYTES
         ) -> DataFrame:
    """``(chunk, ids, flags, sizes, raw)``: texts as UTF-8 (null: empty), A-Z lower-cased if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list] = ([], [], [])
        size = count = 0

        def out() -> pa.RecordBatch:
            ids, flags, texts = held
            return pa.RecordBatch.from_arrays(
                [pa.array([first + count], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([flags], pa.list_(pa.bool_())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([squeeze(b"".join(texts))], pa.binary())], names=["chunk", "ids", "flags", "sizes", "raw"])

        for batch in slices(batches):
            for i, t, y in zip(*(batch.column(c).to_pylist() for c in range(3))):
                text = (t or "").encode()
                text = text.lower() if lower else text
                held[0].append(i)
                held[1].append(bool(y))
                held[2].append(text)
                size += len(text) + 64
                if size >= chunk_bytes:
                    yield out()
                    held, size, count = ([], [], []), 0, count + 1
        if held[0]:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), flag.alias("y"))
    return rows.mapInArrow(run, "chunk long, ids array<long>, flags array<boolean>, sizes array<long>, raw binary")


def texts_of(sizes: list[int], raw: bytes) -> list[bytes]:
    raw, out, at = unsqueeze(raw), [], 0
    for n in sizes:
        out.append(raw[at:at + n])
        at += n
    return out


def pieces(texts: list[bytes], limit: int = 3_000_000) -> Iterator[list[int]]:
    """Places of consecutive texts, about ``limit`` bytes at a time."""
    held, size = [], 0
    for i, t in enumerate(texts):
        held.append(i)
        size += len(t)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time; only one row's values are Python objects."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def message(bucket: int, chunk: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()),
                                       pa.array([body], pa.binary())], names=_NAMES)


def send(chunks: DataFrame, make: Callable[[dict], Iterator[tuple[int, bytes]]], name: str) -> DataFrame:
    """``(bucket, chunk, body)``: the messages ``make`` yields for each chunk row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            for bucket, body in make(row):
                yield message(bucket, row["chunk"], body)

    return stage(chunks.mapInArrow(run, _MESSAGE), name)


# --- buckets -----------------------------------------------------------------

def _merged(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], merge: Callable[[int, list[bytes]], bytes]
            ) -> Iterator[tuple[tuple, bytes]]:
    """(key, merged body) of rows sorted by key; bodies merge as they come in."""
    at, held, size = None, [], 0
    for row in rows(batches):
        now = tuple(row[c] for c in key)
        if now != at and held:
            yield at, merge(at[0], held)
            held, size = [], 0
        at = now
        held.append(row["body"])
        size += len(row["body"])
        if size > HELD_BYTES and len(held) > 1:
            held = [merge(at[0], held)]
            size = 0
    if held:
        yield at, merge(at[0], held)


def gather(messages: DataFrame, merge: Callable[[int, list[bytes]], bytes], chunks: int, name: str) -> DataFrame:
    """``(bucket, body)``: the merged messages of each bucket.

    ``merge(bucket, bodies)`` is associative and returns a body again. A bucket's
    messages are merged in groups of chunks before the groups meet.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, part), body in _merged(batches, ("bucket", "part"), merge):
            yield message(bucket, part, body)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), body in _merged(batches, ("bucket",), merge):
            yield message(bucket, 0, body)

    rows_in = messages
    if chunks > GROUP_CHUNKS:
        groups = -(-chunks // GROUP_CHUNKS)
        rows_in = (messages.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int"))
                   .repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(partial, _MESSAGE))
    merged = rows_in.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(final, _MESSAGE)
    return stage(merged.drop("chunk"), name)


def parts_of(model: DataFrame, messages: DataFrame) -> DataFrame:
    """``(of, parts)``: the buckets that are answered in several parts, as many as their messages hold
    models (or PART_BYTES, where that is more). There are fewer of them than PART_BYTES go into all messages."""
    sizes = messages.groupBy("bucket").agg(F.sum(F.octet_length("body")).alias("sent"))
    kept = model.select(F.col("bucket").alias("of"), F.octet_length("body").alias("size"))
    parts = F.floor(F.col("sent") / F.greatest(F.col("size"), F.lit(PART_BYTES))).cast("int")
    return sizes.join(kept, F.col("bucket") == F.col("of")).select("of", parts.alias("parts")).where("parts > 1")


def reply(model: DataFrame, messages: DataFrame, make: Callable[[int, bytes], Callable[[list[bytes]], list[bytes]]],
          chunks: int) -> DataFrame:
    """``(bucket, chunk, body)``: the bucket's reply to each message.

    ``make(bucket, model)`` prepares a bucket and returns a function from some
    message bodies to their replies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, answer, held, size = None, None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            for (chunk, _), body in zip(held, answer([b for _, b in held])):
                yield message(at[0], chunk, body)

        for row in rows(batches):
            now = row["bucket"], row["part"]
            if now != at:
                if held:
                    yield from out()
                at, answer, held, size = now, None, [], 0
            if row["chunk"] < 0:
                answer = make(row["bucket"], row["body"])
                continue
            held.append((row["chunk"], row["body"]))
            size += len(row["body"])
            if size > HELD_BYTES:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    if chunks > GROUP_CHUNKS:
        large = stage(parts_of(model, messages), "large-buckets")
        own = F.coalesce("parts", F.lit(1))
        model, messages = (t.join(large, F.col("bucket") == F.col("of"), "left").withColumn("own", own) for t in (model, messages))
    else:
        model, messages = (t.withColumn("own", F.lit(1)) for t in (model, messages))
    models = model.select("bucket", F.lit(-1).cast("long").alias("chunk"), "body",
                          F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("part"))
    part = F.pmod(F.xxhash64("chunk"), F.col("own")).cast("int")
    both = models.unionByName(messages.select("bucket", "chunk", "body", part.alias("part")))
    return (both.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "chunk")
            .mapInArrow(run, _MESSAGE))


def receive(chunks: DataFrame, replies: DataFrame, make: Callable[[dict, dict[int, bytes]], Iterator[pa.RecordBatch]],
            schema: str) -> DataFrame:
    """Bring each chunk's row and its replies (by bucket) together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, found = None, {}
        for row in rows(batches):
            if row["bucket"] < 0:
                if whole is not None:
                    yield from make(whole, found)
                whole, found = row, {}
                whole["raw"] = row["body"]
            else:
                found[row["bucket"]] = row["body"]
        if whole is not None:
            yield from make(whole, found)

    payload = chunks.withColumn("bucket", F.lit(-1)).withColumnRenamed("raw", "body")
    both = payload.unionByName(replies, allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, schema)
