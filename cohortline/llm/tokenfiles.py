"""Token-id files: fixed-size id blocks, byte planes or bit planes, zstandard.

File format (little endian throughout)::

    magic      8 bytes  b"IDPLANE1"
    chunks     for every block: its planes, each one zstandard frame
    index      zstandard frame of the JSON chunk index and document index
    footer     16 bytes: offset of the index, length of the index (u64 each)

A block holds ``block_ids`` ids (the last one of a file fewer). It is
transposed into planes: ``bytes`` mode stores one plane per used byte of the
id, ``bits`` mode one plane per used bit (bits of eight ids packed into a byte). Each
plane is compressed on its own, so the nearly constant high planes cost next
to nothing. The index lists every block (offset, ids, planes' lengths) and
the id and length of every document in the file.

Each task writes its own shard for a contiguous range of document ids under a
name of its own, and reports it in its result row. Only reported shards are
read, so a task that is run again because its executor was lost leaves an
unused file and never a half-written one.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import scratch, slices, stage

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Chunks remembered in a task; beyond it that memory starts anew.
CACHE_CHUNKS = 400_000
#: Words remembered in a worker: so many of the latest, and as many of those asked for before.
CACHE_WORDS = 300_000
LEVEL = 3


# --- blocks -----------------------------------------------------------------

def to_planes(ids: np.ndarray, mode: str = "bytes") -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, low plane first."""
    top = int(ids.max()) if len(ids) else 0
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if mode == "bytes":
        return [raw[:, b].tobytes() for b in range((top.bit_length() + 7) // 8)]
    return [np.packbits((ids >> np.uint32(b)).astype(np.uint8) & 1).tobytes() for b in range(top.bit_length())]


def from_planes(planes: list[bytes], n: int, mode: str = "bytes") -> np.ndarray:
    """The inverse of :func:`to_planes`."""
    if mode == "bytes":
        raw = np.zeros((n, 4), np.uint8)
        for b, plane in enumerate(planes):
            raw[:, b] = np.frombuffer(plane, np.uint8)
        return raw.reshape(-1).view("<u4").copy()
    out = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.uint32) << np.uint32(b)
    return out


# --- files ------------------------------------------------------------------

def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


class ShardWriter:
    """Writes one file; ids go out block by block, so memory stays bounded."""

    def __init__(self, uri: str, mode: str = "bytes", block_ids: int = BLOCK_IDS) -> None:
        fs, path = _filesystem(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.mode, self.block_ids = mode, block_ids
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.at = self.out.write(MAGIC)
        self.blocks: list[list] = []
        self.docs: list[int] = []
        self.sizes: list[int] = []
        self.held: list[np.ndarray] = []
        self.held_ids = 0
        self.n_ids = 0

    def add(self, doc_ids: list[int], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Append documents: their ids, their token counts, all their tokens."""
        self.docs += doc_ids
        self.sizes += sizes.tolist()
        self.held.append(ids)
        self.held_ids += len(ids)
        self.n_ids += len(ids)
        if self.held_ids >= self.block_ids:
            self._flush(self.held_ids // self.block_ids)

    def _flush(self, blocks: int) -> None:
        ids = np.concatenate(self.held)
        for k in range(blocks):
            block = ids[k * self.block_ids:(k + 1) * self.block_ids]
            planes = [self.zip.compress(p) for p in to_planes(block, self.mode)]
            self.blocks.append([self.at, len(block), [len(p) for p in planes]])
            for p in planes:
                self.at += self.out.write(p)
        rest = ids[blocks * self.block_ids:]
        self.held, self.held_ids = [rest], len(rest)

    def close(self) -> None:
        if self.held_ids:
            self._flush(self.held_ids // self.block_ids + 1)
        index = self.zip.compress(json.dumps({
            "mode": self.mode, "block_ids": self.block_ids, "n_ids": self.n_ids, "blocks": self.blocks,
            "docs": self.docs, "sizes": self.sizes}).encode())
        self.out.write(index)
        self.out.write(struct.pack("<QQ", self.at, len(index)))
        self.out.close()


class ShardReader:
    """Random access to the blocks of one file through its chunk index."""

    def __init__(self, uri: str) -> None:
        fs, path = _filesystem(uri)
        self.file = fs.open_input_file(path)
        self.unzip = zstandard.ZstdDecompressor()
        size = self.file.size()
        self.file.seek(0)
        if self.file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token-id file: {uri}")
        self.file.seek(size - 16)
        at, n = struct.unpack("<QQ", self.file.read(16))
        self.file.seek(at)
        self.index = json.loads(self.unzip.decompress(self.file.read(n)))

    def block(self, k: int) -> np.ndarray:
        at, n, lengths = self.index["blocks"][k]
        self.file.seek(at)
        return from_planes([self.unzip.decompress(self.file.read(x)) for x in lengths], n, self.index["mode"])

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(doc id, ids) in file order; one block and one document in memory."""
        k, held = 0, np.empty(0, np.uint32)
        for doc, n in zip(self.index["docs"], self.index["sizes"]):
            if n > len(held):
                parts, have = [held], len(held)
                while have < n:
                    parts.append(self.block(k))
                    have += len(parts[-1])
                    k += 1
                held = np.concatenate(parts)
            yield doc, held[:n]
            held = held[n:]
        self.file.close()


# --- encoding ---------------------------------------------------------------

#: Stands for the end of a document; no chunk can be a line feed.
END = "\n"
#: A chunk that is a Latin word with plain marks behind it (no apostrophe: contractions split).
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:$%&*#|]*)\Z")
_LETTERS = "".join(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))


class _Numbers(dict):
    """Numbers chunks as they are first asked for; ``new`` lists the latest."""

    def __init__(self) -> None:
        self.update({"": 0, END: 1})
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        n = self[chunk] = len(self)
        return n


class _Words(dict):
    """Ids of words, as the bytes of unsigned 32-bit numbers; the words that were not asked
    for since the last ``limit`` new ones are dropped."""

    def __init__(self, learn: Callable[[str], bytes], limit: int) -> None:
        self.learn, self.limit, self.before = learn, limit, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word) or self.learn(word)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts chunk by chunk between ASCII white space.

    The tokenizer's normaliser and splitter never join characters across
    white space, so the ids of a text are those of its chunks in order; each
    distinct chunk is encoded once while it is remembered. The splitter also
    parts letters from marks and lower-cases, so a Latin word is encoded once for all
    its capitals and marks, by the tokenizer's model directly; all other
    chunks take the whole tokenizer. Words are remembered apart from chunks and beyond a
    task: a chunk of a known word is put together again without the tokenizer.
    """

    def __init__(self, path: str, end_id: int = END_ID, limit: int = CACHE_CHUNKS, words: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): spell(c)[0][0] for c in _LETTERS}
        self.end_id, self.limit = end_id, limit
        self.words = _Words(self._word, words)
        self.forget()

    def forget(self) -> None:
        """Start with no chunks in memory."""
        self.known = _Numbers()
        self.tails: dict[str, bytes] = {"": b""}
        self.flat = np.array([self.end_id], np.uint32)
        self.start = np.zeros(2, np.int64)
        self.size = np.array([0, 1], np.int64)

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.translate(self.spelling)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _whole(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for at in range(0, len(chunks), 20000)
                for e in self.tokenizer.encode_batch_fast(chunks[at:at + 20000], add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> None:
        found = [_LATIN.match(c) for c in chunks]
        tails, words = self.tails, self.words
        new = [t for t in {m[2] for m in found if m} if t not in tails]
        tails.update(zip(new, self._whole(new)))
        others = iter(self._whole([c for c, m in zip(chunks, found) if m is None]))
        ids = []
        for m in found:
            if m is None:
                ids.append(next(others))
                continue
            word, tail = m.groups()
            ids.append(words[word.lower()] + tails[tail])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, np.frombuffer(b"".join(ids), np.uint32))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per text, all tokens); every text ends with the end id."""
        if len(self.known) > self.limit:
            self.forget()
        chunks = [c for t in texts
                  for c in (*t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "), END)]
        at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        if new := self.known.new:
            self._learn(new)
            self.known.new = []
        size = self.size[at]
        end = np.cumsum(size)
        out = self.flat[np.repeat(self.start[at] - end + size, size) + np.arange(end[-1] if len(end) else 0)]
        return np.diff(end[at == 1], prepend=0), out


@cache
def encoder(path: str, end_id: int) -> WordEncoder:
    """One tokenizer per Python worker; the chunks it remembers last for a task."""
    return WordEncoder(path, end_id)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- jobs -------------------------------------------------------------------

def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER, end_id: int = END_ID, mode: str = "bytes",
                 block_ids: int = BLOCK_IDS, order: list[Column] | None = None) -> DataFrame:
    """Write the tokens of ``docs``; returns the shards.

    ``(shard, uri, n_docs, n_ids)`` with the shards numbered in document order:
    by ascending id, or by the values of ``order``, ascending. A null or empty text is just
    the end id. Rows with equal ids (ties, repeated rows) are all written, next to
    each other, ordered by a hash of the text and the text, so an id with very many
    texts is several tasks' and files'; a null id sorts first and is stored as null.
    Other columns are ignored. An empty table writes nothing and has no shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        for batch in slices(batches, 256):
            if writer is None:
                uri = f"{folder}/{uuid.uuid4().hex}.idp"
                writer, encode = ShardWriter(uri, mode, block_ids), encoder(tokenizer_path(tokenizer), end_id)
            sizes, tokens = encode([t or "" for t in batch.column(1).to_pylist()])
            writer.add(batch.column(0).to_pylist(), sizes, tokens)
        if writer is not None:
            writer.close()
            encode.forget()
            yield pa.RecordBatch.from_pylist([{"shard": TaskContext.get().partitionId(), "uri": uri,
                                               "n_docs": len(writer.docs), "n_ids": writer.n_ids}], schema=arrow)

    arrow = pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    given = [c.alias(f"o{k}") for k, c in enumerate(order or [])]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), *given)
    by = [F.col(f"o{k}") for k in range(len(given))] or [F.col("id").asc_nulls_first(), F.xxhash64("t")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by, "t").select("id", "t")
    return stage(ordered.mapInArrow(run, "shard int, uri string, n_docs long, n_ids long"), "shards")


def read_tokens(shards: DataFrame) -> DataFrame:
    """Per document of the files: ``(id, start, n_tokens, ids_crc32)``.

    ``start`` counts the ids of all documents before it in the whole file
    set. The shard list (one row per written file) is what is numbered, never the documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(batch.column(c).to_pylist() for c in ("uri", "base"))):
                rows: tuple[list, ...] = ([], [], [], [])
                for doc, ids in ShardReader(uri).documents():
                    for column, value in zip(rows, (doc, base, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                    base += len(ids)
                    if len(rows[0]) == 20000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)
                        rows = ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=names)

    names = ["id", "start", "n_tokens", "ids_crc32"]
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.select("uri", "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = based.repartition(max(1, shards.count()), "shard")  # a task per file, however short the list
    return spread.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the files into the shared folder and read every document back."""
    return read_tokens(write_tokens(docs, scratch(spark, "tokens"), **options))


def op4_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of ``documents``, as read back (contract of the query)."""
    read = token_files(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return read.withColumnRenamed("id", "doc_id")
