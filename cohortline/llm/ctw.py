"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; decision k of a byte depends on the bits
before it (a node 1..255) and on the bytes before it, up to ``DEPTH``. Every
(context, node) pair has a Krichevsky-Trofimov estimate from its counts in the
training texts, and the estimates of all depths 0..DEPTH are weighted as in
Willems, Shtarkov and Tjalkens: a context either stops, or splits by the byte
before it, each with probability 1/2. With the counts fixed, the
predictive probability of a bit is the mixture along its path, weighted by how
well stopping and splitting explained the training texts. A text is its
lower-cased UTF-8 bytes and an end symbol, so probabilities of texts add up to
at most one, and -log2 per byte is a code length.

How it runs: documents are packed into chunks of some megabytes. A chunk sorts
its context+symbol strings ("grams", DEPTH + 1 bytes in one integer) and asks for
each distinct one once, with its training count. Grams are routed by the two
bytes before the symbol; a bucket of them merges the counts of all chunks,
builds its part of the tree, and answers each chunk's grams with log
probabilities. Depths 0 and 1 lie above all buckets; they are computed from the buckets'
roots (at most 2^16 contexts). The chunk then adds up its documents. Nothing
is pruned, and no table of the corpus is broadcast. Word counts for the
unigram baseline travel the same way.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import stage
from cohortline.llm.exchange import CHUNK_BYTES, dump, gather, load, pack, pieces, receive, reply, rows, send, texts_of

#: Bytes of context (at most 7).
DEPTH = 6
END = 0xFF  # never a byte of UTF-8; also stands before the start of a text
LOW = 2     # contexts of this many bytes are the buckets' roots
LN2, LN10, LNPI = log(2), log(10), log(np.pi)


# --- the tree ----------------------------------------------------------------

_SMALL = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 4096)))])  # ln n!
_HALVES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(4095) + 0.5))])  # ln prod_{i<n} (i + 1/2)


def _log_rising(n: np.ndarray, small: np.ndarray, shift: float) -> np.ndarray:
    """ln Gamma(n + shift) / Gamma(shift) for whole n (shift 1/2 or 1)."""
    out = small[np.minimum(n, 4095).astype(np.int64)]
    big = n > 4095
    if big.any():
        x = n[big] + shift
        out[big] = ((x - 0.5) * np.log(x) - x + 0.5 * log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
                    - (0.5 * LNPI if shift == 0.5 else 0.0))
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_rising(n0, _HALVES, 0.5) + _log_rising(n1, _HALVES, 0.5) - _log_rising(n0 + n1, _SMALL, 1.0)


class Level:
    """The nodes of one bit position at one depth, sorted by (context, node)."""

    __slots__ = ("key", "n0", "n1", "stop", "log_w")

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: Level | None) -> None:
        self.key, self.n0, self.n1 = key, n0, n1
        estimate = log_kt(n0, n1)
        if below is None:
            self.log_w, self.stop = estimate, np.ones(len(key))
            return
        up = np.searchsorted(key, ((below.key >> np.uint64(16)) << np.uint64(8)) | (below.key & np.uint64(255)))
        split = np.bincount(up, below.log_w, minlength=len(key))
        self.log_w = np.logaddexp(estimate, split) - LN2
        self.stop = np.exp(np.minimum(estimate - LN2 - self.log_w, 0.0))

    def mix(self, want: np.ndarray, bit: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The mixture one depth up: q is the probability from deeper contexts."""
        if not len(self.key):
            return q
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        seen = self.key[at] == want
        n0, n1 = self.n0[at], self.n1[at]
        estimate = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
        stop = self.stop[at]
        return np.where(seen, stop * estimate + (1 - stop) * q, q)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(counts[order], start)


def depths(keys: np.ndarray, counts: np.ndarray, depth: int, low: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(grams, counts) at depth ``depth``, ..., ``low``: the farthest byte goes at each step."""
    out = [(keys, counts)]
    for _ in range(depth - low):
        k, n = out[-1]
        out.append(merged(((k >> np.uint64(16)) << np.uint64(8)) | (k & np.uint64(255)), n))
    return out


def nodes(grams: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """((context, node) keys, bits) of decision k of each gram's symbol."""
    symbol = grams & np.uint64(255)
    node = (symbol >> np.uint64(8 - k)) | np.uint64(1 << k)
    return ((grams >> np.uint64(8)) << np.uint64(8)) | node, (symbol >> np.uint64(7 - k)) & np.uint64(1)


def levels(by_depth: list[tuple[np.ndarray, np.ndarray]], k: int, below: Level | None = None) -> list[Level]:
    """Decision k's levels from the deepest depth up."""
    out = []
    for grams, counts in by_depth:
        key, bit = nodes(grams, k)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        total = np.add.reduceat(counts, start) if len(key) else counts
        ones = np.add.reduceat(counts * bit.astype(np.float64), start) if len(key) else counts
        below = Level(key[start], total - ones, ones, below)
        out.append(below)
    return out


class Top:
    """Depths 1 and 0 of all eight decisions, from the buckets' roots."""

    def __init__(self, roots: list[tuple[np.ndarray, ...]]) -> None:
        self.levels: list[list[Level]] = []
        for key, n0, n1, log_w in roots:
            order = np.argsort(key)
            below = Level.__new__(Level)
            below.key, below.log_w = key[order], log_w[order]
            n0, n1 = n0[order], n1[order]
            own = []
            for _ in range(LOW):
                up, at = np.unique(((below.key >> np.uint64(16)) << np.uint64(8)) | (below.key & np.uint64(255)),
                                   return_inverse=True)
                n0, n1 = np.bincount(at, n0, minlength=len(up)), np.bincount(at, n1, minlength=len(up))
                below = Level(up, n0, n1, below)
                own.append(below)
            self.levels.append(own)


def log10_probability(asked: np.ndarray, by_depth: list[tuple[np.ndarray, np.ndarray]], top: Top) -> np.ndarray:
    """log10 of the probability of each asked gram's symbol after its context."""
    out = np.zeros(len(asked))
    for k in range(8):
        q = np.full(len(asked), 0.5)
        grams = asked
        for level in [*levels(by_depth, k), *top.levels[k]]:
            want, bit = nodes(grams, k)
            q = level.mix(want, bit > 0, q)
            grams = ((grams >> np.uint64(16)) << np.uint64(8)) | (grams & np.uint64(255))
        out += np.log10(q)
    return out


# --- chunks ------------------------------------------------------------------

def grams_of(texts: list[bytes], depth: int) -> np.ndarray:
    """The gram of every byte and end symbol of the texts, in order: nearest
    context byte first, the symbol last."""
    pad = bytes([END]) * depth
    a = np.frombuffer(b"".join(x for t in texts for x in (pad, t, pad[:1])), np.uint8)
    if not len(a):
        return np.empty(0, np.uint64)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + depth + 1
    own = np.ones(len(a), bool)
    begin = np.cumsum(size) - size
    own[(begin[:, None] + np.arange(depth)).ravel()] = False
    key = a[depth - 1:-1].astype(np.uint64)
    for j in range(2, depth + 1):
        key <<= np.uint64(8)
        key |= a[depth - j:len(a) - j]
    key <<= np.uint64(8)
    key |= a[depth:]
    return key[own[depth:]]


def bucket_of(grams: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    root = grams >> np.uint64(8 * (depth + 1 - LOW))
    return ((root * np.uint64(40503)) >> np.uint64(5)) % np.uint64(buckets)


def distinct_grams(texts: list[bytes], learn: list[bool], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's distinct grams, sorted, and their counts in the texts to learn from."""
    parts = []
    for places in pieces(texts):
        for y in (True, False):
            own = [texts[i] for i in places if learn[i] == y]
            if own:
                g = grams_of(own, depth)
                g.sort()
                start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                n = np.diff(np.append(start, len(g))) if y else np.zeros(len(start), np.int64)
                parts.append((g[start], n))
    return merged(*map(np.concatenate, zip(*parts))) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def word_bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def words_of(texts: list[bytes], learn: list[bool]) -> Counter:
    """Counts of the words to learn from; words of the other texts count zero."""
    counts: Counter = Counter()
    for t, y in zip(texts, learn):
        if y:
            counts.update(t.split())
    for t, y in zip(texts, learn):
        if not y:
            for w in set(t.split()):
                if w not in counts:
                    counts[w] = 0
    return counts


def requests(row: dict, depth: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """What a chunk asks each bucket: its distinct grams, and (in the buckets from
    ``buckets`` up) its words, with their training counts."""
    texts, learn = texts_of(row["sizes"], row["raw"]), row["flags"]
    keys, counts = distinct_grams(texts, learn, depth)
    where = bucket_of(keys, depth, buckets)
    for b in np.unique(where):
        own = where == b
        yield int(b), dump(np.diff(keys[own], prepend=np.uint64(0)), counts[own].astype(np.int64))
    words = words_of(texts, learn)
    split: dict[int, list[bytes]] = {}
    for w in words:
        split.setdefault(word_bucket(w, buckets), []).append(w)
    for b, own in split.items():
        yield buckets + b, dump(b"\n".join(own), np.array([words[w] for w in own], np.int64))


def merge(bucket: int, bodies: list[bytes], buckets: int) -> bytes:
    """Summed counts of a bucket's grams or words."""
    got = [load(b) for b in bodies]
    if bucket < buckets:
        u, n = merged(np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in got]), np.concatenate([n for _, n in got]))
        return dump(np.diff(u, prepend=np.uint64(0)), n)
    total: Counter = Counter()
    for words, n in got:
        for w, c in zip(words.split(b"\n"), n.tolist()):
            total[w] += c
    return dump(b"\n".join(total), np.fromiter(total.values(), np.int64, len(total)))


def training_grams(body: bytes, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A bucket's grams that training texts have, at every depth."""
    delta, n = load(body)
    seen = n > 0
    return depths(np.cumsum(delta, dtype=np.uint64)[seen], n[seen].astype(np.float64), depth, LOW)


def roots(model: DataFrame, depth: int, buckets: int) -> DataFrame:
    """``(roots, tokens, types)`` per bucket: the roots of a gram bucket's tree, or
    the sums of a word bucket's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            blob, tokens, types = b"", 0, 0
            if row["bucket"] < buckets:
                by_depth = training_grams(row["body"], depth)
                tops = [levels(by_depth, k)[-1] for k in range(8)]
                blob = dump(*(x for t in tops for x in (t.key, t.n0, t.n1, t.log_w)))
            else:
                n = load(row["body"])[1]
                tokens, types = int(n.sum()), int(np.count_nonzero(n))
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary()), pa.array([tokens], pa.int64()),
                                              pa.array([types], pa.int64())], names=["roots", "tokens", "types"])

    return model.mapInArrow(run, "roots binary, tokens long, types long")


def read_roots(blobs: list[bytes]) -> list[tuple[np.ndarray, ...]]:
    """Per decision the concatenated (key, n0, n1, log_w) of all buckets."""
    empty = (np.empty(0, np.uint64), *(np.empty(0) for _ in range(3)))
    got = [load(b) for b in blobs]
    return [tuple(np.concatenate(x) for x in zip(empty, *(g[4 * k:4 * k + 4] for g in got))) for k in range(8)]


def answer(bucket: int, body: bytes, depth: int, buckets: int, top: Top) -> Callable[[list[bytes]], list[bytes]]:
    """A function from requests to log10 probabilities (grams) or training counts (words)."""
    if bucket < buckets:
        by_depth = training_grams(body, depth)

        def grams(bodies: list[bytes]) -> list[bytes]:
            keys = [np.cumsum(load(b)[0], dtype=np.uint64) for b in bodies]
            u = np.unique(np.concatenate(keys))
            p = np.concatenate([log10_probability(u[a:a + 200_000], by_depth, top) for a in range(0, len(u), 200_000)])
            p = p.astype("<f4")
            return [dump(p[np.searchsorted(u, k)]) for k in keys]

        return grams
    words, n = load(body)
    total = dict(zip(words.split(b"\n"), n.tolist()))
    return lambda bodies: [dump(np.array([total[w] for w in load(b)[0].split(b"\n")], np.int64)) for b in bodies]


class Lookup:
    """Positions of grams among sorted distinct ones: a table by hash, which the
    frequent grams win, and binary search for the rest."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(10, int(len(keys)).bit_length() + 1)
        self.table = np.zeros(1 << self.bits, np.int32)
        order = np.argsort(counts, kind="stable")
        self.table[self._slot(keys[order])] = order

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(keys)]
        off = np.flatnonzero(self.keys[at] != keys)
        at[off] = np.searchsorted(self.keys, keys[off])
        return at


def score_chunk(texts: list[bytes], learn: list[bool], found: dict[int, bytes], depth: int, buckets: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(log10 probability, words, known words, sum of log10(c + 1/2)) per text."""
    keys, counts = distinct_grams(texts, learn, depth)
    where = bucket_of(keys, depth, buckets)
    p = np.zeros(len(keys))
    for b in np.unique(where):
        p[where == b] = load(found[int(b)])[0]
    lookup = Lookup(keys, counts)
    score = np.zeros(len(texts))
    for places in pieces(texts):
        own = [texts[i] for i in places]
        values = p[lookup(grams_of(own, depth))]
        size = np.fromiter(map(len, own), np.int64, len(own)) + 1
        score[places] = np.add.reduceat(values, np.cumsum(size) - size)
    known: dict[bytes, int] = {}
    split: dict[int, list[bytes]] = {}
    for w in words_of(texts, learn):
        split.setdefault(word_bucket(w, buckets), []).append(w)
    for b, own in split.items():
        known.update(zip(own, load(found[buckets + b])[0].tolist()))
    n, hits, base = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for i, t in enumerate(texts):
        c = np.fromiter(map(known.__getitem__, w := t.split()), np.float64, len(w))
        n[i], hits[i], base[i] = len(c), np.count_nonzero(c), np.log10(c + 0.5).sum()
    return score, n, hits, base


def language_model(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_symbols, n_tokens, n_known, train_tokens,
    base_score, score)``.

    The model learns from the rows for which ``learn`` is true (null is false)
    and scores all. Null and empty texts are the end symbol alone. Rows are
    never merged, repeated or null ids included; other columns are ignored. Without a row to
    learn from, every bit has probability 1/2 and ``train_tokens`` is 0.
    """
    chunks = stage(pack(docs, id_col, text_col, learn, True, chunk_bytes), "chunks")
    count = chunks.count()
    buckets = min(4096, max(64, count))
    sent = send(chunks, lambda row: requests(row, depth, buckets), "requests")
    model = gather(sent, lambda bucket, bodies: merge(bucket, bodies, buckets), count, "counts")
    # The roots are at most 2^16 contexts with 255 nodes each, whatever the corpus.
    got = roots(model, depth, buckets).collect()
    top = Top(read_roots([bytes(r.roots) for r in got if r.roots]))
    learned = chunks.select(F.sum(F.size(F.filter("flags", lambda x: x)))).first()[0] or 0
    total, types = sum(r.tokens for r in got) + learned, sum(r.types for r in got) + (learned > 0)
    scale = float(np.log10(total + 0.5 * (types + 1)))
    end = float(np.log10(learned + 0.5))

    def scored(row: dict, found: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        texts = texts_of(row["sizes"], row["raw"])
        score, n, known, base = score_chunk(texts, row["flags"], found, depth, buckets)
        n += 1
        known += learned > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], pa.int64()), pa.array([len(t) + 1 for t in texts], pa.int64()), pa.array(n),
             pa.array(known), pa.array(np.full(len(n), total)), pa.array(base + end - n * scale), pa.array(score)],
            names=["id", "n_symbols", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    replies = reply(model, sent, lambda bucket, body: answer(bucket, body, depth, buckets, top), count)
    return receive(chunks, replies, scored, "id long, n_symbols long, n_tokens long, n_known long, "
                                            "train_tokens long, base_score double, score double")


def op2_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability (contract of the query). Rows without an id are learned from."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    scored = language_model(spark.read.parquet(f"{sf_dir}/documents.parquet"), ~held).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score", (-F.col("score") / np.log10(2).item() / F.col("n_symbols")).alias("bits_per_byte"))
