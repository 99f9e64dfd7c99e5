"""Alignment of two tokenisations of the same texts.

Tokeniser A is a byte-level BPE, B a piece BPE with byte fallback. Both cut the bytes of
space + text into tokens. Places where a token of A and one of B both end cut a
document into groups; tokens of A and B that overlap are linked. How much a link is worth is the number of
documents of the whole corpus that hold its pair of ids linked.

Whitespace-token anchors: after the full tokenisation, a place where both tokenisers end a token and both go on
with a space-marked one is an anchor. The byte offsets are compared, never assumed.
Anchors split a document into windows of token ids, mostly a word each; a window's groups and links depend on its two id
tuples only and are remembered by them.

Tokenising is what costs. The tokens of a text with plain white space are those of its words,
as neither tokeniser has a token across the place before a space or around a line feed (:class:`Tokens` checks the vocabularies), so
a word is tokenised once while it is remembered. Every other text is tokenised as a whole.

On Spark: a task packs its documents into chunks of about CHUNK_LINKS different (document, pair)
entries and writes each chunk's different pairs, with its documents per pair, beside a packed
list of entries. Pairs are counted over all chunks by one aggregation; a join brings each chunk the counts of its own pairs,
so no task and no driver ever holds the table of all pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import slices, stage
from cohortline.llm.exchange import dump, load

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Different (document, pair) entries in a chunk, about; a longer document is a chunk of its own.
CHUNK_LINKS = 1 << 20
#: Words and windows remembered in a task; beyond it the memory starts anew.
KNOWN_WORDS = 700_000
KNOWN_WINDOWS = 700_000
#: Characters of the texts that are in hand at a time (one text at least).
HELD_CHARS = 2_000_000

#: Stands for the end of a text; no word has a space.
_END = " "
_LINE = "\n"
#: A word of Latin letters and the marks behind it, which no token of either tokeniser joins.
_MARKS = ".,!?;:$%&*#|"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LATIN = re.compile(rf"([{_LETTERS}]+)([{re.escape(_MARKS)}]*)\Z")
_WHITE = re.compile(r"\s")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class _Numbers(dict):
    """Numbers keys as they are first asked for; ``new`` lists the latest."""

    def __init__(self, *first) -> None:
        self.update({k: n for n, k in enumerate(first)})
        self.new: list = []

    def __missing__(self, key) -> int:
        self.new.append(key)
        n = self[key] = len(self)
        return n

    def take_new(self) -> list:
        new, self.new = self.new, []
        return new


def _pick(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start[i]:start[i] + size[i]]``, one after the other."""
    end = np.cumsum(size)
    return flat[np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class _Lists:
    """Lists of whole numbers, appended many at a time and picked by number."""

    def __init__(self, dtype) -> None:
        self.flat, self.start, self.size = np.empty(0, dtype), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, flat.astype(self.flat.dtype))

    def pick(self, at: np.ndarray) -> np.ndarray:
        return _pick(self.flat, self.start[at], self.size[at])


class Tokens:
    """Both tokenisations of texts: token ids of space + text (A) and of text, to which B adds the space."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, n in names.items():
            self.bytes_a[n] = bytes(map(letters.get, name)) if all(c in letters for c in name) else name.encode()
        pieces = [self.b.id_to_piece(n) for n in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode()
                        for n, p in enumerate(pieces)]
        self.len_a = np.array([len(t) for t in self.bytes_a])
        self.len_b = np.array([len(t) for t in self.bytes_b])
        self.space_a = np.array([t[:1] == b" " for t in self.bytes_a])
        self.space_b = np.array([t[:1] == b" " for t in self.bytes_b])
        self.line_a, self.line_b = (x.index(b"\n") for x in (self.bytes_a, self.bytes_b))
        # What lets words stand for texts: B has no piece with a space behind another character or with a line feed
        # (A's splitter has none by its rule), and none with a mark behind a letter.
        self.words = not any("▁" in p.lstrip("▁") or _LINE in p for p in pieces)
        self.marks = not any(re.search(rf"[{_LETTERS}][{re.escape(_MARKS)}]", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Start with an empty memory."""
        # The empty word stands for doubled, leading or closing spaces, the end mark for no tokens at all.
        self.known = _Numbers("", _END)
        self.odd = np.array([True, False])
        self.of_a, self.of_b = _Lists(np.uint16), _Lists(np.uint16)
        for lists in (self.of_a, self.of_b):
            lists.add(np.empty(0), np.zeros(2, np.int64))
        self.atoms = _Numbers()
        self.atom_bad = np.empty(0, bool)
        self.atom_a, self.atom_b = _Lists(np.uint16), _Lists(np.uint16)

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Both tokenisations of one text as it is; empty where the bytes of either differ from space + text."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            a = b = []
        return np.array(a, np.uint16), np.array(b, np.uint16)

    def _learn_atoms(self, atoms: list[str]) -> None:
        """Tokens of pieces of text without white space but a first space, many in one text, a line each."""
        for at in range(0, len(atoms), 20_000):
            some = atoms[at:at + 20_000]
            lines = [_LINE + _LINE.join(some[k:k + 200]) for k in range(0, len(some), 200)]
            a = np.fromiter(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(lines, add_special_tokens=False)), np.int64)
            b = np.array(self.b.encode("".join(lines))[1:])  # without the space that B adds
            sizes = []
            for ids, line, lists in ((a, self.line_a, self.atom_a), (b, self.line_b, self.atom_b)):
                cut = np.flatnonzero(ids == line)
                if len(cut) != len(some):
                    raise AssertionError("a line is not a token of its own")
                size = np.diff(np.append(cut, len(ids))) - 1
                lists.add(ids[ids != line], size)
                sizes.append(size)
            # The bytes of every atom have to come out of both.
            raw = [s.encode() for s in some]
            bad = np.zeros(len(some), bool)
            for ids, size, names, line in ((a, sizes[0], self.bytes_a, self.line_a), (b, sizes[1], self.bytes_b, self.line_b)):
                out = b"".join(map(names.__getitem__, ids.tolist()))
                if out != b"\n" + b"\n".join(raw):
                    parts = iter(out.split(b"\n")[1:])
                    bad |= np.array([next(parts) != r for r in raw])
            self.atom_bad = np.append(self.atom_bad, bad)

    def _learn(self, words: list[str]) -> None:
        parts: list[list[str]] = []
        odd = np.zeros(len(words), bool)
        for k, word in enumerate(words):
            line = word[:1] == _LINE
            body = word[1:] if line else word
            if _WHITE.search(body):
                odd[k] = True
                parts.append([])
                continue
            found = _LATIN.match(body) if self.marks else None
            atoms = [*found.groups()] if found else [body]
            if not line:
                atoms[0] = " " + atoms[0]
            parts.append([_LINE, *filter(None, atoms)] if line else [x for x in atoms if x])
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter(map(self.atoms.__getitem__, chain.from_iterable(parts)), np.int64, int(n.sum()))
        new = self.atoms.take_new()
        if _LINE in new:
            # A line feed is an atom of its own with one token of either kind.
            before = [x for x in new if x != _LINE]
            k = new.index(_LINE)
            self._learn_atoms(new[:k])
            self.atom_a.add(np.array([self.line_a]), np.array([1]))
            self.atom_b.add(np.array([self.line_b]), np.array([1]))
            self.atom_bad = np.append(self.atom_bad, False)
            self._learn_atoms(before[k:])
        elif new:
            self._learn_atoms(new)
        owner = np.repeat(np.arange(len(parts)), n)
        odd |= np.bincount(owner, self.atom_bad[at], len(parts)) > 0
        for atoms, lists in ((self.atom_a, self.of_a), (self.atom_b, self.of_b)):
            lists.add(atoms.pick(at), np.bincount(owner, atoms.size[at], len(parts)).astype(np.int64))
        self.odd = np.append(self.odd, odd)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens of A per text, all of them, tokens of B per text, all of them). Empty texts have none."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        if not self.words:
            whole = [self.whole(t) if t else (np.empty(0, np.uint16),) * 2 for t in texts]
            return tuple(x for side in zip(*whole) for x in (np.array([len(i) for i in side]), np.concatenate(side)))
        # A line feed begins a word without a space before it.
        words = [w for t in texts for w in (*(t.replace(_LINE, " \n").split(" ") if t else ()), _END)]
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if new := self.known.take_new():
            self._learn(new)
        ends = np.flatnonzero(at == 1)
        text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=-1))
        odd = np.bincount(text, self.odd[at], len(texts)) > 0
        odd |= np.fromiter(("\n\n" in t for t in texts), bool, len(texts))
        keep = ~odd[text]
        out = []
        for lists in (self.of_a, self.of_b):
            sizes = np.bincount(text[keep], lists.size[at[keep]], len(texts)).astype(np.int64)
            out += [sizes, lists.pick(at[keep])]
        if odd.any():
            own = {k: self.whole(texts[k]) for k in np.flatnonzero(odd).tolist()}
            for side in (0, 1):
                sizes, flat = out[2 * side], out[2 * side + 1]
                starts = np.cumsum(sizes)
                pieces, last = [], 0
                for k in sorted(own):
                    pieces += [flat[last:starts[k]], own[k][side]]
                    last = starts[k]
                    sizes[k] = len(own[k][side])
                out[2 * side + 1] = np.concatenate([*pieces, flat[last:]])
        return tuple(out)


class Windows:
    """Groups and links of windows, remembered by their two tuples of ids."""

    def __init__(self, tokens: Tokens) -> None:
        self.tokens = tokens
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.text: list[bytes] = []
        self.groups = np.empty(0, np.int64)
        #: A pair of linked ids is a << 16 | b.
        self.links = _Lists(np.uint32)

    def _learn(self, a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> None:
        """Align windows, given by their tokens one window after the other."""
        t = self.tokens
        end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
        close = end_a[np.cumsum(size_a) - 1]  # the last byte of every window; B's is the same
        cuts = np.union1d(end_a, end_b)  # between two cuts lies the overlap of one token of A and one of B
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        pairs = a[at_a].astype(np.uint32) << np.uint32(16) | b[at_b]
        self.links.add(pairs, np.diff(np.searchsorted(cuts, close, "right"), prepend=0))
        shared = cuts[(end_a[at_a] == cuts) & (end_b[at_b] == cuts)]
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        stop_a, stop_b = (np.searchsorted(e, shared) + 1 for e in (end_a, end_b))
        groups, i, j = [], 0, 0
        for x, y in zip(stop_a.tolist(), stop_b.tolist()):
            groups.append(f"{','.join(names_a[i:x])}|{','.join(names_b[j:y])}")
            i, j = x, y
        stop = np.searchsorted(shared, close, "right")
        self.groups = np.append(self.groups, np.diff(stop, prepend=0))
        k = 0
        for x in stop.tolist():
            self.text.append(";".join(groups[k:x]).encode())
            k = x

    def __call__(self, n_a: np.ndarray, a: np.ndarray, n_b: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text of each window, number of the window) of tokenised texts."""
        if len(self.known) > KNOWN_WINDOWS:
            self.forget()
        t = self.tokens
        len_a, len_b = t.len_a[a], t.len_b[b]
        start_a, start_b = np.cumsum(len_a) - len_a, np.cumsum(len_b) - len_b
        # Anchors: both end a token and both go on with a space-marked one. A text begins a window in any case.
        first = np.zeros(len(a), bool)
        first[(np.cumsum(n_a) - n_a)[n_a > 0]] = True
        marked = np.flatnonzero(first | t.space_a[a])
        in_b = np.searchsorted(start_b, start_a[marked])
        good = first[marked]
        if len(b):
            there = np.minimum(in_b, len(b) - 1)
            good = good | (start_b[there] == start_a[marked]) & t.space_b[b[there]]
        from_a, from_b = marked[good], in_b[good]
        to_a, to_b = np.append(from_a[1:], len(a)), np.append(from_b[1:], len(b))
        text = np.searchsorted(np.cumsum(n_a), from_a, "right")
        raw_a, raw_b = a.astype("<u2").tobytes(), b.astype("<u2").tobytes()
        keys = [raw_a[i:j] + b"\xff\xff" + raw_b[k:m] for i, j, k, m in zip(
            (2 * from_a).tolist(), (2 * to_a).tolist(), (2 * from_b).tolist(), (2 * to_b).tolist())]
        old = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        if new := len(self.known.take_new()):
            where = np.empty(new, np.int64)
            fresh = np.flatnonzero(at >= old)[::-1]
            where[at[fresh] - old] = fresh  # the first of equal ones is assigned last
            size_a, size_b = (to_a - from_a)[where], (to_b - from_b)[where]
            self._learn(_pick(a, from_a[where], size_a), size_a, _pick(b, from_b[where], size_b), size_b)
        return text, at


@cache
def _aligner(path_a: str, path_b: str) -> Windows:
    """One pair of tokenisers per Python worker; what they remember lasts for a task."""
    return Windows(Tokens(path_a, path_b))


# --- jobs -----------------------------------------------------------------------

_DOC = ("n_a", "n_b", "n_groups", "n_links")


def _entries(text: np.ndarray, window: np.ndarray, links: _Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links) of the different pairs of each text."""
    known = len(links.size)
    key, times = np.unique(text * known + window, return_counts=True)
    own, at = key // known, key % known
    size = links.size[at]
    key, back = np.unique(np.repeat(own, size) << 32 | links.pick(at).astype(np.int64), return_inverse=True)
    return key >> 32, key & 0xFFFFFFFF, np.bincount(back, np.repeat(times, size), len(key)).astype(np.int64)


class _Chunk:
    """Documents and their entries until they are written as one row."""

    def __init__(self) -> None:
        self.ids: list = []
        self.columns: list[np.ndarray] = []
        self.sums: list[bytes] = []
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.entries = 0

    def row(self) -> dict:
        pairs, at, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        size = np.concatenate(self.sizes)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        blob = dump(ids, np.array([i is None for i in self.ids], np.uint8), np.concatenate(self.columns, axis=1).ravel(),
                    b"".join(self.sums), size, np.diff(at.astype(np.int32), prepend=np.int32(0)),
                    np.concatenate(self.links).astype(np.uint32))
        return {"chunk": uuid.uuid4().hex, "pairs": pairs, "in_docs": docs, "blob": blob}


def _align(paths: tuple[str, str]):
    kinds = pa.schema([("chunk", pa.string()), ("pairs", pa.list_(pa.int64())), ("in_docs", pa.list_(pa.int64())),
                       ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _aligner(*paths)
        chunk = _Chunk()

        def add(ids: list, texts: list[str]) -> None:
            n_a, a, n_b, b = windows.tokens(texts)
            text, at = windows(n_a, a, n_b, b)
            groups = np.bincount(text, windows.groups[at], len(texts)).astype(np.int64)
            own, pairs, links = _entries(text, at, windows.links)
            n_links = np.bincount(own, links, len(texts)).astype(np.int64)
            stop = np.cumsum(np.bincount(text, minlength=len(texts))).tolist()
            names = list(map(windows.text.__getitem__, at.tolist()))
            chunk.sums += [hashlib.sha256(b";".join(names[i:j])).digest() if j > i else b"\0" * 32
                           for i, j in zip([0, *stop], stop)]
            chunk.ids += ids
            chunk.columns.append(np.stack([n_a, n_b, groups, n_links]))
            chunk.sizes.append(np.bincount(own, minlength=len(texts)))
            chunk.pairs.append(pairs)
            chunk.links.append(links)
            chunk.entries += len(pairs)

        def write() -> pa.RecordBatch:
            nonlocal chunk
            out, chunk = chunk.row(), _Chunk()
            return pa.RecordBatch.from_arrays([pa.array([out[f.name]], f.type) for f in kinds], schema=kinds)

        for batch in slices(batches, 256):
            ids, texts, held, size = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, 0
            for k, text in enumerate(texts):
                size += len(text)
                if size >= HELD_CHARS or k == len(texts) - 1:
                    add(ids[held:k + 1], texts[held:k + 1])
                    held, size = k + 1, 0
                    if chunk.entries >= CHUNK_LINKS:
                        yield write()
        if chunk.ids:
            yield write()
        windows.forget()
        windows.tokens.forget()

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of chunks, from their packed entries and the counts of their pairs."""
    for batch in slices(batches, 1):
        blob, answers = batch.column(0)[0].as_py(), batch.column(1)[0]
        ids, null, columns, sums, size, steps, links = load(blob)
        counts, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if answers.is_valid and len(answers.values):
            counts = answers.values.field("n").to_numpy(zero_copy_only=False)
            best = answers.values.field("best").to_numpy(zero_copy_only=False).astype(np.int64)
        at, links, stop = np.cumsum(steps), links.astype(np.int64), np.cumsum(size)

        def per_doc(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values))
            return total[stop] - total[stop - size]

        columns = columns.reshape(len(_DOC), -1)
        columns = [*columns, per_doc(links * best[at]), per_doc(links * counts[at])]
        names = [sums[32 * k:32 * k + 32].hex() if n else "" for k, n in enumerate(columns[0].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=null.astype(bool)), *(pa.array(c, pa.int64()) for c in columns), pa.array(names, pa.string())],
            names=["id", *_DOC, "n_best", "count_sum", "groups_sha256"])


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B)


class Alignment:
    """The aligned corpus: ``chunks`` as written, ``pairs`` with their counts, and the documents' digests."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 paths: tuple[str, str] | None = None) -> None:
        """Tokenise and align ``docs`` and write the chunks into the shared folder.

        A null or empty text, and one whose bytes either tokeniser does not give back, has no tokens. Rows
        with equal ids, repeated rows and null ids are documents like any other. Other
        columns are ignored; an empty table has no chunks.
        """
        rows = docs.select(F.col(id_col).cast("long").alias("id"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        self.chunks = stage(rows.mapInArrow(_align(paths or tokenizer_paths()),
                                            "chunk string, pairs array<long>, in_docs array<long>, blob binary"), "aligned")

    def _asked(self) -> DataFrame:
        each = self.chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "in_docs")).alias("at", "p"))
        return each.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.in_docs").alias("docs"))

    def pairs(self) -> DataFrame:
        """``(pair, n, best)``: documents that hold the pair (a << 16 | b) linked, and whether no pair of a's has more.

        A token of A has at most as many pairs as B has tokens, so the window is bounded.
        """
        counts = self._asked().groupBy("pair").agg(F.sum("docs").alias("n"))
        own = Window.partitionBy(F.shiftright("pair", 16))
        return counts.select("pair", "n", (F.col("n") == F.max("n").over(own)).alias("best"))

    def digests(self) -> DataFrame:
        """Per document ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``."""
        answers = (self._asked().drop("docs").join(self.pairs(), "pair").groupBy("chunk")
                   .agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("answers")))
        both = self.chunks.select("chunk", "blob").join(answers, "chunk", "left").select("blob", "answers")
        return both.mapInArrow(_finish, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                        "count_sum long, groups_sha256 string")


def align_text(text: str, paths: tuple[str, str] | None = None) -> list[tuple[list[int], list[int]]]:
    """The groups of one text: (ids of A, ids of B) in order."""
    windows = _aligner(*(paths or tokenizer_paths()))
    _, at = windows(*windows.tokens([text]))
    groups = ";".join(windows.text[k].decode() for k in at.tolist())
    return [tuple([int(x) for x in side.split(",")] for side in g.split("|")) for g in groups.split(";") if g]


def op13_crosstoken_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenisations of ``documents`` (contract of the query)."""
    aligned = Alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return aligned.digests().withColumnRenamed("id", "doc_id")
