"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some stretch of it is within
``budget(item)`` edits (insertions, deletions, substitutions of characters)
of the whole item, both normalised to lower-case words of letters and digits with
one space between. The item is cut into budget + 1 pieces, so with at most
``budget`` edits one piece survives unchanged. All pieces of a block of items go into one
Aho-Corasick automaton, and every exact piece hit is verified by Myers'
bit-parallel distance.

Verification climbs a binary tree over the pieces (Navarro and Baeza-Yates): a
run of p pieces may hold at most p - 1 edits if none of its sub-runs is to be
responsible, so a hit that already fails with its neighbouring piece costs a
few columns instead of an item's length. The last step is the whole item
with its whole budget, so the result is that of checking each hit in full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import slices, stage

#: Edits allowed per character of the normalised item.
EDIT_RATE = 0.08
#: Characters of test items that are searched in one pass over the documents.
BLOCK_CHARS = 1_000_000

_NOT_WORD = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


class Pattern:
    """Myers' bit vectors of one string; the text is scanned column by column."""

    def __init__(self, text: str) -> None:
        self.size = len(text)
        self.all = (1 << self.size) - 1
        self.last = 1 << max(self.size - 1, 0)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(text):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def search(self, window: str, budget: int) -> tuple[int, int] | None:
        """(distance, end) of the best stretch of ``window`` within ``budget``."""
        eq, every, last = self.eq.get, self.all, self.last
        up, down, score = every, 0, self.size
        best = None
        left = len(window)
        for c in window:
            left -= 1
            e = eq(c, 0)
            xv = e | down
            xh = (((e & up) + up) ^ up) | e
            ph = down | (every & ~(xh | up))
            mh = up & xh
            if ph & last:
                score += 1
            elif mh & last:
                score -= 1
            ph <<= 1
            up = ((mh << 1) | ~(xv | ph)) & every
            down = ph & xv & every
            if score <= budget:
                best, budget = (score, len(window) - left), score - 1
                if budget < 0:
                    break
            if score - left > budget:
                break
        return best


class Item:
    """One test item: its pieces, and for each piece the runs to be checked."""

    def __init__(self, item_id: int, text: str, rate: float) -> None:
        self.id, self.text = item_id, text
        self.budget = int(len(text) * rate)
        n = self.budget + 1
        self.cuts = [len(text) * k // n for k in range(n + 1)]
        self.paths: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        self._runs(0, n)
        self.patterns: dict[tuple[int, int], Pattern] = {}

    def _runs(self, a: int, b: int) -> None:
        if b - a > 1:
            middle = (a + b) // 2
            self._runs(a, middle)
            self._runs(middle, b)
        for k in range(a, b):
            self.paths[k].append((self.cuts[a], self.cuts[b], b - a - 1))

    def verify(self, text: str, piece: int, at: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of a match around piece ``piece`` found at ``at``."""
        own = self.cuts[piece]
        found = None
        for a, b, budget in self.paths[piece]:
            begin = max(0, at - (own - a) - budget)
            window = text[begin:at + (b - own) + budget]
            pattern = self.patterns.get((a, b))
            if pattern is None:
                pattern = self.patterns[a, b] = Pattern(self.text[a:b])
            best = pattern.search(window, budget)
            if best is None:
                return None
            found = (best[0], max(0, begin + best[1] - (b - a)), begin + best[1])
        return found


class Matcher:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE) -> None:
        import ahocorasick

        pieces: dict[str, list[tuple[Item, int]]] = {}
        for item_id, text in items:
            if text:
                item = Item(item_id, text, rate)
                for k, (a, b) in enumerate(zip(item.cuts, item.cuts[1:])):
                    pieces.setdefault(text[a:b], []).append((item, k))
        self.automaton = ahocorasick.Automaton() if pieces else None
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Per contaminating item its best (distance, start, end), in the
        characters of the normalised text."""
        found: dict[int, tuple[int, int, int]] = {}
        if self.automaton is None:
            return found
        for end, (size, where) in self.automaton.iter(text):
            for item, k in where:
                at = end + 1 - size
                known = found.get(item.id)
                if known and known[1] <= at < known[2]:
                    continue
                match = item.verify(text, k, at)
                if match and (known is None or match < known):
                    found[item.id] = match
        return found


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int
                ) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``block_chars`` characters each."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")) \
        .where("id is not null and t is not null").distinct()
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = 1 + chars // block_chars
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield [(r.id, normalise(r.t)) for r in part.orderBy("id", "t").collect()]


def _matcher(items: list[tuple[int, str]], rate: float) -> Callable[[], Matcher]:
    """The block's matcher, built once per Python worker."""
    made: list[Matcher] = []

    def get() -> Matcher:
        if not made:
            made.append(Matcher(items, rate))
        return made[0]

    return get


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", rate: float = EDIT_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(id, items)`` per row of ``docs``: the contaminating items.

    ``items`` is an array of ``(item_id, distance, start, end)``, ordered by item
    id, empty for a clean document. Null and empty texts are clean; items with
    a null id or text, or without a letter or digit, contaminate nothing.
    Repeated rows are judged one by one, and equal items under two ids are
    both reported. Other columns are ignored. Empty tables on either side give clean documents or none.
    """
    kind = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()),
                                ("start", pa.int32()), ("end", pa.int32())]))

    def search(get: Callable[[], Matcher]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                match = get()
                out = []
                for text, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    rows = (before or []) + [{"item_id": i, "distance": d, "start": a, "end": b}
                                             for i, (d, a, b) in match(normalise(text)).items()]
                    out.append(sorted(rows, key=lambda r: r["item_id"]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, arrow)],
                                                 names=["id", "t", "items"])
        return run

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"),
                       F.lit(None).cast(kind).alias("items"))
    for k, items in enumerate(item_blocks(benchmark, item_col, item_text_col, block_chars)):
        if k:
            rows = stage(rows, "matches")
        rows = rows.mapInArrow(search(_matcher(items, rate)), f"id long, t string, items {kind}")
    return rows.select("id", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that no test item contaminates, columns unchanged.

    Same cases as :func:`find_matches`; rows with null or empty texts stay.
    """
    place = docs.columns.index(text_col)

    def keep(get: Callable[[], Matcher]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                match = get()
                clean = [not match(normalise(t)) for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    out = docs
    for k, items in enumerate(item_blocks(benchmark, item_col, item_text_col, block_chars)):
        if k:
            out = stage(out, "clean")
        out = out.mapInArrow(keep(_matcher(items, rate)), docs.schema)
    return out


def op3_pigeonhole_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the test items it contains."""
    found = find_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), (F.size("items") > 0).alias("contaminated"),
                        F.size("items").alias("n_items"), F.col("items.item_id").alias("item_ids"),
                        F.col("items.distance").alias("distances"))
