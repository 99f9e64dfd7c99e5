"""Source divergence audit on hash-consed segment trees over term ids.

Per language the terms of enough documents are kept and every source gives each of them a
probability (smoothed by two, in thousand millionths, whole numbers throughout). Two sources
differ by the sum of (p - q)^2 / (p + q), a source is told apart by the terms it
gives more than its language does.

The kept terms of a language are dealt by a hash into blocks of about LEAVES
terms. In a block the terms are numbered by falling frequency, so that equal counts, the many ones
and noughts above all, lie side by side. The counts of a source are the leaves of a segment tree over
those numbers; the trees of all sources of a block are hash-consed: equal subtrees, of one source
or of several, are one node. Two trees are walked together from their roots; a pair of nodes that
comes up again is not walked again but counted, so it is priced once. Sums over blocks make the whole.

On Spark: counts per (language, source, term) are aggregated in the tasks and then by a shuffle. A task
then holds one block of terms for two tiles of at most TILE sources, whatever the size of the corpus, the
vocabulary or the number of sources; its results are partial sums per pair of sources and the
block's foremost terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import slices, stage

#: A term is kept if that many documents of its language have it.
MIN_DOCS = 10
#: Ranks reported of a source's terms.
TOP = 10
#: Probabilities are whole numbers of 1 / SCALE.
SCALE = 1_000_000_000
#: Terms in a block, about, and sources in a tile.
LEAVES = 4096
TILE = 32
#: Term counts held in a task before they are handed on, and bytes of a text split at a time.
HELD = 400_000
PIECE = 1 << 22
#: Pairs of nodes walked at a time.
WALKED = 1_000_000

#: Letters and all bytes beyond ASCII stay, A-Z are lower-cased, everything else parts terms.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# --- counting -----------------------------------------------------------------

def split_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, some megabytes of it at a time."""
    data, at = text.translate(_TERM), 0
    while len(data) - at > PIECE:
        end = data.rfind(b" ", at, at + PIECE)
        end = end if end > at else data.find(b" ", at + PIECE)
        if end < 0:
            break
        yield data[at:end].split()
        at = end
    yield data[at:].split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's documents, and (lang, source, null, 0, 0) per group."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def flush() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), counts in n.items():
            have = docs[lang, source]
            columns[0] += [lang] * (len(counts) + 1)
            columns[1] += [source] * (len(counts) + 1)
            columns[2] += [None, *counts]
            columns[3] += [0, *counts.values()]
            columns[4] += [0, *(have[t] for t in counts)]
        n.clear()
        docs.clear()
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    for batch in slices(batches, 256):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            counts, have = n.setdefault((lang, source), Counter()), docs.setdefault((lang, source), Counter())
            seen: set[bytes] = set()
            for terms in split_terms(text):
                counts.update(terms)
                seen.update(terms)
            have.update(seen)
        if sum(map(len, n.values())) > HELD:
            yield flush()
    yield flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of a term in a group.

    Null texts, languages and sources are empty strings. A group without a term
    has a row too: every group has one with a null term and noughts. Other columns are ignored.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    return (rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


# --- trees --------------------------------------------------------------------

class Trees:
    """Segment trees over the rows of ``leaves`` (sources x terms), equal subtrees shared.

    The number of terms is a power of two; a leaf of -1 is no term. ``levels[k]`` holds the
    children of the nodes of height k + 1 as numbers of nodes of height k, ``values`` the leaves' counts.
    """

    def __init__(self, leaves: np.ndarray) -> None:
        self.values, ids = np.unique(leaves, return_inverse=True)
        ids = ids.reshape(leaves.shape)
        self.sizes = [len(self.values)]
        self.full = [self.values > 0]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while ids.shape[1] > 1:
            size = self.sizes[-1]
            pairs, at = np.unique(ids[:, 0::2].astype(np.int64) * size + ids[:, 1::2], return_inverse=True)
            left, right = pairs // size, pairs % size
            self.levels.append((left, right))
            self.full.append(self.full[-1][left] | self.full[-1][right])
            self.sizes.append(len(pairs))
            ids = at.reshape(ids.shape[0], -1)
        self.roots = ids[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pair, count in a, count in b, times) of the different leaf pairs of each pair (a[i], b[i]) of rows."""
        pair = np.arange(len(a))
        x, y, times = self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for height in reversed(range(len(self.levels))):
            left, right = self.levels[height]
            size = self.sizes[height]
            own = np.concatenate([pair, pair]).astype(np.int64) * size
            key = (own + np.concatenate([left[x], right[x]])) * size + np.concatenate([left[y], right[y]])
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, np.concatenate([times, times])).astype(np.int64)
            y = key % size
            key //= size
            pair, x = key // size, key % size
        return pair, self.values[x], self.values[y], times

    def leaves(self, a: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, count in the row, count in row b) of the leaves above nought of the rows ``a``."""
        keep = self.full[-1][self.roots[a]]
        row, x = a[keep], self.roots[a][keep]
        y, place = np.full(len(row), self.roots[b]), np.zeros(len(row), np.int64)
        for height in reversed(range(len(self.levels))):
            left, right = self.levels[height]
            row, place = np.concatenate([row, row]), np.concatenate([2 * place, 2 * place + 1])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            keep = self.full[height][x]
            row, place, x, y = row[keep], place[keep], x[keep], y[keep]
        return row, place, self.values[x], self.values[y]


def probability(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exact for counts of any size."""
    if not len(count) or int(count.max()) < (2 ** 63 - 1) // SCALE - 2:
        return 1 + SCALE * (count + 2) // np.maximum(total, 1)
    return np.array([1 + SCALE * (int(c) + 2) // int(t) for c, t in zip(count, total)], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); both are below 2^31."""
    return (p - q) ** 2 // (p + q)


def _block(top: int):
    """A block's terms for two tiles of sources: partial sums per pair, foremost terms per source."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lang, _, ti, tj = (k.as_py() for k in key)
        kind = table.column("kind").to_numpy()

        def rows(k: int) -> pa.Table:
            return table.filter(pa.array(kind == k))

        terms = rows(0)
        terms = terms.take(pc.sort_indices(terms, [("n", "descending"), ("name", "ascending")]))
        names = terms.column("name").combine_chunks()
        groups = rows(2).sort_by("g")
        g, source = groups.column("g").to_numpy(), groups.column("name").to_pylist()
        total = groups.column("n").to_numpy() + 2 * groups.column("v").to_numpy()  # the language itself is the first
        cells = rows(1)
        width = 1 << max(0, len(names) - 1).bit_length()
        leaves = np.full((len(g), width), -1, np.int64)
        leaves[:, :len(names)] = 0
        leaves[0, :len(names)] = terms.column("n").to_numpy()
        place = pc.index_in(cells.column("name"), names).to_numpy()
        leaves[np.searchsorted(g, cells.column("g").to_numpy()), place] = cells.column("n").to_numpy()
        trees = Trees(leaves)
        out: tuple[list, ...] = ([], [], [], [])
        first = np.flatnonzero((g >= 0) & (g // TILE == ti))
        second = np.flatnonzero((g >= 0) & (g // TILE == tj))
        a, b = (m.ravel() for m in np.meshgrid(first, second, indexing="ij"))
        a, b = a[a < b], b[a < b]
        step = max(1, WALKED // width)
        for at in range(0, len(a), step):
            i, j = a[at:at + step], b[at:at + step]
            pair, x, y, times = trees.walk(i, j)
            real = x >= 0
            pair, x, y, times = pair[real], x[real], y[real], times[real]
            worth = price(probability(x, total[i][pair]), probability(y, total[j][pair])) * times
            value = np.zeros(len(i), np.int64)
            np.add.at(value, pair, worth)
            for u, v, w in zip(i.tolist(), j.tolist(), value.tolist()):
                for column, own, other in ((out[0], "pair", "pair"), (out[1], source[u], source[v]), (out[2], source[v], source[u]), (out[3], w, w)):
                    column += [own, other]
        if ti == tj and len(names):
            row, at, x, y = trees.leaves(first, 0)
            p, q = probability(x, total[row]), probability(y, np.full(len(y), total[0]))
            more = p > q
            row, at, value = row[more], at[more], price(p, q)[more]
            by_name = np.empty(len(names), np.int64)
            by_name[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
            order = np.lexsort((by_name[at], -value, row))
            row, at, value = row[order], at[order], value[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, at, value = row[rank < top], at[rank < top], value[rank < top]
            for column, new in zip(out, (["term"] * len(row), [source[r] for r in row], names.take(pa.array(at)).to_pylist(), value.tolist())):
                column += new
        part, own, item, value = out
        return pa.Table.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(own, pa.string()), pa.array(part, pa.string()),
                                     pa.array(item, pa.string()), pa.array(value, pa.int64())],
                                    names=["lang", "source", "part", "item", "value"])

    return run


# --- audit --------------------------------------------------------------------

def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how a language's sources differ.

    Part ``pair``: a row for every other source (item) of the language, all ranks; part ``term``: the
    ``top`` terms that the source gives more than its language does. Ranks go by falling
    value, then by the item's bytes. A row of ``docs`` is a document: repeated rows
    count each. Null texts, languages and sources are empty strings. A language
    without a kept term has pairs of value 0, one with a single source no pairs; an
    empty table gives no rows.
    """
    counts = stage(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = stage(counts.where("term is not null").groupBy("lang", "term")
                 .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
                 .select("lang", "term", "total"), "terms")
    cells = counts.where("n > 0").join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    words = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    # One row per source, in the order of a language's sources.
    groups = stage(counts.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left")
                   .join(words, "lang", "left").na.fill(0, ["n", "v", "all"])
                   .withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
                   .withColumn("tiles", F.expr(f"cast(1 + max(g) over (partition by lang) div {TILE} as int)"))
                   .withColumn("blocks", F.expr(f"cast(greatest(1, (v + {LEAVES - 1}) div {LEAVES}) as int)")), "sources")
    langs = groups.where("g = 0")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    whole = F.expr("flatten(transform(sequence(0, tiles - 1), i -> transform(sequence(i, tiles - 1), "
                   "j -> named_struct('ti', i, 'tj', j))))")
    of_tile = F.expr(f"transform(sequence(0, tiles - 1), x -> named_struct('ti', least(x, cast(g div {TILE} as int)), "
                     f"'tj', greatest(x, cast(g div {TILE} as int))))")

    def task(kind: int, g: str, name: str, n: str, v: str) -> list:
        return ["lang", "block", "t.ti", "t.tj", F.lit(kind).alias("kind"), F.expr(g).cast("long").alias("g"),
                F.expr(name).alias("name"), F.expr(n).alias("n"), F.expr(v).cast("long").alias("v")]

    every_block = F.explode(F.expr("sequence(0, blocks - 1)"))
    parts = [
        kept.join(langs.select("lang", "tiles", "blocks"), "lang").withColumn("block", block)
        .withColumn("t", F.explode(whole)).select(*task(0, "-1", "term", "total", "0")),
        cells.join(groups.select("lang", "source", "g", "tiles", "blocks"), ["lang", "source"]).withColumn("block", block)
        .withColumn("t", F.explode(of_tile)).select(*task(1, "g", "term", "n", "0")),
        groups.withColumn("block", every_block).withColumn("t", F.explode(of_tile)).select(*task(2, "g", "source", "n", "v")),
        langs.withColumn("block", every_block).withColumn("t", F.explode(whole)).select(*task(2, "-1", "''", "all", "v")),
    ]
    tasks = parts[0]
    for more in parts[1:]:
        tasks = tasks.unionByName(more)
    schema = "lang string, source string, part string, item string, value long"
    found = tasks.groupBy("lang", "block", "ti", "tj").applyInArrow(_block(top), schema)
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))


def op11_segment_tree_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of the sources of ``documents`` (contract of the query)."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same audit in DuckDB SQL, from the definitions.
OP11_SQL = rf"""
with docs as (
  select row_number() over () as d, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents),
words as (
  select d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from docs),
kept as (
  select lang, term, count(*) as n from words group by lang, term having count(distinct d) >= {MIN_DOCS}),
have as (
  select w.lang, source, w.term, count(*) as n from words w join kept k on w.lang = k.lang and w.term = k.term
  group by w.lang, source, w.term),
teams as (select distinct lang, source from docs),
vocabulary as (select t.lang, count(term) as v, coalesce(sum(n), 0) as n from (select distinct lang from docs) t
  left join kept k on k.lang = t.lang group by t.lang),
sizes as (select t.lang, t.source, coalesce(sum(n), 0) as n from teams t
  left join have h on h.lang = t.lang and h.source = t.source group by t.lang, t.source),
whole as (
  select k.lang, k.term, cast(1 + cast({SCALE} as hugeint) * (k.n + 2) // (v.n + 2 * v) as bigint) as q
  from kept k join vocabulary v on v.lang = k.lang),
given as (
  select s.lang, s.source, k.term, coalesce(h.n, 0) as n,
    cast(1 + cast({SCALE} as hugeint) * (coalesce(h.n, 0) + 2) // (s.n + 2 * v.v) as bigint) as p
  from sizes s join kept k on k.lang = s.lang join vocabulary v on v.lang = s.lang
  left join have h on h.lang = s.lang and h.source = s.source and h.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from given a join given b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
  union all
  select a.lang, a.source, b.source, 0 from teams a join teams b on a.lang = b.lang and a.source <> b.source
  join vocabulary v on v.lang = a.lang where v.v = 0),
terms as (
  select g.lang, source, g.term as item, (p - q) * (p - q) // (p + q) as value
  from given g join whole w on w.lang = g.lang and w.term = g.term where g.n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value from pairs
  union all select lang, source, 'term', item, value from terms),
numbered as (
  select lang, source, part, item, cast(value as bigint) as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from ranked)
select * from numbered where part = 'pair' or rank <= {TOP}
"""
