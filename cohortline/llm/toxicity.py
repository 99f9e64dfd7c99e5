"""Toxicity by multiple-instance learning.

Only documents carry labels; the sentences are the instances. Each sentence gets
a logistic score from its words, and the sentence scores of a document are
combined by noisy-or: a document is toxic unless every sentence is harmless
(and an unseen cause, the leak, does not apply). The likelihood of the
document labels trains the sentence weights, so the sentences that are to blame
are found without ever being labelled.

Word statistics are counted over all different labelled texts, and every feature
that tells about the label at a false discovery rate of ``FALSE_SHARE`` carries a weight; the weights are
fitted on a bounded sample of those texts (about ``SAMPLE_DOCS`` of either label).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import slices, stage

#: Different labelled texts of either label that the weights are fitted on, about.
SAMPLE_DOCS = 8000
#: Share of the features with a weight that may have it by chance (false discovery rate).
FALSE_SHARE = 0.05
#: Log likelihood ratios are counted in bins of 1 / BINS, up to MOST_BINS of them.
BINS, MOST_BINS = 32, 32 * 720
#: The largest possible ratio matters up to this bin; a feature that can reach it is always tested.
MOST_ABLE = 32 * 40
#: Labels up to this many rows (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 250_000
THRESHOLD = 0.3

_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> list[str]:
    """The sentences of a text, trimmed, without empty ones."""
    return [s for s in map(str.strip, _SENTENCE.split(text)) if s]


#: Lengths of the word beginnings that are features beside the word itself.
STEMS = (4, 5, 6)
#: Words whose summed weight a task remembers; beyond it the memory starts anew.
CACHE_WORDS = 300_000


def parts(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings marked with a star."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


class Model:
    """Sentence weights by feature, the sentence bias, and the leak's log odds."""

    def __init__(self, weights: dict[str, float], bias: float, leak: float) -> None:
        self.weights, self.bias, self.leak = weights, bias, leak
        self.known: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.leak)

    def word_weight(self, word: str) -> float:
        """Summed weight of a word's features, remembered."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        get = self.weights.get
        w = self.known[word] = sum(get(p, 0.0) for p in parts(word))
        return w

    def sentence_scores(self, text: str) -> list[float]:
        known, learn = self.known.get, self.word_weight
        z = []
        for s in sentences(text.lower()):
            total = self.bias
            for w in set(_WORD.findall(s)):
                x = known(w)
                total += learn(w) if x is None else x
            z.append(total)
        return (1 / (1 + np.exp(-np.clip(z, -60, 60)))).tolist() if z else []

    def document_score(self, scores: list[float]) -> float:
        """Noisy-or of the sentence scores and the leak."""
        harmless = np.log1p(-np.minimum(scores, 1 - 1e-12)).sum() - np.logaddexp(0, self.leak)
        return float(-np.expm1(harmless))


def different_texts(rows: DataFrame) -> DataFrame:
    """``(k, t, y)``: each different text ``t`` of ``rows`` once, toxic if a copy of it is; ``k`` is a hash of it."""
    return (rows.groupBy(F.xxhash64("t").alias("k"), F.md5("t").alias("m"))
            .agg(F.max(F.struct("y", "t")).alias("r")).select("k", "r.t", "r.y"))


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, pos, neg)``: the texts ``t`` of each label ``y`` with the feature.

    ``rows`` are those of :func:`different_texts`, so a text counts once however often it was copied.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            words = list(held[0].keys() | held[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *(pa.array([held[k][w] for w in words], pa.int64()) for k in (1, 0))],
                names=["word", "pos", "neg"])

        for batch in slices(batches):
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[y].update({p for w in set(_WORD.findall(t.lower())) for p in parts(w)})
            if len(held[0]) + len(held[1]) > 500_000:
                yield out()
                held = (Counter(), Counter())
        yield out()

    return (rows.select("t", "y").mapInArrow(run, "word string, pos long, neg long")
            .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def least_ratio(bins: dict[tuple[int, int], int], false_share: float = FALSE_SHARE) -> float:
    """The log likelihood ratio (half of G²) from which on features tell, by Benjamini and Hochberg.

    ``bins`` counts the features by the bin of their ratio and that of the largest ratio their number of texts
    allows. A feature that says nothing reaches g with probability erfc(sqrt(g)), if it can reach g
    at all (Tarone), so as many of those that can are expected beyond g by chance. The least g is taken at
    which they are at most ``false_share`` of the features found there. With more features tested the bar
    rises, and what is chosen by chance stays that share of what is chosen for cause.
    """
    found, can = Counter(), Counter()
    for (k, most), n in bins.items():
        found[k] += n
        can[max(most, k)] += n
    beyond, able, least = 0, 0, math.inf
    for k in range(max([0, *found, *can]), -1, -1):
        beyond, able = beyond + found[k], able + can[k]
        if found[k] and able * math.erfc(math.sqrt(k / BINS)) <= false_share * beyond:
            least = k / BINS
    return least


def choose_words(counts: DataFrame, n_pos: int, n_neg: int, false_share: float = FALSE_SHARE) -> list[str]:
    """All features that tell about the label, at a false discovery rate of ``false_share``.

    ``n_pos`` and ``n_neg`` are the texts behind ``counts``. The driver gets a
    histogram, whose size the bins bound, and then the chosen features.
    """
    total, share = n_pos + n_neg, n_pos / (n_pos + n_neg)

    def ratio(pos: str, neg: str) -> str:
        cells = [(pos, f"({pos} + {neg}) * {share!r}D"), (neg, f"({pos} + {neg}) * {1 - share!r}D"),
                 (f"({n_pos} - {pos})", f"({total} - {pos} - {neg}) * {share!r}D"),
                 (f"({n_neg} - {neg})", f"({total} - {pos} - {neg}) * {1 - share!r}D")]
        return " + ".join(f"if({o} <= 0, 0D, {o} * ln({o} / ({e})))" for o, e in cells)

    told = counts.selectExpr("word", "pos", "neg", f"{ratio('pos', 'neg')} as g",
                             f"least(pos + neg, {min(n_pos, n_neg)}L) as rare", "pos + neg as n")
    # All of its texts of the rarer label, as far as there are so many.
    most = ratio("rare", "(n - rare)") if n_pos <= n_neg else ratio("(n - rare)", "rare")
    told = told.selectExpr("word", "g", f"least({MOST_BINS}, cast(floor(g * {BINS}) as int)) as k",
                           f"least({MOST_ABLE}, cast(floor(({most}) * {BINS} + 1e-6) as int)) as most")
    bins = {(r.k, r.most): r.n for r in told.groupBy("k", "most").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = least_ratio(bins, false_share)
    return sorted(r.word for r in told.where(F.col("g") >= least).select("word").collect())


def bag(text: str, place: dict[str, int]) -> tuple[int, list[int]]:
    """(sentences without any known feature, sentence * size + feature of the others)."""
    own = sentences(text.lower())
    at, k = [], 0
    for s in own:
        hits = {place[p] for w in set(_WORD.findall(s)) for p in parts(w) if p in place}
        at += [k * len(place) + h for h in sorted(hits)]
        k += bool(hits)
    return len(own) - k, at


def bags(rows: DataFrame, words: list[str]) -> DataFrame:
    """``(y, n, at)`` per row, as :func:`bag` gives them; ``at`` as the bytes of its 64-bit numbers."""
    place = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [bag(t, place) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([g[0] for g in got], pa.int32()),
                                              pa.array([np.array(g[1], "<i8").tobytes() for g in got], pa.binary())],
                                             names=["y", "n", "at"])

    return rows.select("t", "y").mapInArrow(run, "y int, n int, at binary")


def fit_bags(y: np.ndarray, empty: np.ndarray, at: list[np.ndarray], doc_weight: np.ndarray, size: int,
             rounds: int = 300, ridge: float = 2e-6) -> tuple[np.ndarray, float, float]:
    """Maximum likelihood of the labels under noisy-or (Adam, full batches)."""
    n = np.array([a[-1] // size + 1 if len(a) else 0 for a in at], np.int64)
    first = np.cumsum(n) - n
    flat = np.concatenate(at) if at else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(n)), [len(a) for a in at])
    sentence, word = first[doc] + flat // max(size, 1), flat % max(size, 1)
    of = np.repeat(np.arange(len(n)), n)
    theta = np.zeros(size + 2)
    theta[-2], theta[-1] = -5.0, -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = doc_weight / doc_weight.sum()
    for k in range(1, rounds + 1):
        bias, leak = theta[-2:]
        z = np.clip(bias + np.bincount(sentence, theta[word], minlength=len(of)), -40, 40)
        p = 1 / (1 + np.exp(-z))
        plain = 1 / (1 + np.exp(-bias))
        harmless = (-np.bincount(of, np.logaddexp(0, z), minlength=len(n))
                    - empty * np.logaddexp(0, bias) - np.logaddexp(0, leak))
        toxic = -np.expm1(np.minimum(harmless, -1e-12))
        # d loss / d log(harmless): (1 - P) / P for a toxic label, -1 for a clean one.
        slope = weight * np.where(y > 0, (1 - toxic) / toxic, -1.0)
        dz = -slope[of] * p
        gradient = np.empty_like(theta)
        gradient[:size] = np.bincount(word, dz[sentence], minlength=size) + ridge * theta[:size]
        gradient[-2] = dz.sum() - (slope * empty).sum() * plain
        gradient[-1] = -slope.sum() / (1 + np.exp(-leak))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        rate = 0.15 * min(1.0, 3 * (1 - k / rounds) + 0.02)
        theta = theta - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
    return theta[:size], float(theta[-2]), float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE_DOCS, false_share: float = FALSE_SHARE) -> Model:
    """Fit the model to the labelled rows of ``docs``.

    Rows without a label, or with a null label or id, teach nothing; an id with
    several labels counts as toxic if one of them does. Without labels of both
    kinds every score is the share of toxic labels (0 without any).
    """
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y")))
    if marks.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    marked = (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
              .join(marks, "_id").select("t", "y"))
    rows = stage(different_texts(marked), "labelled")
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Model({}, -60.0, 30.0 if totals.get(1) else -30.0)
    words = choose_words(stage(word_counts(rows), "word-counts"), totals[1], totals[0], false_share)
    # Chosen by the text, each different text once: no id and no copied text brings more than its one row.
    part = {y: min(1.0, sample / totals[y]) for y in (0, 1)}
    place = F.pmod(F.col("k"), F.lit(1_000_000))
    some = rows.where(((F.col("y") == 1) & (place < int(part[1] * 1e6))) | ((F.col("y") == 0) & (place < int(part[0] * 1e6))))
    got = bags(some, words).collect()
    y = np.array([r.y for r in got])
    at = [np.frombuffer(bytes(r.at), "<i8") for r in got]
    weight = np.where(y > 0, 1 / part[1], 1 / part[0])
    w, bias, leak = fit_bags(y, np.array([r.n for r in got]), at, weight, len(words))
    return Model({word: float(x) for word, x in zip(words, w) if x}, bias, leak)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", blame: float = 0.5
          ) -> DataFrame:
    """``(id, score, n_sentences, offending)`` per row of ``docs``.

    ``offending`` lists the sentences (index, score, text) scored ``blame`` or
    more. Null, empty and wordless texts have no sentences and get the leak's
    score. Rows are never merged; other columns are ignored.
    """
    kind = pa.list_(pa.struct([("index", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores, n, offending = [], [], []
            for t in batch.column(1).to_pylist():
                own = model.sentence_scores(t or "")
                scores.append(model.document_score(own))
                n.append(len(own))
                bad = [i for i, p in enumerate(own) if p >= blame]
                text = sentences(t) if bad else []
                offending.append([{"index": i, "score": own[i], "text": text[i] if i < len(text) else ""} for i in bad])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(n, pa.int32()), pa.array(offending, kind)],
                names=["id", "score", "n_sentences", "offending"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "id long, score double, n_sentences int, "
                             "offending array<struct<index:int,score:double,text:string>>"))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def op5_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document (contract of the query). Rows without an id are not held out; they have no label."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 4) != 2)
    model = train(docs, labels)
    scored = score(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences",
                         F.size("offending").alias("n_offending"))
