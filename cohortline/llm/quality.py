"""Quality classifier by co-training.

Two logistic classifiers see two views of a document: its text (character
class pairs, words) and its page metadata (source, language, length, layout of
lines). Both start from the labelled sample. In every round each
classifier labels the unlabelled documents it is surest of, and hands them to the
*other* one as further examples. In the end each view is calibrated on labelled
documents that neither has seen, and the calibrated log odds are combined by a
logistic model fitted on the same documents.

Training takes a bounded sample (``LABELLED`` rows with a label, ``POOL`` without);
scoring covers every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import slices

#: Labelled and unlabelled documents in the training sample, about.
LABELLED = 8000
POOL = 12000
ROUNDS = 5
#: Share of the pool that a view hands over in a round, split by the label shares.
HANDED = 0.02
#: Documents scored below this go.
THRESHOLD = 0.5
#: Labels up to this many rows (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 250_000

# Character classes of bytes: the pairs of neighbouring classes are the text view.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".",
            b",;:", b"!?", b"'\"()-", b"|/\\_=+<>", b"#$%&*@^~`{}[]"]
_OTHER = len(_CLASSES)
_CLASS = np.full(256, _OTHER, np.uint8)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS[list(_bytes)] = _k
N_CLASSES = _OTHER + 1
TEXT_DIM = N_CLASSES ** 2 + 6
SOURCES, LANGS = 64, 16
META_DIM = SOURCES + LANGS + 24 + 8


def text_view(text: str) -> np.ndarray:
    """Features of the text itself."""
    x = np.zeros(TEXT_DIM, np.float32)
    raw = text.encode()
    if not raw:
        x[-1] = 1
        return x
    c = _CLASS[np.frombuffer(raw, np.uint8)].astype(np.int16)
    pairs = np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_CLASSES ** 2)
    x[:N_CLASSES ** 2] = np.sqrt(pairs / max(len(c) - 1, 1))
    words = text.split()
    n = max(len(words), 1)
    x[-6] = min(sum(map(len, words)) / n, 40) / 10
    x[-5] = len(set(words)) / n
    x[-4] = sum(map(str.isupper, words)) / n
    x[-3] = sum(map(str.isalpha, words)) / n
    x[-2] = min(log2(1 + n), 20) / 10
    return x


def _slot(value: object, size: int) -> int:
    """A category's place; the first one is for a missing value."""
    return 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (size - 1)


def meta_view(text: str, source: object, lang: object, n_chars: int | None) -> np.ndarray:
    """Features of the page around the text."""
    x = np.zeros(META_DIM, np.float32)
    x[_slot(source, SOURCES)] = 1
    x[SOURCES + _slot(lang, LANGS)] = 1
    length = -1 if n_chars is None or n_chars < 0 else min(int(log2(1 + n_chars)), 22)
    x[SOURCES + LANGS + 1 + length] = 1
    lines = text.split("\n")
    filled = [len(s) for s in lines if s.strip()] or [0]
    mean = sum(filled) / len(filled)
    x[-8:] = (log2(1 + len(lines)) / 10, log2(1 + mean) / 10, log2(1 + max(filled)) / 10, log2(1 + min(filled)) / 10,
              1 - len(filled) / len(lines), len(set(lines)) / len(lines), len(lines) == 1, not text)
    return x


@dataclass
class Logistic:
    """Ridge-penalised logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, start: Logistic | None = None, steps: int = 12
            ) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-6] = 1
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float64)
        w = np.zeros(z.shape[1])
        penalty = np.full(len(w), ridge)
        penalty[-1] = 1e-9
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (p - y) / len(y) + penalty * w
            curve = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve((z * curve[:, None]).T @ z / len(y) + np.diag(penalty), gradient)
            w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-5:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.w[:-1] + self.w[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    """Both views, their calibrations (slope, shift), and the combination.

    Without ``text`` (nothing to learn from) every score is ``prior``.
    """

    prior: float
    text: Logistic | None = None
    meta: Logistic | None = None
    text_line: tuple[float, float] = (1.0, 0.0)
    meta_line: tuple[float, float] = (1.0, 0.0)
    combined: tuple[float, float, float] = (1.0, 1.0, 0.0)

    def score(self, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality: by text, by metadata, combined."""
        if self.text is None or self.meta is None:
            return tuple(np.full(len(text_x), self.prior) for _ in range(3))  # type: ignore[return-value]
        a = self.text.logit(text_x) * self.text_line[0] + self.text_line[1]
        b = self.meta.logit(meta_x) * self.meta_line[0] + self.meta_line[1]
        return sigmoid(a), sigmoid(b), sigmoid(self.combined[0] * a + self.combined[1] * b + self.combined[2])


def _line(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic fit of y on the columns of z with a shift; slopes are never negative."""
    fit = Logistic.fit(z, y, ridge=1e-3)
    slope = np.maximum(fit.w[:-1] / fit.scale, 0)
    return np.append(slope, fit.w[-1] - (fit.mean * slope).sum())


def co_train(text_x: np.ndarray, meta_x: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray,
             rounds: int = ROUNDS, handed: float = HANDED) -> Model:
    """Co-training of the two views; every fifth labelled row is kept for calibration."""
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return Model(float(y.mean()) if len(y) else 1.0)
    views = (text_x, meta_x), (pool_text, pool_meta)
    share = y[~held].mean()
    given: list[dict[int, int]] = [{}, {}]  # pseudo-labels by pool row, for each view
    models: list[Logistic] = []
    for r in range(rounds + 1):
        models = []
        for v in (0, 1):
            rows = np.fromiter(given[v].keys(), np.int64, len(given[v]))
            marks = np.fromiter(given[v].values(), np.float64, len(given[v]))
            models.append(Logistic.fit(np.vstack([views[0][v][~held], views[1][v][rows]]),
                                       np.concatenate([y[~held], marks])))
        if r == rounds or not len(pool_text):
            break
        for v in (0, 1):
            z = models[v].logit(views[1][v])
            order = np.argsort(z, kind="stable")
            k = max(1, int(len(z) * handed))
            bad, good = int(np.ceil(k * (1 - share))), int(np.ceil(k * share))
            free = [i for i in order if i not in given[1 - v]]
            given[1 - v].update((int(i), 0) for i in free[:bad] if z[i] < -1)
            given[1 - v].update((int(i), 1) for i in free[::-1][:good] if z[i] > 1)
    logits = [m.logit(views[0][v][held])[:, None] for v, m in enumerate(models)]
    lines = [_line(z, y[held]) for z in logits]
    both = np.column_stack([z[:, 0] * a + b for z, (a, b) in zip(logits, lines)])
    combined = _line(both, y[held])
    return Model(float(share), models[0], models[1], tuple(lines[0]), tuple(lines[1]), tuple(combined))


def _views(batch: pa.RecordBatch, at: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    text, source, lang, chars = (batch.column(i).to_pylist() if i >= 0 else [None] * batch.num_rows for i in at)
    text = [t or "" for t in text]
    return (np.array([text_view(t) for t in text]).reshape(-1, TEXT_DIM),
            np.array([meta_view(*row) for row in zip(text, source, lang, chars)]).reshape(-1, META_DIM))


def _places(docs: DataFrame, text_col: str, source_col: str, lang_col: str, chars_col: str) -> tuple[int, ...]:
    return tuple(docs.columns.index(c) if c in docs.columns else -1 for c in (text_col, source_col, lang_col, chars_col))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          text_col: str = "text", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars",
          labelled: int = LABELLED, pool: int = POOL) -> Model:
    """Fit the model. Rows with a null label or id teach nothing; an id with
    several labels is good only if all of them are. Without labels of both kinds
    every score is the share of good ones (1 without any)."""
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min((F.col(label_col) > 0).cast("int")).alias("_y")))
    n_marks, n_docs = marks.count(), docs.count()
    marks = F.broadcast(marks) if n_marks <= BROADCAST_LABELS else marks
    cols = [c for c in (text_col, source_col, lang_col, chars_col) if c in docs.columns]
    names = {c: f"_c{i}" for i, c in enumerate(cols)}
    some = docs.select(F.col(id_col).cast("long").alias("_id"), *[F.col(c).alias(n) for c, n in names.items()])
    marked = some.join(marks, "_id")
    n_marked = some.select("_id").join(marks, "_id").count()

    def chosen_of(rows: DataFrame, salt: str, most: int, of: int) -> DataFrame:
        """About ``most`` of ``of`` rows, by a hash of their columns; equal ones, whatever their ids, are one."""
        key = F.xxhash64(*names.values(), F.lit(salt))
        part = rows.withColumn("_k", key).where(F.pmod("_k", F.lit(1_000_000)) < int(1e6 * min(1.0, most / max(of, 1))))
        return part.groupBy("_k").agg(F.min(F.struct("_y", "_id", *names.values())).alias("r")).select("r.*")

    # No id, copy or label brings more than its share into the sample, which the driver gets.
    chosen = chosen_of(marked, "labelled", labelled, n_marked).unionByName(
        chosen_of(some.withColumn("_y", F.lit(-1)), "pool", pool, n_docs))
    chosen = chosen.select("_id", "_y", *names.values())
    at = tuple(chosen.columns.index(names[c]) if c in names else -1
               for c in (text_col, source_col, lang_col, chars_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = _views(batch, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()),
                 pa.array([r.astype("<f4").tobytes() for r in a], pa.binary()),
                 pa.array([r.astype("<f4").tobytes() for r in b], pa.binary())], names=["id", "y", "a", "b"])

    got = chosen.mapInArrow(run, "id long, y int, a binary, b binary").collect()
    got.sort(key=lambda r: (r.y, zlib.crc32(str(r.id).encode()), r.id or 0, bytes(r.a)))
    y = np.array([r.y for r in got], np.float64)
    a = np.frombuffer(b"".join(bytes(r.a) for r in got), "<f4").reshape(-1, TEXT_DIM)
    b = np.frombuffer(b"".join(bytes(r.b) for r in got), "<f4").reshape(-1, META_DIM)
    mix = np.argsort([zlib.crc32(str(r.id).encode()) for r in got], kind="stable")
    own, other = mix[y[mix] >= 0], mix[y[mix] < 0]
    if not len(own):
        return Model(1.0)
    return co_train(a[own], b[own], y[own], a[other], b[other])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars") -> DataFrame:
    """``(id, text_score, meta_score, score)`` per row of ``docs``.

    Missing or null texts, sources, languages and lengths are values of their own. Rows
    are never merged; other columns are ignored.
    """
    cols = [c for c in (text_col, source_col, lang_col, chars_col) if c in docs.columns]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    at = tuple(1 + cols.index(c) if c in cols else -1 for c in (text_col, source_col, lang_col, chars_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            scores = model.score(*_views(piece, at))
            yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(s, pa.float64()) for s in scores)],
                                             names=["id", "text_score", "meta_score", "score"])

    return rows.mapInArrow(run, "id long, text_score double, meta_score double, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text",
              source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, columns unchanged."""
    at = _places(docs, text_col, source_col, lang_col, chars_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield piece.filter(pa.array(model.score(*_views(piece, at))[2] >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).withColumnRenamed("id", "doc_id").withColumn("keep", F.col("score") >= THRESHOLD)
