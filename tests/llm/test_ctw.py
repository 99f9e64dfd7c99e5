"""Context-tree weighting against a direct computation."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortline.llm.ctw import (LOW, Top, depths, grams_of, language_model, levels, log10_probability, log_kt, merged)

SCHEMA = "doc_id long, text string, score string, chunk int"


def tree(texts, depth):
    u, n = merged(grams_of(texts, depth), np.ones(sum(map(len, texts)) + len(texts)))
    by_depth = depths(u, n, depth, LOW)
    tops = [levels(by_depth, k)[-1] for k in range(8)]
    return by_depth, Top([(t.key, t.n0, t.n1, t.log_w) for t in tops])


def plain_ctw(train, test, depth):
    """Textbook recursion with dictionaries: log10 of the predictive probability of ``test``."""
    counts: dict = {}
    def walk(text):
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            node = 1
            for k in range(7, -1, -1):
                yield data[:i], node, data[i] >> k & 1
                node = node * 2 + (data[i] >> k & 1)
    for t in train:
        for past, node, bit in walk(t):
            for d in range(depth + 1):
                counts.setdefault((d, past[len(past) - d:], node), [0, 0])[bit] += 1
    children: dict = {}
    for d, c, node in counts:
        if d:
            children.setdefault((d - 1, c[1:], node), []).append((d, c, node))
    kt = lambda n: math.lgamma(n[0] + .5) + math.lgamma(n[1] + .5) - math.log(math.pi) - math.lgamma(sum(n) + 1)
    weighted: dict = {}
    for key in sorted(counts, key=lambda k: -k[0]):
        own = kt(counts[key])
        split = sum(weighted[c] for c in children.get(key, ()))
        weighted[key] = own if key[0] == depth else np.logaddexp(own, split) - math.log(2)
    total = 0.0
    for past, node, bit in walk(test):
        q = 0.5
        for d in range(depth, -1, -1):
            key = (d, past[len(past) - d:], node)
            if key in counts:
                n = counts[key]
                p = (n[bit] + .5) / (sum(n) + 1)
                stop = 1.0 if d == depth else math.exp(kt(n) - math.log(2) - weighted[key])
                q = stop * p + (1 - stop) * q
        total += math.log10(q)
    return total


def test_log_kt():
    for a, b in ((0, 0), (1, 0), (3, 2), (5000, 1), (4095, 9000), (100000, 70000)):
        want = math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
        assert abs(log_kt(np.array([a]), np.array([b]))[0] - want) < 1e-6 * max(1, abs(want))


def test_predictions_add_up_and_match_the_textbook():
    rng = random.Random(1)
    train = ["".join(rng.choice("aab é") for _ in range(60)).encode() for _ in range(12)]
    by_depth, top = tree(train, 3)
    for context in (0x616161, 0x200000, 0x123456):
        every = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** log10_probability(every, by_depth, top)).sum() - 1) < 1e-9
    for test in (b"aab aa", b"zq", b"", train[0]):
        got = log10_probability(grams_of([test], 3), by_depth, top).sum()
        assert abs(got - plain_ctw(train, test, 3)) < 1e-9


def test_operator_over_many_chunks(spark):
    rng = random.Random(2)
    texts = [None, "", " \t", "A b a", "x" * 3000] + [" ".join(rng.choice(["Aa", "bé", "c\0"]) for _ in range(40)) for _ in range(30)]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "a b", "s", 1)]
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.id: r for r in language_model(df, fold != 1, depth=4, chunk_bytes=500).collect()}
    raw = {i: (t or "").encode().lower() for i, t, *_ in rows}
    train = [raw[i] for i in raw if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in t.split())
    counts[None] = len(train)
    n, v = sum(counts.values()), len(counts)
    by_depth, top = tree(train, 4)
    assert got.keys() == raw.keys()
    for i, t in raw.items():
        words = [*t.split(), None]
        base = sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in words)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
        want = log10_probability(grams_of([t], 4), by_depth, top).sum()
        assert abs(r.score - want) < 1e-5 * abs(want)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.id: r for r in language_model(df, F.lit(None).cast("boolean")).collect()}
    assert got[1].train_tokens == 0 and got[1].n_known == 0
    assert abs(got[1].score - 24 * math.log10(.5)) < 1e-6 and abs(got[2].score - 8 * math.log10(.5)) < 1e-6
    assert language_model(df.limit(0), F.lit(True)).collect() == []
