"""Source divergence: trees, the walk of pairs, SQL and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cohortline.llm import divergence
from cohortline.llm.divergence import Trees, audit, op11_segment_tree_audit, price, probability, split_terms
from cohortline.llm.catalog import ORACLE_SQL
from cohortline.plans.verify import canon, duck
from tests.conftest import SF_SMALL


def plain(docs, min_docs, top):
    """The audit by its definition, in whole numbers."""
    words = {}
    for k, (text, lang, source) in enumerate(docs):
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words[k] = (lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found])
    out = set()
    for lang in {w[0] for w in words.values()}:
        own = [w for w in words.values() if w[0] == lang]
        have = Counter(t for w in own for t in set(w[2]))
        kept = {t for t in have if have[t] >= min_docs}
        counts = {s: Counter(t for w in own if w[1] == s for t in w[2] if t in kept) for s in {w[1] for w in own}}
        whole = Counter(t for w in own for t in w[2] if t in kept)

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in counts.items():
            pairs = [(-sum(f(p(c, t), p(d, t)) for t in kept), o.encode()) for o, d in counts.items() if o != s]
            terms = [(-f(p(c, t), p(whole, t)), t.encode()) for t in kept if c[t] > 0 and p(c, t) > p(whole, t)]
            out |= {(lang, s, "pair", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(terms)[:top], 1)}
    return out


def corpus(n, sources, seed=1):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghijk" for b in ("x", "yY", "é", "漢", "ßq")]
    pick = lambda: " ".join(r.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=r.randrange(0, 30)))
    return [(r.choice([pick(), pick(), pick().upper() + "1-2", None, ""]), r.choice(["en", "de", None, ""]), r.choice(sources)) for _ in range(n)]


@pytest.mark.parametrize("leaves, tile, sources", [
    (4096, 32, ["a", "b", None, "", "é", "Z"]),
    (8, 2, ["hot"] * 9 + ["a", "b", "c", None, "é"]),
])
def test_against_definition(spark, monkeypatch, leaves, tile, sources):
    monkeypatch.setattr(divergence, "LEAVES", leaves)
    monkeypatch.setattr(divergence, "TILE", tile)
    docs = corpus(400, sources) + [("rare words only", "xx", "a"), ("other words", "xx", "b"), (None, "xx", None), (None, "one", "a")]
    docs += [("copy of a row", "de", "a")] * 12
    df = spark.createDataFrame([(*d, "?", 1) for d in docs], "text string, lang string, source string, term string, n int").repartition(4)
    got = [tuple(r) for r in audit(df, min_docs=5, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(docs, 5, 4)


def test_equal_subtrees_are_one_node_and_walked_once():
    leaves = np.array([[3, 0] * 64 + [0] * 128, [3, 0] * 128, [0] * 256, list(range(256))])
    trees = Trees(leaves)
    assert trees.sizes[0] == 256
    assert all(size <= 2 + 2 + 2 + 2 ** (8 - height) for height, size in enumerate(trees.sizes) if height)
    pair, x, y, times = trees.walk(np.array([0, 0, 3]), np.array([1, 2, 3]))
    assert len(pair) < 3 + 3 + 256 + 1  # a leaf pair that comes up again is counted, not listed
    for k, (a, b) in enumerate([(0, 1), (0, 2), (3, 3)]):
        got = Counter({(int(u), int(v)): int(n) for p, u, v, n in zip(pair, x, y, times) if p == k})
        assert got == Counter(zip(leaves[a].tolist(), leaves[b].tolist()))
    row, place, x, y = trees.leaves(np.arange(3), 3)
    assert {(int(r), int(p)): (int(u), int(v)) for r, p, u, v in zip(row, place, x, y)} == {
        (r, p): (int(leaves[r, p]), int(leaves[3, p])) for r in range(3) for p in range(256) if leaves[r, p]}


def test_numbers_stay_whole():
    big = np.array([10 ** 13, 5, 0])
    total = np.array([3 * 10 ** 13] * 3)
    want = [1 + 10 ** 9 * (int(c) + 2) // (3 * 10 ** 13) for c in big]
    assert probability(big, total).tolist() == want
    assert price(np.array([10 ** 9 + 1]), np.array([1])).tolist() == [10 ** 18 // (10 ** 9 + 2)]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 50)
    text = ("Ab cd, é" * 40 + "x" * 500 + " end").encode()
    assert [t for part in split_terms(text) for t in part] == re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.lower())
    assert list(split_terms(b"")) == [[]]


def test_query_matches_sql(spark):
    got = op11_segment_tree_audit(spark, SF_SMALL)
    want = duck(SF_SMALL).sql(ORACLE_SQL["op11_segment_tree_audit"])
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(want.fetchall(), want.columns)
    assert [str(t) for t in want.types] == ["VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "BIGINT", "INTEGER"]
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "string", "bigint", "int"]


def test_empty_table(spark):
    assert audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []
