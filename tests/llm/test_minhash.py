"""One-permutation MinHash: fingerprints, estimates and the order of the documents."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortline.llm import minhash
from cohortline.llm.minhash import fingerprint, likeness, op12_minhash_fingerprints, with_next
from tests.conftest import SF_SMALL


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(docs):
    """(id, text, next text) of every row, as the docstring orders them."""
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return rows, Counter((*r, rows[(k + 1) % len(rows)][1]) for k, r in enumerate(rows))


def written(tmp_path, spark, rows, schema="doc_id long, text string, h int, part string, own int"):
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text or "") for r in
                  spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op12_minhash_fingerprints(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    off, far = [], []
    for k, (i, text) in enumerate(docs):
        after, half, r = docs[(k + 1) % len(docs)][1], len(text) // 2, got[i]
        edited = text[:len(text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(r.fingerprint) == (2 * minhash.BINS if text.strip() else 0)
        off.append(r.near_edited - jaccard(text, edited))
        far.append(r.near_next - jaccard(text, after))
    for errors in (off, far):
        assert abs(sum(errors) / len(errors)) < .01 and sum(e * e for e in errors) / len(errors) < .035 ** 2
        assert max(map(abs, errors)) < .15


@pytest.mark.parametrize("bins, bits", [(64, 8), (512, 8), (256, 16)])
def test_estimates_without_bias(spark, bins, bits):
    pairs = []
    for k in range(300):
        words = [f"w{k}x{j}" for j in range(40 + 4 * k)]
        pairs.append((" ".join(words), " ".join(words[:len(words) // 2] + [w + "y" for w in words[len(words) // 2:]])))
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", fingerprint("a", bins, bits).alias("x"), fingerprint("b", bins, bits).alias("y"))
    rows = df.select("a", "b", "x", likeness("x", "y", bins, bits).alias("j"), likeness("x", "x", bins, bits).alias("one")).collect()
    errors = [r.j - jaccard(r.a, r.b) for r in rows]
    assert abs(sum(errors) / len(errors)) < 4 * (.25 / bins / len(errors)) ** .5 + .005
    assert all(len(r.x) == bins * bits // 4 and r.one == 1 for r in rows)


def test_odd_texts(spark):
    texts = [None, "", " \t\n", "one", "ONE ", "two", "a b c d", "a b c d e", "A\tb\x0bc d  e", "ü ß 漢字", "a " * 50000 + "b"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("f", fingerprint("t"))
    f = {r.k: r.f for r in df.collect()}
    assert f[0] == f[1] == f[2] == "" and f[3] == f[4] != f[5] and f[7] == f[8] != f[6]
    pair = df.alias("l").crossJoin(df.alias("r")).select(F.col("l.k").alias("i"), F.col("r.k").alias("j"), F.col("l.f").alias("x"), F.col("r.f").alias("y"))
    near = {(r.i, r.j): r.n for r in pair.withColumn("n", likeness("x", "y")).collect()}
    assert near[0, 2] == near[7, 8] == 1 and near[0, 3] == 0 and near[3, 5] < .1 and near[7, 10] < .1
    assert all(near[i, j] == near[j, i] and 0 <= near[i, j] <= 1 for i, j in near)


def test_short_sets_borrow_alike(spark):
    """Few shingles in many bins: nearly all bins are borrowed, the estimate stays near the truth."""
    pairs = [(" ".join(f"{k}a{j}" for j in range(9)), " ".join(f"{k}a{j}" for j in range(11))) for k in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string").select(fingerprint("a").alias("x"), fingerprint("b").alias("y"))
    got = [r.j for r in df.select(likeness("x", "y").alias("j")).collect()]
    assert abs(sum(got) / len(got) - 5 / 7) < .03


@pytest.mark.parametrize("rows", [
    [(None, "n two"), (None, None), (3, "c"), (1, "a"), (2, ""), (2, "b"), (2, "b"), (9, "x y z"), (-5, "q")],
    [(7, "only")],
    [(7, "same")] * 3,
    [(5, f"text {k % 40}") for k in range(150)] + [(None, f"null {k % 3}") for k in range(60)] + [(k, f"own {k}") for k in range(100)],
])
def test_next_with_ties_nulls_and_a_frequent_id(spark, tmp_path, rows):
    docs = spark.read.parquet(f"{written(tmp_path, spark, rows)}/documents.parquet")
    pairs = with_next(docs).collect()
    order, _ = plain(rows)
    got = Counter()
    for r in pairs:
        got[r.id, r.text, r.next_text] += 1
        got[r.id, r.text, r.text] += r.times - 1
    assert Counter(k[:2] for k in got.elements()) == Counter(order)
    # One round through all rows: equal rows side by side, ids ascending, each row with one before and one after.
    assert Counter(k[1] for k in got.elements()) == Counter(k[2] for k in got.elements())
    single = {i: t for i, t in order if sum(j == i for j, _ in order) == 1 and i is not None}
    after = {k[0]: k[2] for k in got.elements()}
    for (i, _), (j, text) in zip(order, order[1:]):
        if i in single and j in single:
            assert after[i] == text
    out = op12_minhash_fingerprints(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in out) == Counter((i, len(t)) for i, t in order)


def test_empty_table(spark, tmp_path):
    out = op12_minhash_fingerprints(spark, written(tmp_path, spark, []))
    assert out.collect() == []
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_native_plan(spark):
    plan = op12_minhash_fingerprints(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
