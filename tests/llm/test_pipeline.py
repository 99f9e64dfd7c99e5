"""The pipeline's stages on a small corpus, each against a brute-force version on its own input."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from cohortline.llm.decontaminate import normalise
from cohortline.llm.mixing import EXPONENT, SLOTS
from cohortline.llm.tokenfiles import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import distance
from tests.llm.test_simhash import classes, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark):
    from cohortline.llm.common import stage

    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    columns = docs.columns
    for k, (name, function) in enumerate(P.STAGES):
        after = function(spark, docs, SF_SMALL)
        if k < 4:
            assert after.columns == columns
        after = stage(after, f"test-{k}")
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_are_named():
    assert [name for name, _ in P.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
        "token-ID / binary output"]
    assert P.ORACLE_SQL is None


def test_quality_keeps_good_documents(spark, steps):
    before, after = steps[0]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = set(ids(after))
    assert kept < set(ids(before))
    good = [i in kept for i, q in label.items() if q == 1]
    bad = [i in kept for i, q in label.items() if q == 0]
    assert np.mean(good) > .97 and np.mean(bad) < .3


def test_one_document_of_each_class_stays(steps):
    before, after = steps[1]
    before = sorted(before, key=lambda r: r.doc_id)
    values = [plain_fingerprint(r.text) for r in before]
    assert ids(after) == sorted({before[c].doc_id for c in classes(values)})


def test_contaminated_documents_go(spark, steps):
    before, after = steps[2]
    items = [normalise(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = set(ids(after))
    for r in before:
        text = normalise(r.text)
        if any(t in text for t in items):
            assert r.doc_id not in kept
        elif r.doc_id not in kept:
            assert any(distance(t, text) <= int(len(t) * .08) for t in items)
    clean = [r for r in before if r.doc_id in kept][:12]
    assert all(distance(t, normalise(r.text)) > int(len(t) * .08) for r in clean if len(r.text) < 1500 for t in items[:12])


def test_sources_are_mixed_whole(steps):
    before, after = steps[3]
    count = Counter(r.source for r in before)
    assert set(ids(after)) == set(ids(before))
    weight = {s: n ** EXPONENT for s, n in count.items()}
    total = sum(weight.values())
    got = Counter(r.source for r in after)
    blocks = len(after) / 8
    for s in count:
        assert abs(got[s] / 8 - weight[s] / total * blocks) <= 1 + 2 * blocks / SLOTS


def test_tokens_follow_the_mix(steps):
    from tokenizers import Tokenizer

    before, after = steps[4]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    text = {r.doc_id: r.text for r in before}
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    start = 0
    for r in sorted(after, key=lambda r: r.start):
        encoded = [*tokenizer.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes()))
        start += r.n_tokens
    first = [r.doc_id for r in sorted(after, key=lambda r: r.start)][:8]
    assert len({next(x.source for x in before if x.doc_id == i) for i in first}) == 1  # a block of one source


def test_run_gives_the_last_stage(spark, steps):
    got = P.run(spark, SF_SMALL)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in steps[4][1])


def test_stages_take_empty_tables_and_nulls(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (3, "a b", "en", "s", 3),
                                 (3, "a b", "en", "s", 3)], docs.schema)
    for _, function in P.STAGES[:4]:
        assert function(spark, docs.limit(0), SF_SMALL).collect() == []
        assert 1 <= function(spark, odd, SF_SMALL).count() <= 32  # whole blocks of the mix
