"""Token files: exact round trip, and ids as of the whole tokenizer."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm.common import scratch
from cohortline.llm.tokenfiles import (END_ID, ShardReader, WordEncoder, from_planes, read_tokens, to_planes, token_files,
                                       tokenizer_path, write_tokens)

SCHEMA = "doc_id long, text string, start string, uri int"
TEXTS = ["", "a b c", "It's THE end, isn't it? we'll see!!!", "<|endoftext|> x <|end of", "é ́x Ünïcödé ŒUVRE", "ΑΣ ΑΣΣ İi",
         "a\x1cb c\x85d\xa0e f", "x" * 700, "12,345.67 | $$$ &&& foo-bar.baz", "tab\tnew\nline\r\n\x0b\x0cq", "日本語 テスト 🙂",
         "Word. word, WORD; wOrd's", "don't.", "-- 'tis", "\0 \x01"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def test_chunks_encode_like_whole_texts(tokenizer):
    for limit in (600_000, 3):
        encode = WordEncoder(tokenizer_path(), limit=limit)
        for _ in range(2):
            sizes, ids = encode(TEXTS)
            want = [ids_of(tokenizer, t) for t in TEXTS]
            assert sizes.tolist() == [len(w) for w in want]
            assert ids.tolist() == [i for w in want for i in w]
    assert encode([])[1].tolist() == []


@pytest.mark.parametrize("mode", ["bytes", "bits"])
def test_planes_round_trip(mode):
    rng = np.random.default_rng(0)
    for top in (1, 2, 255, 256, 49408, 2 ** 31, 2 ** 32):
        for n in (0, 1, 7, 8, 1000):
            ids = rng.integers(0, top, n).astype(np.uint32)
            assert (from_planes(to_planes(ids, mode), n, mode) == ids).all()


@pytest.mark.parametrize("mode, block", [("bytes", 50), ("bits", 64), ("bytes", 1 << 16)])
def test_files_round_trip(spark, tokenizer, mode, block):
    rows = [(i * 3 % 17, t, "x", 1) for i, t in enumerate(TEXTS)] + [(99, None, "x", 1), (None, "null id", "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(token_files(spark, df, mode=mode, block_ids=block).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, t, *_) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0])), strict=True):
        ids = ids_of(tokenizer, t)
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_repeated_rows_order_and_empty_table(spark, tokenizer):
    df = spark.createDataFrame([(2, "b", "x", 1), (1, "a a", "x", 3), (2, "b", "x", 2)], SCHEMA)
    shards = write_tokens(df, scratch(spark, "t"), order=[-F.col("uri")])
    got = sorted(read_tokens(shards).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == [1, 2, 2]
    files = sorted(shards.collect(), key=lambda f: f.shard)
    assert sum(f.n_docs for f in files) == 3
    assert [d for f in files for d, _ in ShardReader(f.uri).documents()] == [1, 2, 2]
    assert token_files(spark, df.limit(0)).collect() == []
