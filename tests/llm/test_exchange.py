"""Messages between chunks and buckets: parts of large buckets, bytes that grow with the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm import exchange
from cohortline.llm.ctw import language_model
from cohortline.llm.exchange import gather, parts_of, reply


def messages(spark, chunks, buckets=4, hot=30):
    """Each chunk writes to every bucket, much more to bucket 0; bodies are sets of numbers below 50."""
    rows = [(b, c, bytes(((c * 7 + b + k) % 50) for k in range(hot if b == 0 else 3))) for c in range(chunks) for b in range(buckets)]
    return spark.createDataFrame(rows, "bucket int, chunk long, body binary").repartition(5)


def toys():
    """Merge: the numbers of all bodies. Answer: the bucket, the model's size, how many numbers of the body it has."""
    def merge(bucket, bodies):
        return bytes(sorted(set(b"".join(bodies))))

    def answer(bucket, model):
        return lambda bodies: [bytes([bucket, len(model), sum(x in model for x in b)]) for b in bodies]

    return merge, answer


@pytest.mark.parametrize("group, part", [(512, 10 ** 9), (3, 200), (1, 1)])
def test_every_message_is_answered_by_the_whole_model(spark, monkeypatch, group, part):
    monkeypatch.setattr(exchange, "GROUP_CHUNKS", group)
    monkeypatch.setattr(exchange, "PART_BYTES", part)
    merge, answer = toys()
    sent = messages(spark, 40)
    model = gather(sent, merge, 40, "m")
    got = {(r.bucket, r.chunk): bytes(r.body) for r in reply(model, sent, answer, 40).collect()}
    size = {r.bucket: len(r.body) for r in model.collect()}
    want = {(r.bucket, r.chunk): bytes([r.bucket, size[r.bucket], len(r.body)]) for r in sent.collect()}
    assert got == want


def test_copies_of_models_stay_below_the_messages(spark, monkeypatch):
    monkeypatch.setattr(exchange, "PART_BYTES", 1)
    (merge, _), moved = toys(), {}
    for chunks in (50, 100, 200):
        sent = messages(spark, chunks)
        model = gather(sent, merge, chunks, "m")
        copies = (parts_of(model, sent).join(model, F.col("of") == F.col("bucket"))
                  .agg(F.sum(F.col("parts") * F.octet_length("body"))).first()[0] or 0)
        total = sent.agg(F.sum(F.octet_length("body"))).first()[0]
        assert copies <= total
        moved[chunks] = copies + total
    assert moved[100] <= 2.2 * moved[50] and moved[200] <= 2.2 * moved[100]  # linear, not with the square
    assert parts_of(model, sent).where("of = 0").first().parts > 1  # the hot bucket is several tasks' work


def test_language_model_in_parts_is_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(rng.choice(["the", "cat", "sat", "on", "mat"], 30))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {r.id: r.score for r in language_model(df, F.col("doc_id") % 5 != 1).collect()}
    monkeypatch.setattr(exchange, "GROUP_CHUNKS", 2)
    monkeypatch.setattr(exchange, "PART_BYTES", 500)
    parts = {r.id: r.score for r in language_model(df, F.col("doc_id") % 5 != 1, chunk_bytes=600).collect()}
    assert plain.keys() == parts.keys() and all(abs(plain[k] - parts[k]) < 1e-6 * abs(plain[k]) for k in plain)
