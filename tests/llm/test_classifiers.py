"""Toxicity and quality: held-out accuracy and odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from cohortline.llm import quality, toxicity

BAD = ["grumox", "veldrat", "snorkip"]


def words(rng, n, caps=False):
    out = ["".join(rng.choice("aeiolnrst") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w.upper() if caps else w for w in out)


def toxic_corpus(n=900):
    rng = random.Random(6)
    for i in range(n):
        sentences = [words(rng, rng.randint(3, 12)) for _ in range(rng.randint(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(BAD) + rng.choice(["", "s", "ly"])
        yield i, ". ".join(sentences), int(toxic)


def test_toxicity_on_held_out_documents(spark):
    made = list(toxic_corpus())
    rows = [(i, t, "src", 0.5) for i, t, _ in made] + [(5000, None, None, None), (5001, "", "s", 1.0), (5001, "", "s", 1.0), (None, "grumox", "s", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    marks = [(i, y) for i, _, y in made if i % 3] + [(None, 1), (7, None), (5000, 0)]
    model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = {}
    for r in toxicity.score(docs, model).collect():
        got.setdefault(r.id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    held = [(got[i][0].score >= .3, y) for i, _, y in made if i % 3 == 0]
    assert np.mean([a == bool(y) for a, y in held]) > 0.97
    for i, t, y in made:
        if y and i % 3 == 0 and got[i][0].score >= .5:
            assert all(any(b in s.text for b in BAD) for s in got[i][0].offending)
    assert got[5000][0].score == got[5001][0].score < .3 and got[5000][0].offending == []
    assert 0 <= min(r.score for x in got.values() for r in x) and max(r.score for x in got.values() for r in x) <= 1


def test_every_telling_feature_has_a_weight_and_copies_count_once(spark, monkeypatch):
    counts = spark.range(3000).selectExpr("concat('w', id) as word", "if(id < 1500, 12L, 30L) as pos", "if(id < 1500, 0L, 90L) as neg")
    assert sorted(toxicity.choose_words(counts, 250, 750)) == sorted(f"w{i}" for i in range(1500))
    seen = []
    monkeypatch.setattr(toxicity, "choose_words", lambda counts, n_pos, n_neg, *rest: seen.append((n_pos, n_neg)) or [])
    rows = [(i, "copied words") for i in range(60)] + [(i, f"text {i}") for i in range(60, 100)]
    labels = spark.createDataFrame([(i, int(i < 70)) for i in range(100)], "doc_id long, toxic int")
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen == [(11, 30)]


def test_chance_is_not_chosen_and_rare_words_are(spark):
    """Thousands of words that say nothing beside a few that tell, one of them in few texts only."""
    rng = np.random.default_rng(5)
    n_pos, n_neg = 200, 1800
    total = rng.integers(1, 120, 20000)
    pos = rng.hypergeometric(n_pos, n_neg, total)
    rows = [(f"n{i}", int(p), int(t - p)) for i, (p, t) in enumerate(zip(pos, total))]
    rows += [(f"t{i}", 40, 2) for i in range(60)] + [("rare", 7, 0)]
    counts = spark.createDataFrame(rows, "word string, pos long, neg long")
    got = toxicity.choose_words(counts, n_pos, n_neg)
    assert {"rare", *(f"t{i}" for i in range(60))} <= set(got)
    assert sum(w[0] == "n" for w in got) <= .1 * len(got) + 2
    doubled = counts.unionByName(counts.where("word like 'n%'").selectExpr("concat(word, 'x')", "pos", "neg").toDF("word", "pos", "neg"))
    more = toxicity.choose_words(doubled, n_pos, n_neg)
    assert sum(w[0] == "n" for w in more) <= .1 * len(more) + 2  # the bar rises with the features tested


def test_samples_are_bounded_whatever_is_repeated(spark, monkeypatch):
    """One id with very many texts, one text under very many ids: neither comes whole."""
    seen = []
    bags, co_train = toxicity.bags, quality.co_train
    monkeypatch.setattr(toxicity, "bags", lambda rows, words: seen.append(rows.count()) or bags(rows, words))
    monkeypatch.setattr(quality, "co_train", lambda a, b, y, ua, ub, **k: seen.append((len(y), len(ua))) or co_train(a, b, y, ua, ub, **k))
    rows = [(1, f"text {i} of one id") for i in range(2000)] + [(i, "one text of many ids") for i in range(2, 2002)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(1, 1), *((i, 0) for i in range(2, 2002))], "doc_id long, toxic int"), sample=100)
    assert 50 < seen[0] < 160
    quality.train(docs, spark.createDataFrame([(1, 1), *((i, 0) for i in range(2, 2002))], "doc_id long, quality int"), labelled=100, pool=200)
    assert 0 < seen[1][0] < 160 and 0 < seen[1][1] < 280


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, none)).first().score < 1e-6
    ones = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, ones)).first().score > .99
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), none)).collect() == []


def test_noisy_or():
    model = toxicity.Model({"bad": 20.0}, -10.0, -12.0)
    p = model.sentence_scores("Bad things. good things")
    assert p[0] > .99 > 1e-3 > p[1]
    assert abs(model.document_score(p) - (1 - (1 - p[0]) * (1 - p[1]) * (1 - 1 / (1 + np.exp(12))))) < 1e-9


def quality_corpus(n=1200):
    rng = random.Random(8)
    for i in range(n):
        good = i % 5 != 0
        lines = [words(rng, rng.randint(5, 20), caps=not good and i % 2 == 0) for _ in range(rng.randint(1, 6))]
        text = ".\n".join(lines) if good or i % 2 == 0 else "$$$ ".join(lines) + " ###" * 9
        yield i, text, rng.choice(["a", "b"]) if good else rng.choice(["c", "b"]), "en", len(text), int(good)


def test_quality_on_held_out_documents(spark):
    made = list(quality_corpus())
    rows = [r[:5] for r in made] + [(5000, None, None, None, None), (5001, "", "a", "en", 0), (5001, "", "a", "en", 0), (None, "a b c", "a", "en", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    marks = spark.createDataFrame([(r[0], r[5]) for r in made if r[0] % 3] + [(None, 0), (4, None)], "doc_id long, quality int")
    model = quality.train(docs, marks, pool=400)
    got = quality.score(docs, model)
    assert got.count() == len(rows)
    score = {r.id: r.score for r in got.collect()}
    assert np.mean([(score[r[0]] >= .5) == bool(r[5]) for r in made if r[0] % 3 == 0]) > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 5000").count() == sum(score[r[0]] >= .5 for r in made)
    assert quality.keep_good(docs.limit(0), model).collect() == []


def test_quality_without_labels_keeps_everything(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.keep_good(docs, model).count() == 2


def test_views_exchange_pseudo_labels():
    """The text view is blind on part of the documents; the pool labelled by the other view teaches it."""
    rng = np.random.default_rng(3)
    n, m = 60, 2000
    y, u = rng.integers(0, 2, n).astype(float), rng.integers(0, 2, m).astype(float)
    view = lambda t, noise: np.column_stack([t[:, None] * 2 - 1 + rng.normal(size=(len(t), 3)) * noise, rng.normal(size=(len(t), 25))])
    a, b, pa_, pb = view(y, 2.5), view(y, .6), view(u, 2.5), view(u, .6)
    alone = quality.co_train(a, b, y, pa_[:0], pb[:0])
    together = quality.co_train(a, b, y, pa_, pb, rounds=8, handed=.1)
    test = rng.integers(0, 2, 3000).astype(float)
    x = view(test, 2.5)
    right = lambda model: np.mean((model.text.logit(x) > 0) == (test > 0))
    assert right(together) > right(alone)
