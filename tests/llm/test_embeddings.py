"""Embedding classes and link counts against brute force."""

import numpy as np

from cohortline.llm.embeddings import near_duplicates, plan

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 24))
    made = [c + rng.normal(size=24) * s for c in centre for s in (0, .1, .2, .3, .3, .35)]
    made += [centre[0] + rng.normal(size=24) * .05 for _ in range(60)] + [made[3]] * 5 + [made[3] * 2]
    made = [np.asarray(v, np.float32) for v in made]
    nan = float("nan")
    odd = [None, [], [0.0] * 24, [1.0, None], [nan] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0], [1.0, 2.1]]
    rows = [(i, [float(x) for x in v], 1, "x") for i, v in enumerate(made)]
    rows += [(len(made) + i, v, None, "x") for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.id: r for r in near_duplicates(df).collect()}
    m = np.array(made, np.float64)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    near = m @ m.T >= 0.9
    label = np.arange(len(m))
    for _ in range(len(m)):
        label = np.array([label[n].min() for n in near])
    links = sum(got[i].n_links for i in range(len(m)))
    true = int(near.sum()) - len(m)
    assert 0.97 * true <= links <= true
    assert all(got[i].n_links <= near[i].sum() - 1 for i in range(len(m)))
    assert np.mean([got[i].component_id == label[i] for i in range(len(m))]) > 0.97
    for i in range(len(made), len(rows) - 2):
        assert (got[i].n_links, got[i].component_id) == (0, i)
    assert [got[i].n_links for i in (len(rows) - 2, len(rows) - 1)] == [1, 1]  # other dimension


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0], 1, "x"), (4, [1.0], 1, "x")], SCHEMA)
    assert {(r.id, r.n_links, r.component_id) for r in near_duplicates(df).collect()} == {(None, 0, None), (4, 0, 4)}
    assert near_duplicates(df.limit(0)).collect() == []


def test_plan_grows_with_the_rows():
    assert plan(10) == plan(0) and plan(10 ** 6)[0] > plan(10 ** 4)[0]
    for rows in (100, 10 ** 5, 10 ** 8):
        bits, tables = plan(rows)
        p = 1 - np.arccos(0.9) / np.pi
        assert 1 - (1 - p ** bits) ** tables >= 0.999
