"""Pfair mixing: schedule, deviation, order and odd rows."""

import hashlib
from collections import Counter

import pytest

from cohortline.llm.catalog import ORACLE_SQL
from cohortline.llm.mixing import mix, op8_pfair_mix, period, quotas
from cohortline.plans.verify import canon, duck
from tests.conftest import SF_SMALL


def plain_period(turns, slots):
    had, out = dict.fromkeys(turns, 0), []
    for t in range(slots):
        ready = [s for s in turns if had[s] * slots // turns[s] <= t]
        s = min(ready, key=lambda s: (-(-(had[s] + 1) * slots // turns[s]), s))
        out.append((s, had[s], t))
        had[s] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 5.0, "b": 1.0, "c": 1.0, "d": .3}, {"a": .36, **{f"s{i}": .034 for i in range(19)}}])
def test_schedule_is_earliest_deadline_first(spark, weights):
    slots = 64
    turns = quotas(spark.createDataFrame(list(weights.items()), "source string, weight double"), slots)
    w = {r.source: r.turns for r in turns.collect()}
    assert sum(w.values()) == slots and min(w.values()) >= 1
    got = sorted((tuple(r) for r in period(turns, slots).collect()), key=lambda r: r[2])
    assert got == plain_period(w, slots)
    seen = Counter()
    for t, (s, _, _) in enumerate(got, 1):
        seen[s] += 1
        assert all(abs(seen[x] - w[x] * t / slots) < 1 for x in w)
    assert {s: seen[s] for s in w} == w


def test_mix_keeps_every_row_and_the_shares(spark):
    rows = [(i, s, i * 2, "x") for i, s in enumerate(["a"] * 70 + ["b"] * 9 + [None] * 20 + ["c"])]
    rows += [(None, "b", 1, "y"), (5, "a", 10, "x")]  # a null id, a repeated row
    df = spark.createDataFrame(rows, "doc_id long, source string, slot long, rank string").repartition(5)
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), (None, 2.0), ("none", 4.0), ("c", 0.0)], "source string, weight double")
    got = mix(df, weights, block_rows=2, slots=16)
    assert got.columns == ["doc_id", "source", "slot", "rank", "source_block", "slot_", "epoch", "position"]
    out = sorted(got.collect(), key=lambda r: r.position)
    first = Counter((r.doc_id, r.source, r.slot, r["rank"]) for r in out if r.epoch == 0)
    assert first == Counter(r for r in rows if r[1] != "c")
    assert len({r.position for r in out}) == len(out)
    blocks = {r.slot_: r.source for r in out}
    assert sorted(blocks) == list(range(len(blocks)))
    share, seen = {"a": .25, "b": .25, None: .5}, Counter()
    for t in range(len(blocks)):
        seen[blocks[t]] += 1
        assert all(abs(seen[s] - share[s] * (t + 1)) < 1 for s in share)
    order = [r.doc_id for r in out if r.source is None and r.epoch == 0]
    assert order == sorted(order, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_large_sources_are_ranked_in_ranges(spark, monkeypatch):
    from cohortline.llm import mixing

    df = spark.range(500).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 5)) as source")
    whole = {tuple(r) for r in mix(df).collect()}
    monkeypatch.setattr(mixing, "RANK_ROWS", 7)
    assert {tuple(r) for r in mix(df).collect()} == whole


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], "doc_id long, source string")).collect() == []


def test_query_matches_sql(spark):
    got = op8_pfair_mix(spark, SF_SMALL)
    want = duck(SF_SMALL).sql(ORACLE_SQL["op8_pfair_mix"])
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(want.fetchall(), want.columns)


def test_native_plan(spark):
    plan = mix(spark.range(9).selectExpr("id as doc_id", "'a' as source"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def deviation(out, share):
    """The farthest any source is from its unrounded share, in blocks, over the whole mix."""
    blocks = {r.slot: r.source for r in out}
    assert sorted(blocks) == list(range(len(blocks)))
    seen, most = Counter(), 0
    for t in range(len(blocks)):
        seen[blocks[t]] += 1
        most = max(most, *(abs(seen[s] - share[s] * (t + 1)) for s in share))
    return most


@pytest.mark.parametrize("others", [4, 19, 99])
def test_shares_are_those_of_the_unrounded_weights(spark, others):
    share = {"hot": 1 / 3, **{f"s{i}": 2 / 3 / others for i in range(others)}}
    df = spark.sql(f"select id as doc_id, if(id < 3000, 'hot', concat('s', id % {others})) as source from range({3000 + others})")
    out = mix(df, spark.createDataFrame(list(share.items()), "source string, weight double"), block_rows=1).collect()
    assert {r.doc_id for r in out} == set(range(3000 + others)) and len(out) > 8000
    assert deviation(out, share) < 1.5


def test_uneven_weights_without_rounding(spark):
    weight = {f"s{i}": 1.37 ** -(i % 23) * (1 + i / 7) for i in range(60)}
    total = sum(weight.values())
    df = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 60) as source")
    out = mix(df, spark.createDataFrame(list(weight.items()), "source string, weight double"), block_rows=4).collect()
    assert len({r.position for r in out}) == len(out)
    assert deviation(out, {s: w / total for s, w in weight.items()}) < 2


def test_more_sources_than_slots(spark):
    from cohortline.llm.mixing import SLOTS

    df = spark.range(9000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 3001)) as source")
    n = Counter(r.source for r in df.collect())
    weight = {s: c ** .7 for s, c in n.items()}
    total = sum(weight.values())
    assert len(n) > 3000
    for slots in (SLOTS, None):
        out = mix(df, slots=slots).collect()
        assert {r.doc_id for r in out if r.epoch == 0} == set(range(9000))
        blocks = Counter(s for _, s in {(r.slot, r.source) for r in out})
        assert sum(blocks.values()) == max(r.slot for r in out) + 1
        assert all(abs(blocks[s] - weight[s] / total * sum(blocks.values())) < 2 for s in n)
