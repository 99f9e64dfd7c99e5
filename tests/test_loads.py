"""Stored tables under load: one visible change per load, versions, replaced tables, buckets."""

import dataclasses
import datetime as dt
import os

import pytest

from cohortline.operators import load
from cohortline.operators.load import LoadConflict, bucket_rows, full_refresh, publish_window, replace_table
from cohortline.plans import jobs
from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.plans.verify import canon
from cohortline.sources.tables import test_inputs as driver_inputs
from tests.conftest import SF_SMALL


def day(n):
    return dt.date(2024, 1, n)


def frame(spark, rows):
    """Rows (id, value, day of January or None)."""
    return spark.createDataFrame([(i, v, d and dt.datetime(2024, 1, d, 9)) for i, v, d in rows], "id long, value string, at timestamp_ntz")


def rows_of(spark, table):
    return sorted((r.id, r.value, r.at and r.at.day) for r in spark.table(table).collect())


def fresh(spark, table, rows):
    for name in (table, f"{table}__old"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = frame(spark, rows).selectExpr("*", "to_date(at) as hit_day")
    first.write.partitionBy("hit_day").format("parquet").saveAsTable(table)


OLD = [(k, "old", d) for k, d in enumerate([1, 2, 2, 3, 4, None])]


def put(spark, table, rows, lo, hi):
    return publish_window(frame(spark, rows), table, "at", day(lo), day(hi))


def test_window_is_seen_before_or_after_never_half(spark, monkeypatch):
    fresh(spark, "ld_mid", OLD)
    new = [(10, "new", 2), (11, "new", 3), (12, "new", 5), (13, "outside", 9)]
    seen = []
    overwrite, sql = load._overwrite_days, type(spark).sql

    def spied(s, text, *args, **kwargs):
        out = sql(s, text, *args, **kwargs)
        if text.startswith("ALTER TABLE ld_mid"):
            seen.append(rows_of(spark, "ld_mid"))
        return out

    def before_and_after(*args):
        seen.append(rows_of(spark, "ld_mid"))
        overwrite(*args)
        seen.append(rows_of(spark, "ld_mid"))

    monkeypatch.setattr(load, "_overwrite_days", before_and_after)
    monkeypatch.setattr(type(spark), "sql", spied)
    put(spark, "ld_mid", new, 2, 4)
    old, want = sorted(OLD, key=str), sorted([OLD[0], OLD[5], *new[:2]], key=str)
    assert [sorted(s, key=str) for s in seen] == [old] * (len(seen) - 2) + [want] * 2
    days = {r[0] for r in spark.sql("SHOW PARTITIONS ld_mid").collect()}
    assert "hit_day=2024-01-04" not in days  # emptied days are dropped


def test_second_of_two_interleaved_loads_fails_and_changes_nothing(spark, monkeypatch):
    fresh(spark, "ld_two", OLD)
    stage_run = load._stage_run

    def meanwhile(*args):
        run = stage_run(*args)
        with monkeypatch.context() as m:
            m.setattr(load, "_stage_run", stage_run)
            m.setattr(load._Loads, "staged", lambda self: [])  # the other load does not see this one's stage yet
            put(spark, "ld_two", [(20, "other", 3)], 3, 4)
        return run

    monkeypatch.setattr(load, "_stage_run", meanwhile)
    with pytest.raises(LoadConflict, match="2024-01-03 to 2024-01-04"):
        put(spark, "ld_two", [(10, "late", 2)], 2, 3)
    want = sorted([OLD[0], OLD[1], OLD[2], OLD[5], (20, "other", 3)], key=str)
    assert sorted(rows_of(spark, "ld_two"), key=str) == want
    assert load._Loads(spark, "ld_two").staged() == []  # nothing is left to be published later
    monkeypatch.undo()
    put(spark, "ld_two", [(10, "again", 2)], 2, 3)
    assert sorted(rows_of(spark, "ld_two"), key=str) == sorted([OLD[0], OLD[5], (10, "again", 2)], key=str)


def test_interleaved_loads_of_different_days_both_count(spark, monkeypatch):
    fresh(spark, "ld_apart", OLD)
    stage_run = load._stage_run

    def meanwhile(*args):
        run = stage_run(*args)
        with monkeypatch.context() as m:
            m.setattr(load, "_stage_run", stage_run)
            m.setattr(load._Loads, "staged", lambda self: [])
            put(spark, "ld_apart", [(20, "other", 3)], 3, 4)
        return run

    with monkeypatch.context() as m:
        m.setattr(load, "_stage_run", meanwhile)
        put(spark, "ld_apart", [(10, "mine", 1)], 1, 1)
    want = [OLD[1], OLD[2], OLD[5], (10, "mine", 1), (20, "other", 3)]
    assert sorted(rows_of(spark, "ld_apart"), key=str) == sorted(want, key=str)


def test_stage_published_by_another_load_is_not_published_twice(spark, monkeypatch):
    """A load finds a complete stage, publishes it and then its own; the stage's load goes home."""
    fresh(spark, "ld_help", OLD)
    stage_run = load._stage_run

    def meanwhile(*args):
        run = stage_run(*args)
        with monkeypatch.context() as m:
            m.setattr(load, "_stage_run", stage_run)
            put(spark, "ld_help", [(20, "later", 2)], 2, 2)
        return run

    with monkeypatch.context() as m:
        m.setattr(load, "_stage_run", meanwhile)
        put(spark, "ld_help", [(10, "first", 2), (11, "first", 3)], 2, 3)
    want = [OLD[0], OLD[4], OLD[5], (11, "first", 3), (20, "later", 2)]
    assert sorted(rows_of(spark, "ld_help"), key=str) == sorted(want, key=str)


def test_open_reader_keeps_its_files_and_old_ones_go_later(spark):
    fresh(spark, "ld_files", OLD)
    reader = spark.read.parquet(*spark.table("ld_files").inputFiles())
    put(spark, "ld_files", [(10, "a", 2)], 1, 4)
    assert reader.count() == len(OLD)  # the replaced files are still there
    middle = spark.read.parquet(*spark.table("ld_files").where("hit_day is not null").inputFiles())
    put(spark, "ld_files", [(11, "b", 2)], 1, 4)
    assert middle.count() == 1
    put(spark, "ld_files", [(12, "c", 2)], 1, 4)
    root = load._Loads(spark, "ld_files").root.removeprefix("file:")
    assert [n for n in os.listdir(f"{root}/_loads") if n[0] == "v"].count("v1") == 0  # nothing of the first load is left
    assert load._Loads(spark, "ld_files").version() == 3
    kept = [d for d, _, names in os.walk(root) if any(n.endswith(".parquet") for n in names) and "window" not in d]
    assert len(kept) == 3  # the null day, the rows of the last load and of the one before it
    assert sorted(rows_of(spark, "ld_files"), key=str) == sorted([OLD[5], (12, "c", 2)], key=str)


def test_claims_are_exclusive(spark, tmp_path):
    path = f"file:{tmp_path}/v1"
    assert load._create_new(spark, path, "one") and not load._create_new(spark, path, "two")
    assert load._read_file(spark, path) == "one"


def test_missing_table_and_other_types(spark):
    spark.sql("DROP TABLE IF EXISTS ld_none")
    put(spark, "ld_none", [(1, "a", 2), (2, "b", None)], 1, 4)
    assert rows_of(spark, "ld_none") == [(1, "a", 2)]
    narrow = frame(spark, [(7, "c", 3)]).selectExpr("cast(id as int) as id", "value", "at")
    publish_window(narrow, "ld_none", "at", day(3), day(3))
    assert rows_of(spark, "ld_none") == [(1, "a", 2), (7, "c", 3)]
    assert dict(spark.table("ld_none").dtypes)["id"] == "bigint"


# --- create or replace ---------------------------------------------------------------

def failing(spark):
    return spark.range(5).selectExpr("id", "if(id = 3, raise_error('lost'), 'x') as value")


@pytest.mark.parametrize("options", [{}, {"partition_by": "value"}, {"buckets": 2, "bucket_cols": ["id"]}])
def test_failed_replacement_leaves_the_old_rows(spark, options):
    spark.sql("DROP TABLE IF EXISTS ld_refresh")
    replace_table(spark.range(3).selectExpr("id", "'a' as value"), "ld_refresh", **options)
    with pytest.raises(Exception, match="lost"):
        replace_table(failing(spark), "ld_refresh", **options)
    assert sorted(map(tuple, spark.table("ld_refresh").select("id", "value").collect())) == [(0, "a"), (1, "a"), (2, "a")]


def test_table_that_reads_itself(spark):
    spark.sql("DROP TABLE IF EXISTS ld_self")
    full_refresh(spark.range(3).selectExpr("id", "1 as n"), table="ld_self")
    for k in range(3):
        full_refresh(spark.table("ld_self").selectExpr("id", "n + 1 as n"), table="ld_self")
        assert {r.n for r in spark.table("ld_self").collect()} == {k + 2}
    other = full_refresh(spark.table("ld_self").selectExpr("id", "'x' as other"), table="ld_self")  # other columns
    assert other.columns == ["id", "other"] and spark.table("ld_self").count() == 3


def test_driver_dies_between_two_renames(spark):
    for t in ("ld_rename", "ld_rename__old"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    replace_table(spark.range(3).selectExpr("id"), "ld_rename")
    spark.sql("ALTER TABLE ld_rename RENAME TO ld_rename__old")
    with pytest.raises(Exception, match="lost"):
        replace_table(failing(spark), "ld_rename")
    assert spark.table("ld_rename").count() == 3


def test_backfill_that_fails_leaves_the_table(spark, inputs_small, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS ld_backfill")
    want = canon([tuple(r) for r in jobs.backfill_policy_orders(inputs_small, "ld_backfill", *P.PURCHASE_WINDOW).collect()], ["x"] * 15)
    good = R.policy_orders
    monkeypatch.setattr(R, "policy_orders", lambda *a: good(*a).selectExpr("*").where("raise_error('lost') is null"))
    with pytest.raises(Exception, match="lost"):
        jobs.backfill_policy_orders(inputs_small, "ld_backfill", *P.PURCHASE_WINDOW)
    assert canon([tuple(r) for r in spark.table("ld_backfill").collect()], ["x"] * 15) == want


# --- buckets ----------------------------------------------------------------------------

def test_bucketed_orders_and_policies_join_without_an_exchange(spark):
    from tests.test_plans import formatted

    inputs = driver_inputs(spark, SF_SMALL)
    for t in ("ld_orders", "ld_policies"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    jobs.backfill_policy_orders(inputs, "ld_orders", *P.BACKFILL_WINDOW, buckets=4)
    jobs.daily_policy_orders(inputs, "ld_orders", today=P.DAILY_TODAY)
    files = [f for f in spark.table("ld_orders").inputFiles()]
    days = spark.table("ld_orders").select(jobs.DAY_PARTITION).distinct().count()
    assert len(files) <= 4 * days  # the daily load too writes one file per day and bucket
    stored = jobs.snapshot_policies(inputs, "ld_policies", 4)
    assert len(stored.inputFiles()) <= 4
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.table("ld_orders").drop(jobs.DAY_PARTITION)
        whole = R.scheduled_retention_base(dataclasses.replace(inputs, policies=stored), orders, *P.DASHBOARD_WINDOW)
        assert "Exchange" not in formatted(whole)
        want = R.scheduled_retention_base(inputs, R.daily_refresh(inputs, R.policy_orders(inputs, *P.BACKFILL_WINDOW), *P.DAILY_WINDOW), *P.DASHBOARD_WINDOW)
        assert canon([tuple(r) for r in whole.collect()], whole.columns) == canon([tuple(r) for r in want.select(*whole.columns).collect()], whole.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_rows_dealt_as_buckets_file_them(spark):
    df = bucket_rows(spark.range(200).selectExpr("cast(id as string) as k"), 5, ["k"])
    parts = df.selectExpr("spark_partition_id() as p", "pmod(hash(k), 5) as b").distinct().collect()
    assert all(r.p == r.b for r in parts)


# --- each key once ----------------------------------------------------------------------

def once(spark, table, rows, lo, hi, **options):
    publish_window(frame(spark, rows), table, "at", day(lo), day(hi), once_by="id", **options)
    return rows_of(spark, table)


def test_key_stays_on_its_earliest_day(spark):
    fresh(spark, "ld_once", [])
    assert once(spark, "ld_once", [(1, "a", 3), (2, "a", 4)], 3, 5) == [(1, "a", 3), (2, "a", 4)]
    # Seen again later: not loaded; a new key is.
    assert once(spark, "ld_once", [(1, "b", 7), (3, "b", 8)], 6, 8) == [(1, "a", 3), (2, "a", 4), (3, "b", 8)]
    # An earlier window, loaded late: the later days lose their rows to it, in the same change.
    assert once(spark, "ld_once", [(3, "c", 1), (2, "c", 2)], 1, 2) == [(1, "a", 3), (2, "c", 2), (3, "c", 1)]
    # The window itself is replaced as ever, and again without effect.
    for _ in range(2):
        assert once(spark, "ld_once", [(1, "d", 4), (9, "d", 4)], 3, 5) == [(1, "d", 4), (2, "c", 2), (3, "c", 1), (9, "d", 4)]
    # Null keys and other rows of a rewritten day stay.
    with_null = [(None, "n", 10), (11, "n", 10), (12, "n", 10)]
    publish_window(frame(spark, with_null), "ld_once", "at", day(10), day(10), once_by="id")
    publish_window(frame(spark, [(12, "e", 9), (None, "e", 9)]), "ld_once", "at", day(9), day(9), once_by="id")
    got = [r for r in spark.table("ld_once").where("hit_day >= DATE'2024-01-09'").select("id", "value").collect()]
    assert sorted(map(tuple, got), key=str) == sorted([(None, "n"), (11, "n"), (12, "e"), (None, "e")], key=str)


def test_only_days_within_the_horizon_count(spark):
    fresh(spark, "ld_far", [(1, "a", 1), (2, "a", 9)])
    got = once(spark, "ld_far", [(1, "b", 12), (2, "b", 12), (3, "b", 13)], 12, 13, horizon=5)
    assert got == [(1, "a", 1), (1, "b", 12), (2, "a", 9), (3, "b", 13)]


def test_rows_read_follow_the_window(spark, monkeypatch):
    from tests.test_plans import formatted

    fresh(spark, "ld_read", [(k, "a", 1 + k % 20) for k in range(100)])
    plans = []
    keep = load.keep_keys
    monkeypatch.setattr(load, "keep_keys", lambda df, *a: plans.append(formatted(df)) or keep(df, *a))
    once(spark, "ld_read", [(5, "b", 15), (500, "b", 16)], 15, 16, horizon=3)
    assert "ReadSchema: struct<id:bigint>" in plans[0]  # the key alone, beside the partition's day
    assert "2024-01-12" in plans[0] and "2024-01-19" in plans[0] and "PartitionFilters" in plans[0]


def test_windows_in_any_order_equal_the_deduplicated_table(spark, inputs_small):
    """Window by window with each key once, and the view that reads the whole table, agree."""
    import itertools

    windows = [(day(1), day(9)), (day(10), day(18)), (day(19), day(31))]
    plain = None
    for lo, hi in windows:
        part = R.policy_orders(inputs_small, lo, hi)
        plain = part if plain is None else plain.unionByName(part)
    want = load.dedup_target(plain, ["pid"], "date_time", list(R.POLICY_ORDER_COLUMNS[1:]))
    want = canon([tuple(r) for r in want.collect()], want.columns)
    for order in itertools.permutations(windows):
        table = "ld_any"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        for lo, hi in order:
            publish_window(R.policy_orders(inputs_small, lo, hi), table, "date_time", lo, hi, once_by="pid")
        got = spark.table(table).drop("hit_day")
        assert canon([tuple(r) for r in got.collect()], got.columns) == want
