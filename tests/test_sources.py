"""Reading inputs from catalog tables (the production path) and schema checks."""

import pytest
from pyspark.sql import functions as F

from cohortline.plans import params as P
from cohortline.plans import reports as R
from cohortline.plans.verify import canon
from cohortline.sources import schemas
from cohortline.sources.tables import catalog_inputs

TABLES = ("hits", "marketing_channel", "visits", "policies", "callcentre_car", "callcentre_home",
          "calendar")


@pytest.fixture(scope="module")
def stored_inputs(spark, inputs_small):
    names = {}
    for t in TABLES:
        name = f"src_{t}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        getattr(inputs_small, t).write.format("parquet").saveAsTable(name)
        names[t] = name
    return catalog_inputs(spark, **names)


def _rows(df):
    return canon([tuple(r) for r in df.collect()], df.columns)


def test_reports_from_catalog_tables_match(inputs_small, stored_inputs):
    cases = [
        lambda i: R.purchases_by_custom_channel(i, *P.PURCHASE_WINDOW),
        lambda i: R.reconciliation(i, *P.PURCHASE_WINDOW),
        lambda i: R.retention_weekly(i, *P.WEEKLY_WINDOW),
        lambda i: R.policy_orders(i, *P.DAILY_WINDOW),
    ]
    for build in cases:
        assert _rows(build(stored_inputs)) == _rows(build(inputs_small))


def test_conform_rejects_wrong_feeds(spark):
    ok = spark.createDataFrame([(1, "direct", "extra")], "channel_id bigint, channel_name string, x string")
    assert schemas.conform(ok, schemas.MARKETING_CHANNEL, "m").columns == ["channel_id", "channel_name"]
    with pytest.raises(ValueError):
        schemas.conform(ok.drop("channel_name"), schemas.MARKETING_CHANNEL, "m")
    with pytest.raises(TypeError):
        schemas.conform(ok.withColumn("channel_id", F.col("channel_id").cast("string")),
                        schemas.MARKETING_CHANNEL, "m")


def test_cli_runs_the_jobs(spark, stored_inputs):
    from cohortline import cli

    spec = ",".join(f"{t}=src_{t}" for t in TABLES)
    for t in ("cli_orders", "cli_pivot"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    assert cli.main(["backfill", "--tables", spec, "--orders-table", "cli_orders",
                     "--start", "2024-01-01", "--end", "2025-04-08"]) == 0
    n = spark.table("cli_orders").count()
    assert cli.main(["daily", "--tables", spec, "--orders-table", "cli_orders",
                     "--today", P.DAILY_TODAY.isoformat()]) == 0
    assert spark.table("cli_orders").count() == n  # same window recomputed
    assert cli.main(["dashboard", "--tables", spec, "--orders-table", "cli_orders",
                     "--out-table", "cli_pivot", "--today", P.DASHBOARD_TODAY.isoformat(),
                     "--start", P.RETENTION_START.isoformat()]) == 0
    want = R.retention_dashboard(stored_inputs, R.policy_orders(stored_inputs, *P.BACKFILL_WINDOW),
                                 *P.DASHBOARD_WINDOW)
    assert _rows(spark.table("cli_pivot")) == _rows(want)


def test_day_partitioned_hits_prune_partitions(spark, inputs_small, stored_inputs):
    from cohortline.sources.tables import catalog_inputs
    from tests.test_plans import formatted

    spark.sql("DROP TABLE IF EXISTS src_hits_by_day")
    (inputs_small.hits.withColumn("day", F.to_date("date_time"))
     .write.partitionBy("day").format("parquet").saveAsTable("src_hits_by_day"))
    names = {t: f"src_{t}" for t in TABLES}
    names["hits"] = "src_hits_by_day"
    by_day = catalog_inputs(spark, hits_day_column="day", **names)
    df = R.purchases_by_custom_channel(by_day, *P.DAILY_WINDOW)
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(day" in text and "2024-01-17" in text
    assert _rows(df) == _rows(R.purchases_by_custom_channel(stored_inputs, *P.DAILY_WINDOW))
    assert _rows(R.policy_orders(by_day, *P.DAILY_WINDOW)) == \
        _rows(R.policy_orders(stored_inputs, *P.DAILY_WINDOW))


def test_cli_report_command(spark, stored_inputs, capsys):
    from cohortline import cli

    spec = ",".join(f"{t}=src_{t}" for t in TABLES)
    spark.sql("DROP TABLE IF EXISTS cli_recon")
    assert cli.main(["report", "reconcile", "--tables", spec, "--out-table", "cli_recon",
                     "--start", P.PURCHASE_WINDOW[0].isoformat(),
                     "--end", P.PURCHASE_WINDOW[1].isoformat()]) == 0
    assert _rows(spark.table("cli_recon")) == _rows(R.reconciliation(stored_inputs, *P.PURCHASE_WINDOW))
    assert cli.main(["report", "retention_weekly", "--tables", spec,
                     "--start", P.RETENTION_START.isoformat(), "--today", P.WEEKLY_TODAY.isoformat()]) == 0
    out = capsys.readouterr().out
    assert "purchase_week" in out and "renewal_rate" in out


def test_conform_matches_names_and_widens_types(spark):
    feed = spark.sql("""select 7 as ChannelID, 'direct' as Channel_Name, 1 as other""")
    got = schemas.conform(feed, schemas.MARKETING_CHANNEL, "m")
    assert got.dtypes == [("channel_id", "bigint"), ("channel_name", "string")]
    assert got.first() == (7, "direct")
    named = schemas.conform(feed.withColumnRenamed("ChannelID", "key"), schemas.MARKETING_CHANNEL, "m",
                            names={"channel_id": "key"})
    assert named.first() == (7, "direct")
    with pytest.raises(TypeError):  # would lose digits
        schemas.conform(spark.sql("select 1.5 as channel_id, 'x' as channel_name"), schemas.MARKETING_CHANNEL, "m")


def test_upstream_column_names_and_missing_hit_id(spark, inputs_small, stored_inputs):
    """Feeds with their own spelling, a plain timestamp and no hit id."""
    spark.sql("DROP TABLE IF EXISTS src_hits_up")
    up = inputs_small.hits.drop("event_id").withColumn("date_time", F.col("date_time").cast("timestamp"))
    up = up.withColumnRenamed("evar7", "eVar7").withColumnRenamed("post_evar61", "post_eVar61")
    up.write.saveAsTable("src_hits_up")
    spark.sql("DROP TABLE IF EXISTS src_policies_up")
    inputs_small.policies.toDF("SourceProduct", "PolicyIdentifier", "ProductSubtype", *inputs_small.policies.columns[3:]
                               ).write.saveAsTable("src_policies_up")
    names = {t: f"src_{t}" for t in TABLES} | {"hits": "src_hits_up", "policies": "src_policies_up"}
    i = catalog_inputs(spark, **names)
    assert _rows(R.reconciliation(i, *P.PURCHASE_WINDOW)) == _rows(R.reconciliation(inputs_small, *P.PURCHASE_WINDOW))


def test_cli_prunes_hit_days_and_rejects_unknown_names(spark, stored_inputs, monkeypatch):
    from cohortline import cli
    from tests.test_plans import formatted

    spark.sql("DROP TABLE IF EXISTS src_hits_days")
    (stored_inputs.hits.withColumn("day", F.to_date("date_time"))
     .write.partitionBy("day").format("parquet").saveAsTable("src_hits_days"))
    spec = ",".join(f"{t}=src_{t}" for t in TABLES if t != "hits") + ",hits=src_hits_days,hits_day_column=day"
    seen = []
    monkeypatch.setattr(cli, "full_refresh", lambda df, table: seen.append(formatted(df)))
    assert cli.main(["report", "purchases_custom", "--tables", spec, "--out-table", "x",
                     "--start", "2024-01-10", "--end", "2024-01-12"]) == 0
    assert "PartitionFilters: [isnotnull(day" in seen[0]
    with pytest.raises(SystemExit):
        cli.main(["report", "reconcile", "--tables", spec + ",hitz=x"])


def test_policy_ids_are_kept_whole_if_asked_and_cut_as_upstream_by_default(spark):
    from cohortline.functions.keys import bare_policy_id

    long = "MOT" + "7" * 116
    rows = spark.createDataFrame([("CAR", long + "1"), ("CAR", long + "2")], "p string, i string")
    got = {r[0] for r in rows.select(bare_policy_id("p", "i", length=None)).collect()}
    assert got == {long[3:] + "1", long[3:] + "2"}
    assert {r[0] for r in rows.select(bare_policy_id("p", "i")).collect()} == {"7" * 100}


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from cohortline.session import checkpoint_dir

    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=context))
