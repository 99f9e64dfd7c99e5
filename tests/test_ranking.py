"""Places of rows in an order: many ranges, ties, nulls, equal rows; no task sees all rows."""

import random

import pytest

from cohortline.operators.ranking import write_ordered
from cohortline.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.test_plans import formatted


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_places(spark, tmp_path, n):
    r = random.Random(4)
    rows = [(r.choice(["hot", "hot", None, "a", "é", "Z"]), r.choice([None, *range(300)]), f"t{r.randrange(50)}") for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v long, t string").repartition(7)
    joins = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are one range
    before = spark.conf.get(joins)
    spark.conf.set(joins, "false")
    try:
        got = write_ordered(df, f"file:{tmp_path}/o", ["k", "v"])
    finally:
        spark.conf.set(joins, before)
    assert got.columns == ["place", "k", "v", "t"]
    out = sorted(tuple(x) for x in got.collect())
    first = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    want = sorted(rows, key=lambda x: tuple(map(first, x)))
    assert out == [(p, *x) for p, x in enumerate(want)]
    if n > 1:
        assert len(spark.read.parquet(f"file:{tmp_path}/o").inputFiles()) > 1


def test_files_of_one_task_follow_one_another(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        got = write_ordered(spark.range(500).selectExpr("500 - id as id"), f"file:{tmp_path}/o", ["id"])
        assert sorted(map(tuple, got.collect())) == [(k, k + 1) for k in range(500)]
        assert len(got.inputFiles()) >= 50
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)


def test_ordered_report_has_no_stage_of_one_partition(spark):
    text = formatted(QUERIES["report_ordered"](spark, SF_SMALL))
    assert "SinglePartition" not in text and "Coalesce" not in text and "Window" not in text
