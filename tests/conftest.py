import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cohortline.session import configure

    warehouse = tempfile.mkdtemp(prefix="cohortline-wh-")
    s = (SparkSession.builder.master("local[*]")
         .appName("cohortline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.warehouse.dir", warehouse)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs_small(spark):
    from cohortline.sources.tables import test_inputs
    return test_inputs(spark, SF_SMALL)
