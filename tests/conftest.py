import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="tardy-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("tardy-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.session.timeZone", "Europe/Brussels")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from tardy.session import clear_scratch
    clear_scratch(s)


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tardy-t-")
