import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import configure
    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from tidemark.sources.lake import Lake
    return Lake(spark, tempfile.mkdtemp(prefix="tidemark-lake-"))
