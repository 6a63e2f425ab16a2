import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    spark = (SparkSession.builder.master("local[4]").appName("starmart-tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             # plans in full: late in a run longer column numbers had the filters of a scan cut off
             .config("spark.sql.maxMetadataStringLength", "1000")
             .config("spark.checkpoint.dir", ckpt)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def scratch(spark):
    from starmart.session import scratch_path

    return lambda name: scratch_path(spark, name)
