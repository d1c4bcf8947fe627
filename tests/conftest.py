import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tradewatch.session import configure

    warehouse = tempfile.mkdtemp(prefix="tw-warehouse-")
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("tradewatch-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tw-test-")
