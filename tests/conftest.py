import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyspan-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_points(spark):
    """Point table from rows of coordinates, ids by position, over several partitions."""

    def make(rows, slices=3, dimension=None):
        from tallyspan import points_from_table

        schema = "point_id bigint, features array<double>"
        data = [(i, [float(x) for x in row]) for i, row in enumerate(rows)]
        rdd = spark.sparkContext.parallelize(data, slices)
        return points_from_table(spark.createDataFrame(rdd, schema), dimension=dimension)

    return make
