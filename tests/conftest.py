import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def house(spark):
    """1,500 housing rows derived from orders, with every defect planted."""
    from checks.housing import housing

    df = housing(spark, DATA).repartition(4, "id").persist()
    df.count()
    return df


@pytest.fixture(scope="session")
def sides(house):
    from holdfast.operators.split import split_train_test

    train, test = split_train_test(house, ["id"])
    return train.persist(), test.persist()


@pytest.fixture
def frame(spark):
    """A small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def plan():
    """The physical plan as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


def close(a, b, tolerance=1e-9):
    return abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))


def col(df, name):
    return [r[0] for r in df.select(F.col(f"`{name}`")).collect()]
