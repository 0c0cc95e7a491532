import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfstream import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    spark = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield session.configure(spark)
    spark.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_all(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def at(text: str) -> dt.datetime:
    """A time of 1 January 2021, or of the day given before it."""
    text = text if "-" in text else f"2021-01-01 {text}"
    return dt.datetime.fromisoformat(text)


def rows(df):
    """Rows as sorted tuples, NULLs first."""
    return sorted(map(tuple, df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df, final: bool = True) -> str:
    """The physical plan, after running it so that adaptive changes show."""
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def sf_dir():
    """The smallest of the driver's tables."""
    return "/root/testdata/sf0.001"
