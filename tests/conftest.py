import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratalake.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config(map=SETTINGS)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def plan_of(spark):
    """Physical plan of a DataFrame as text."""

    def text(df, executed=False):
        if executed:
            df.write.format("noop").mode("overwrite").save()
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
