from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as a set of tuples, checked to be without repeats."""
    found = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    assert len(found) == len(set(found)), "a row came twice"
    return set(found)
