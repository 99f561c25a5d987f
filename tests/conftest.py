import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session
    s = get_session("local[4]", app="tidewater-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


INGEST = "2025-01-01 00:00:00"


@pytest.fixture(scope="session")
def bronze(spark):
    """Build bronze messages from (topic, value) pairs."""
    from pyspark.sql import functions as F

    def make(rows):
        data = [(t, 0, i, None, v) for i, (t, v) in enumerate(rows)]
        df = spark.createDataFrame(
            data, "topic STRING, `partition` INT, `offset` BIGINT, key STRING, value STRING")
        return df.withColumn("ingest_ts", F.lit(INGEST).cast("timestamp"))
    return make
