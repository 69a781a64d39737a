import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SCHEMA = {
    "leg_id": "bigint",
    "flight_date": "date",
    "starting_airport": "string",
    "destination_airport": "string",
    "is_nonstop": "boolean",
    "base_fare": "decimal(18,2)",
    "seats_remaining": "int",
    "travel_duration": "string",
    "total_travel_distance": "int",
    "segments_airline_name": "string",
}


@pytest.fixture(scope="session")
def trips(spark):
    """Makes itineraries from dicts; columns left out are NULL, leg ids are numbered."""
    from skyfare.sources.itineraries import with_num_legs

    def make(rows):
        full = [
            tuple(row.get(c, i if c == "leg_id" else None) for c in SCHEMA)
            for i, row in enumerate(rows)
        ]
        text = ", ".join(f"{c} {'string' if t != 'bigint' else t}" for c, t in SCHEMA.items())
        as_text = [
            tuple(v if v is None or isinstance(v, int) and j == 0 else str(v)
                  for j, v in enumerate(row))
            for row in full
        ]
        df = spark.createDataFrame(as_text, text)
        typed = df.selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in SCHEMA.items()])
        return with_num_legs(typed)

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
