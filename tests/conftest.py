import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cdcstrata.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


LOG_SCHEMA = (
    "id bigint, service_request_id bigint, year int, report_type string, status string, op string, version string, "
    "created_at timestamp, updated_at timestamp, updated_ts timestamp, signed_at timestamp, author_id bigint, "
    "data string, signature string"
)


@pytest.fixture()
def log(spark):
    """Builds a report log from short dicts; anything not given has a default."""
    from datetime import datetime

    def build(*versions):
        rows = []
        for v in versions:
            day = datetime(2024, 1, v.get("day", 1))
            rows.append(
                (
                    v["id"],
                    v.get("request", 1),
                    v.get("year", 2024),
                    v.get("type", "quarter1"),
                    v.get("status", "signed"),
                    v.get("op", "r"),
                    "1",
                    day,
                    day,
                    day,
                    day,
                    7,
                    v.get("data"),
                    v.get("signature"),
                )
            )
        return spark.createDataFrame(rows, LOG_SCHEMA)

    return build
