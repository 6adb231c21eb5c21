import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", str(work)).config("spark.checkpoint.dir", f"file://{work}/checkpoint").config("spark.sql.warehouse.dir", f"{work}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
