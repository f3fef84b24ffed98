import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartonwise.config import Rules, session_setup  # noqa: E402
from line_rows import APRIL, MAY, frame, spec_rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session_setup(session)


@pytest.fixture(scope="session")
def rules():
    return Rules()


@pytest.fixture(scope="session")
def spec(spark):
    return frame(spark, [*spec_rows(APRIL), *spec_rows(MAY)]).repartition(4).persist()
