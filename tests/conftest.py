import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wayfield.session import configure
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
               .config("spark.sql.maxMetadataStringLength", "5000")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture()
def rows_of():
    def collect(df, *cols):
        return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
    return collect
