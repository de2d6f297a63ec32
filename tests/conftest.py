import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def table(spark):
    """Rows of text cells as a DataFrame in reading order; absent cells are blank."""
    from pyspark.sql import functions as F

    from provena.schemas import ORDER, strings

    def make(columns, *rows):
        data = [tuple(str(r.get(c, "")) for c in columns) for r in rows]
        df = spark.createDataFrame(data, strings(columns)) if data else spark.createDataFrame([], strings(columns))
        return df.coalesce(1).withColumn(ORDER, F.monotonically_increasing_id())

    return make
