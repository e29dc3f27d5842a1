import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark():
    local = tempfile.mkdtemp(prefix="spark-")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.local.dir", local)
        .config("spark.sql.warehouse.dir", f"{local}/warehouse").config("spark.checkpoint.dir", f"{local}/shared").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    yield s
    s.stop()
