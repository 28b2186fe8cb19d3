import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rankweave.session import RECOMMENDED_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    # Workers find modules in their folder and on PYTHONPATH. With neither, as on a cluster's executors, they cannot import
    # the package or the tests: whatever runs there has to travel by value.
    os.chdir(tmp_path_factory.mktemp("elsewhere"))
    os.environ["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not Path(p, "rankweave").exists())

    builder = SparkSession.builder.master("local[4]").appName("rankweave-tests")
    for key, value in {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": "/tmp/rankweave-warehouse",
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
