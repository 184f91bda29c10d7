import gc
import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark(tmp_path_factory):
    """A session for each module, as one for all keeps what each plan, broadcast and shuffle leaves: of plans, jobs and stages only the
    last few are kept, and what is out of use is cleared every minute."""
    from pyspark.sql import SparkSession

    kept = {"spark.sql.ui.retainedExecutions": "5", "spark.ui.retainedJobs": "100", "spark.ui.retainedStages": "200", "spark.ui.retainedTasks": "2000", "spark.cleaner.periodicGC.interval": "1min"}
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), **kept}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    gc.collect()


@pytest.fixture(autouse=True)
def heap(request):
    """With MASKFRAME_HEAP, a file that gets the JVM's megabytes in use after each test."""
    yield
    if (to := os.environ.get("MASKFRAME_HEAP")) and "spark" in request.fixturenames:
        from pyspark import SparkContext

        if SparkContext._active_spark_context:
            jvm = SparkContext._active_spark_context._jvm
            jvm.System.gc()
            run = jvm.Runtime.getRuntime()
            with open(to, "a") as f:
                f.write(f"{(run.totalMemory() - run.freeMemory()) >> 20} {request.node.nodeid}\n")


@pytest.fixture(scope="session")
def data():
    return DATA
