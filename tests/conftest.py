import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
EVENT_DIR = tempfile.mkdtemp(prefix="tracery-events-")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tracery.session import apply_runtime_conf, ensure_checkpoint_dir

    session = (
        SparkSession.builder.master("local[*]")
        .appName("tracery-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # The session's own event log feeds the real-log test.
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", EVENT_DIR)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(session)
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def event_dir():
    return EVENT_DIR
