import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from retentia.session import apply_runtime_conf

    s = (
        SparkSession.builder.master("local[*]")
        .appName("retentia-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(s)
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        d = tempfile.mkdtemp(prefix="retentia-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)
