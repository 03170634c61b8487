"""Session helpers: building a session for tests/bench and locating the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on; AQE is what turns a join into a
# broadcast only after the build side's real size is known, and what
# splits skewed shuffle partitions.
_RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "retentia") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Idempotently apply the runtime settings to an existing session."""
    for k, v in _RUNTIME_CONF.items():
        spark.conf.set(k, v)


SHUFFLE_ROWS = 250_000  # of the largest table, a shuffle partition


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that a table of so many rows is dealt to: at least the cores, and more as it grows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // SHUFFLE_ROWS))


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Raises the shuffle partition count with the data, so that a task's sorts and aggregations hold no more at any size; small
    shuffles are coalesced at run time, and a larger setting stays."""
    need = -(-rows // SHUFFLE_ROWS)
    if need > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", need)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for materialised intermediates.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir);
    only when neither is set (local tests) a private temp folder is created
    and registered, so that later calls agree on it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="retentia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder (never reused across runs)."""
    base = shared_dir(spark)
    return f"{base}/retentia/{name}-{uuid.uuid4().hex[:12]}"


def ship_by_value(*modules) -> None:
    """Pickle functions of these modules by value, so Python workers that do
    not have this package installed can run them (mapInPandas / pandas UDFs)."""
    from pyspark import cloudpickle

    for m in modules:
        try:
            cloudpickle.register_pickle_by_value(m)
        except ValueError:  # already registered
            pass


def session_key(spark: SparkSession) -> int:
    """Identity of a session for per-session caches."""
    j = getattr(spark, "_jsparkSession", None)
    return id(j) if j is not None else id(spark)
