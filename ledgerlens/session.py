"""SparkSession construction and cluster-safe defaults.

Only settings a Spark user would normally set are touched here. The
checkpoint directory is read from the session; a private one is created
only when none is configured (local runs and tests).
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Launch-time settings (only take effect when this process starts the JVM).
LAUNCH_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # keep the driver's status store small: plans of many short queries pile up otherwise
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "50",
    "spark.ui.retainedStages": "50",
}

# Runtime SQL settings, applied only where the cluster/launcher did not set them.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Local (single-JVM) runs only: the driver JVM is the whole cluster there.
LOCAL_CONF = {"spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC"}

# Cluster runs: many shuffle partitions that AQE coalesces to ~256 MB each;
# partitions over 5x the median (and 512 MB) are split by AQE's skew-join
# handling. AQE only merges partitions, so their number before that follows
# the size of the input (``shuffle_partitions_for``).
LEAST_PARTITIONS = 8000
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": str(LEAST_PARTITIONS),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def shuffle_partitions_for(input_gb: float) -> int:
    """Shuffle partitions for so many GB of input: one a GB, so that a whole input that is shuffled once has reduce tasks of 1 GB at most."""
    return max(LEAST_PARTITIONS, math.ceil(input_gb))


def get_spark(
    app: str = "ledgerlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_gb: float | None = None,
) -> SparkSession:
    """Session with the defaults above; ``input_gb`` sizes the shuffles of a cluster run that names no number of partitions."""
    local = bool(master and master.startswith("local"))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    launch = dict(LAUNCH_CONF)
    if local:
        launch.update(LOCAL_CONF)
    for k, v in launch.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    runtime = dict(RUNTIME_CONF)
    if not local:
        runtime.update(CLUSTER_CONF)
        if input_gb:
            runtime["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_gb))
    if shuffle_partitions:
        runtime["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    runtime.update(extra_conf or {})
    launched = spark.sparkContext.getConf()
    for k, v in runtime.items():
        explicit = k in (extra_conf or {}) or (k == "spark.sql.shuffle.partitions" and shuffle_partitions)
        if explicit or not launched.contains(k):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is. Only an unconfigured (local/test) session gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint directory for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


# With this, a query's shuffle files are removed when it ends; else they stay until the driver collects garbage, half an hour or longer.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def set_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for the queries that run in here."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlens`` importable in Python workers (grouped-map functions live in it).

    Zips the package once per application and registers it with
    ``addPyFile``: Spark copies it to every executor, as ``--py-files`` does.
    """
    import zipfile

    import ledgerlens

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(ledgerlens.__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-pyfiles-"), "ledgerlens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
