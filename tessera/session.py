"""Spark session defaults shared by the library, the tests and the bench.

Everything here is ordinary Spark configuration: UTC session time (all
timestamp semantics in the toolkit are defined in UTC), adaptive query
execution with skew-join splitting, Arrow for the few pandas UDFs, and no
web UI.  On a cluster the session normally comes from the platform; these
helpers only fill in what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that are gone are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keyed streaming state (message upserts, debounce windows) lives in RocksDB, off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the toolkit defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on to an existing session, and make
    the package importable in the executors' Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # rows can hold long texts: Arrow batches are bounded by bytes, not only by rows
    if not spark.sparkContext.getConf().contains(ARROW_BYTES):
        spark.conf.set(ARROW_BYTES, "8m")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors once per SparkContext (``addPyFile`` of a zip),
    so UDFs and ``mapInArrow`` functions resolve wherever the driver was started from."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(root)
    fd, path = tempfile.mkstemp(prefix="tessera-code-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must already point at shared storage; we only invent a
    folder when the setting is missing, which happens in local tests.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
