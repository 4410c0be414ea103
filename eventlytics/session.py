"""Session helpers: a configured local session for tests and benches, and
the shared scratch folder for checkpoints and written intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job here relies on. UTC keeps epoch <-> timestamp casts
# zone-free; AQE coalesces small shuffles and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "eventlytics", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("EVENTLYTICS_DRIVER_MEM", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the session's Python workers.

    Functions that run in Python workers are pickled by name, so workers
    import ``eventlytics``. A zip of the package is built once per
    SparkContext and added with ``addPyFile``, which the driver serves to
    every executor (as ``--py-files`` would). On a cluster the package is
    normally submitted with ``--py-files``; then nothing is built here.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    # already shipped by the submitter (spark-submit --py-files eventlytics.zip)
    if "eventlytics" in sc.getConf().get("spark.submit.pyFiles", ""):
        _SHIPPED.add(sc.applicationId)
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="eventlytics-pyfiles-"), "eventlytics.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name shared storage; without it this
    fails, as other executors could not read a local folder. Only on a local
    master (tests) a fresh local folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventlytics-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def child_names(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names of what a folder holds (or of what matches ``pattern`` below it,
    with slashes as far as the pattern has); empty if there is no folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    depth = pattern.count("/") + 1
    return ["/".join(f.getPath().toString().split("/")[-depth:]) for f in found or []]


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
