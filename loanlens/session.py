"""Session helpers: building a session for tests/bench and the checkpoint dir."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


_LOCAL_FOLDERS: list[tempfile.TemporaryDirectory] = []
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's modules to the executors' Python workers, once per application.

    They need not have the driver's working folder or path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # the session reads the file again for new executors; held until the process ends, then removed
    folder = tempfile.TemporaryDirectory(prefix="loanlens-py-", ignore_cleanup_errors=True)
    _LOCAL_FOLDERS.append(folder)
    path = os.path.join(folder.name, "loanlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "loanlens", extra: dict | None = None) -> SparkSession:
    """Local session with the settings the queries are designed for.

    AQE re-plans joins and coalesces small shuffle partitions at run time; the
    UI stays off (no server).
    """
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the clean-table stage fuses ~17 long column expressions; a generated
        # method above the JVM's 8000-byte JIT limit would run interpreted, so
        # let Spark fall back to per-operator code for such stages instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Generated methods above this size are never compiled by the JVM, only interpreted.
_COMPILED_BYTES = 8000


def run_large_stages_compiled(spark: SparkSession) -> None:
    """Let stages with too large a generated method run per operator, in methods that the JVM compiles.

    The cleaning step is such a stage. A smaller limit that the session has stays.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) > _COMPILED_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(_COMPILED_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, bench) gets a
    fresh scratch folder of its own; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        # held until the process ends, then removed
        folder = tempfile.TemporaryDirectory(prefix="loanlens-ckpt-", ignore_cleanup_errors=True)
        _LOCAL_FOLDERS.append(folder)
        configured = folder.name
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
