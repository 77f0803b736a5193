"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

#: The JVM only interprets methods beyond this size; Spark then generates smaller ones, operator by operator.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", 8000

# Settings the jobs are written for. On a cluster pass the same ones to
# spark-submit, and size spark.sql.shuffle.partitions to the data: adaptive
# execution merges partitions, but adds none to an exchange that groups by key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    STATE_STORE: (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "tellerbook", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    partitions = "8" if cores == "*" else str(cores)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": partitions,
        "spark.driver.memory": "8g",
    }
    for name, value in (settings | extra).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def limit_methods(spark: SparkSession) -> None:
    """Keep generated code to methods that the JVM compiles; a lower limit stays."""
    name, most = METHOD_LIMIT
    if int(spark.conf.get(name)) > most:
        spark.conf.set(name, str(most))


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, for tables that cut lineage.

    It lies under ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix=f"tellerbook-{purpose}-")
    return f"{shared.rstrip('/')}/tellerbook-{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, wherever it is installed.

    Once per application; a cluster that has the package already loses nothing.
    """
    name = "tellerbook-package.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tellerbook-")) / name
    with zipfile.ZipFile(path, "w") as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
