"""Session helpers.

Library code never creates its own cluster settings: it reads what the session
already has.  ``local_session`` is for tests, benches and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock, AQE for runtime re-planning
# (partition coalescing, skew-join splitting), Arrow for the few pandas UDFs.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "topicloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOPICLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tl-wh-"))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cutting lineage.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem).  Only a local master may leave it unset -- tests and local runs --
    and gets a scratch folder; on a cluster that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tl-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``topicloom`` importable by Python workers (pandas UDFs, mapInPandas).

    Equivalent to ``spark-submit --py-files topicloom.zip``: the package is
    zipped once per application on the driver and registered with
    ``SparkContext.addPyFile``; Spark ships it to every executor."""
    import os
    import shutil

    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        base = tempfile.mkdtemp(prefix="tl-pyfiles-")
        archive = shutil.make_archive(os.path.join(base, "topicloom"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="topicloom")
        sc.addPyFile(archive)
        _SHIPPED.add(key)
