"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings of a running session that the plans rely on. Run-time re-planning splits skewed
# joins and sizes partitions. The JVM never compiles a method above 8,000 bytes of bytecode;
# a wide table easily generates one, and it then runs several times slower than the
# same stage split into smaller methods.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot name even where its rows are grouped by the same key afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("fettle")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Call-site capture for error messages doubles the cost of building a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset, and only in a local session, as in tests, one is made for the
    session, below the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
