"""Session defaults and the few session-level facts the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything a plan in this package depends on. Shuffle partitions are left to AQE: the
# initial number is generous and coalesced at run time to the advisory size, so one setting
# serves a laptop fixture and a 100 TB scan.
DEFAULTS = {
    # Window boundaries and month arithmetic are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Out-of-range casts are handled with try_cast where a contract can quarantine the row;
    # anything else should fail loudly.
    "spark.sql.ansi.enabled": "true",
    # Contracts put dozens of rules into one stage. Beyond 8000 bytes the JVM no longer
    # compiles a generated method to machine code, and smaller methods are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every Column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Keyed windows keep state per account: state must not have to fit the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package defaults; keyword arguments use `__` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results and plans depend on, on a session made by somebody else."""
    for key in (
        "spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit",
        "spark.sql.streaming.stateStore.providerClass",
    ):
        if spark.conf.get(key, None) != DEFAULTS[key]:
            spark.conf.set(key, DEFAULTS[key])
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables and stream checkpoints.

    On a cluster this lies in the shared folder named by `spark.checkpoint.dir`, so any
    executor can read what another one wrote. Where that is unset, a local session uses a
    temporary folder of this machine, and one on a cluster refuses.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="ledgerlens-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
