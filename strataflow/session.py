"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Jobs of one load that run beside each other: the next ones fill the cores that small or ending ones leave free.
JOBS_AT_ONCE = 4

# Settings that hold at any data size. Shuffle partition counts are left to the
# caller: see shuffle_partitions().
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# For stateful streams: state beyond executor memory lives in RocksDB, checkpointed as changes.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "strataflow", master: str | None = None, input_bytes: int | None = None, cores: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above. With the job's ``input_bytes`` and ``cores`` its shuffles are sized too."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores or 1)), **conf}
    for key, value in {**BASE_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partitions for a job that shuffles about ``input_bytes``.

    AQE merges partitions that turn out small but never adds any, so the start value has to be large
    enough for the biggest exchange: one partition per ``target_bytes`` and at least two per core.
    """
    return max(2 * cores, -(-input_bytes // target_bytes))


def pin_utc(spark: SparkSession) -> SparkSession:
    """Fix the session time zone, on which timestamp text and surrogate keys depend."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share for written intermediates.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session may fall back
    to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="strataflow-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, calls: Iterable[Callable[[], Any]], most: int = JOBS_AT_ONCE) -> list:
    """The results of independent calls, in their order, with up to ``most`` of them running. The first error in that order
    is raised when all have ended."""
    with ThreadPoolExecutor(most) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [r.result() for r in running]


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster the package is installed or given as --py-files; the path is then one that is not there.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
