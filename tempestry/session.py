"""Session helper and the scratch folder shared by all executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from math import ceil
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

# Only settings that change results or plans; sizes of executors and shuffles
# are left to the cluster. ANSI mode stays on: bad text is handled by try_*.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

SHUFFLE_PARTITION_GB = 0.25


def shuffle_partitions(data_gb: float, most: int | None = None) -> int:
    """Partitions that keep a shuffle of ``data_gb`` near 256 MB each: 400,000 at 100 TB.

    Adaptive execution joins partitions that turn out small but splits only
    skewed ones, so the number should rather be too high. ``most`` limits it
    where a driver cannot keep books on so many; partitions then grow and spill.
    """
    wanted = max(200, ceil(data_gb / SHUFFLE_PARTITION_GB))
    return wanted if most is None else min(wanted, most)


def build_session(
    app: str = "tempestry",
    master: str | None = None,
    data_gb: float | None = None,
    output_mb: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots.

    ``output_mb`` is the size Spark aims at for coalesced partitions and, after
    a rebalance, for files; without it Spark's own 64 MB hold.
    """
    builder = SparkSession.builder.appName(app)
    if data_gb is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(data_gb)))
    if output_mb is not None:
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{output_mb}m")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def together(spark: SparkSession, *jobs: Callable[[], Result]) -> list[Result]:
    """Run independent jobs at the same time, up to 16, and return their results in order.

    The last tasks of one fill the executors together with the first of
    another, which matters where a table has few files. The first error is
    raised after all have ended.
    """
    with ThreadPoolExecutor(min(len(jobs), 16)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode with the setting unset:
    on a cluster the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or None
    if root is None:
        # A session that does not tell its master may be a remote one.
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "unknown")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tempestry-")
    return f"{root.rstrip('/')}/tempestry/{label}-{uuid.uuid4().hex}"
