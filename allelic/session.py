"""Session construction and shared scratch locations.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; it is only ever set here when the session left it
unset (local runs and tests), so cluster configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "allelic",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """A session.  Under spark-submit the cluster's settings stand; the local
    defaults (master, memory, partitions) are for plain Python runs."""
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC"))
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS", "8")
        b = (b.master(master or f"local[{cpus}]")
             .config("spark.driver.memory", os.environ.get("ALLELIC_DRIVER_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Tasks a core that list folders.
LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core.  Otherwise each folder is a
    task, up to 10,000 a job: where a file has a folder of its own, tasks cost
    more than what they list, and the driver keeps a record of each."""
    was = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(was), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, was)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder configured for checkpoints; a private temp dir when
    nothing is configured in local mode, an error on a cluster."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            root = None
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="allelic-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/allelic/{name}-{uuid.uuid4().hex[:12]}"
