"""Session helpers for tests and the benchmark, and the shared working folder.

Library operators never create or configure a session; they take the
caller's.  ``local_session`` is only for tests and ``bench.py``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "fundlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # delete checkpoint files of materialized tables once they are unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Python call-site capture costs several JVM round trips per Column call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    extra = dict(extra or {})
    # keep the catalog's default folder out of the working directory
    extra.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fundlens-warehouse-"))
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediates, by one rule in every mode.

    ``spark.checkpoint.dir`` of the session (or the context's checkpoint dir),
    else a folder below ``spark.sql.warehouse.dir``, which the cluster shares too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    fallback = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session has no context
        return configured or fallback
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or configured or fallback)
    return sc.getCheckpointDir() or configured or fallback


def run_concurrently(
    spark: SparkSession, tasks: Mapping[str, Callable[[], T]], resolve_checkpoint: bool = True
) -> dict[str, T]:
    """Run independent eager steps (materializations, writes) as concurrent Spark jobs.

    Each callable runs in its own driver thread, inheriting the caller's job
    properties, so small jobs share the cluster instead of queueing.  With
    ``resolve_checkpoint`` the shared checkpoint folder is resolved once
    before the threads start.
    """
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    if resolve_checkpoint:
        checkpoint_root(spark)  # resolve the shared folder once, before the threads start
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {k: pool.submit(wrap(f)) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def _scratch_root(spark: SparkSession) -> str:
    try:
        owner = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - a Connect session has no context
        owner = "connect"
    return f"{checkpoint_root(spark).rstrip('/')}/fundlens/{owner}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path of this application below the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application materialized; call it when its results are consumed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


__all__ = ["checkpoint_root", "local_session", "release_scratch", "run_concurrently", "scratch_path"]
