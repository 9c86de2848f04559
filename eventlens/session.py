"""Session factory (S17) and the shared working directory.

All settings the jobs depend on are set in code, by argument, so a
client-mode driver never silently falls back to cluster defaults.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension sides are broadcast only when the optimizer's size estimate
    # is below this bound; larger sides use a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # commit state as change logs; snapshots are uploaded in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_STATE = "spark.sql.streaming.stateStore"
#: State of a query whose backlog is one batch, where the session does not say
#: otherwise: off the heap, as all its groups are in it at once, and closed when
#: its task ends, so an executor holds only the stores at work.  Counting the
#: groups held would look up each one twice more.
LARGE_STATE = {
    f"{_STATE}.providerClass": DEFAULTS[f"{_STATE}.providerClass"],
    f"{_STATE}.unloadOnCommit": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "64",
    f"{_STATE}.rocksdb.writeBufferSizeMB": "4",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}
#: On a local disk a rename is one call in either manager; the default one
#: starts processes for every file.
LOCAL_FILES = {
    "spark.sql.streaming.checkpointFileManagerClass": (
        "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
    ),
}


@contextmanager
def large_state(spark: SparkSession, checkpoint_root: str):
    """Streaming queries started inside keep ``LARGE_STATE`` (a query copies the
    session's settings at its start; a checkpoint keeps the store it has)."""
    from . import storage

    fs, _ = storage._hadoop(spark, checkpoint_root)
    wanted = LARGE_STATE | (LOCAL_FILES if fs.getScheme() == "file" else {})
    missing = [k for k in wanted if spark.conf.get(k, None) is None]
    for key in missing:
        spark.conf.set(key, wanted[key])
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)


def build_session(
    master: str | None = None,
    app_name: str = "eventlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Pin the settings that results depend on (UTC event time) on an
    existing session, e.g. one created by a caller or test driver."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and job-owned tables.

    On a cluster ``spark.checkpoint.dir`` names storage every executor and
    the driver can reach; it is read, never replaced.  Next comes a folder
    already given to ``SparkContext.setCheckpointDir``.  Only when neither
    is set (a local test session) is a folder created, once per
    application, and registered as the context's checkpoint folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    app = sc.applicationId if sc is not None else "session"
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            f"master {master!r}: set spark.checkpoint.dir to a folder that the driver and all executors share"
        )
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="eventlens-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(_LOCAL_DIRS[app])
    return sc.getCheckpointDir() if sc is not None else _LOCAL_DIRS[app]


def work_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder for job-owned tables,
    stream checkpoints and fallback output."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([root, "eventlens", *tail])
