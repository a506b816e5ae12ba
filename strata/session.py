"""Session helpers and the shared working folder.

Every file a job writes (layer versions, landing files of the stand-in runs,
stream checkpoints, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``. That folder is on shared storage in a real cluster, so
a lost executor's work can be redone by any other one. Only when the setting is
missing (a laptop, a unit test) is a fresh local folder made and set.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


# Settings for a large cluster (about 100 TB of input): many initial shuffle
# partitions that AQE coalesces to ~256 MB each, so no reducer task holds more
# than it can sort in memory; skewed partitions split above 1 GB; 256 MB input
# splits; broadcast sides capped at 64 MB (every broadcast is also measured first,
# see operators.joins.sized).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


LOCAL_PARTITIONS = 8


def is_local(master: str) -> bool:
    """One machine (``local``, ``local[8]``): driver and tasks share every folder."""
    return master == "local" or master.startswith("local[")


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes.

    A master that is not one machine gets ``CLUSTER_CONF``; ``shuffle_partitions``
    overrides the number there (20,000) or on one machine (8). UI off, UTC session
    zone so text <-> timestamp is the same on every node.
    """
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(LOCAL_PARTITIONS),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if not is_local(master):
        conf |= CLUSTER_CONF
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in (conf | (extra or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Where it is unset, a fresh local folder is made and set on one machine; on a
    cluster that is an error, as executors would each write to a disk of their own.
    """
    root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.conf.get(_CHECKPOINT_KEY)
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            root = None
    if not root:
        master = spark.sparkContext.master
        if not is_local(master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root for one run of one job."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


# Spark's own switch: an action's shuffle files go when it ends, not when the driver's garbage is collected.
RELEASE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict[int, list] = {}         # session -> [blocks open in its threads, the setting before]
_lock = threading.Lock()


@contextmanager
def released(spark: SparkSession):
    """Shuffle files of every action inside the block are deleted when the action ends."""
    session = spark.sparkContext._jvm.System.identityHashCode(spark._jsparkSession)
    with _lock:
        state = _releasing.setdefault(session, [0, None])
        if state[0] == 0:
            state[1] = spark.conf.get(RELEASE_KEY, None)
            spark.conf.set(RELEASE_KEY, "true")
        state[0] += 1
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if state[0] == 0:
                del _releasing[session]
                spark.conf.unset(RELEASE_KEY) if state[1] is None else spark.conf.set(RELEASE_KEY, state[1])


_scopes = threading.local()


def temp_dir(spark: SparkSession, name: str) -> str:
    """As ``work_dir``, for data that only the current ``temporary`` block reads."""
    path = work_dir(spark, name)
    for made in getattr(_scopes, "open", [])[-1:]:
        made.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession):
    """Deletes every ``temp_dir`` this thread makes inside the block, also on failure, and the shuffle
    files of each action in it (``released``).

    The block must end with the write that consumes them. Outside of a block they
    stay, because a frame that is returned lazily still reads them.
    """
    made: list[str] = []
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append(made)
    try:
        with released(spark):
            yield
    finally:
        _scopes.open.remove(made)
        from strata.sources.layers import delete_path

        for path in made:
            delete_path(spark, path)
