"""Session helpers: session construction for jobs/tests and the shared work folder.

Streaming outputs, checkpoints and written intermediate tables go below the
folder the cluster names in ``spark.checkpoint.dir`` (a shared file system on
a cluster). Only when it is unset (local tests) is a local folder created and
registered as the checkpoint dir. What a process writes there for its own use
is removed when the process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Settings of every session that this library makes; callers may override any.
SESSION_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",  # windows and zone-less texts are UTC
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoint files of materialised results are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_run_folders: dict[str, str] = {}


def create_session(app_name: str = "ledgerline", master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session with the library's settings; ``conf`` adds to or overrides them."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)  # Python tasks run the driver's interpreter
    own = {"spark.sql.shuffle.partitions": str(shuffle_partitions)}
    builder = SparkSession.builder.master(master).appName(app_name)
    session = builder.config(map=SESSION_SETTINGS | own | conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local-mode session without one
    (tests, local bench) gets a local folder; a cluster session must name a
    shared folder in spark.checkpoint.dir."""
    root = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster job needs a shared folder for "
                "outputs, checkpoints and intermediate tables"
            )
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path (not yet created) below this process's run folder in
    the shared root. The run folder goes when the process ends, so results that
    must outlive it belong elsewhere."""
    root = shared_root(spark)
    if root not in _run_folders:
        _run_folders[root] = f"{root}/ledgerline/run-{uuid.uuid4().hex[:12]}"
        atexit.register(remove_run_folder, root)
    return f"{_run_folders[root]}/{name}-{uuid.uuid4().hex[:12]}"


def remove_run_folder(root: str) -> None:
    """Remove what :func:`work_path` handed out below ``root``, on any file system that Arrow reaches."""
    from pyarrow import fs

    if folder := _run_folders.pop(root, None):
        with contextlib.suppress(OSError, ValueError):
            store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
            store.delete_dir(path)
