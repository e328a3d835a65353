"""Session helper and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "flowguard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; a machine-local folder is no use to
    executors on other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="flowguard-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"flowguard-{purpose}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set the checkpoint folder of the context when nothing has set it yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
