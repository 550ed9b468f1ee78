"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. All of them are run-time SQL settings, so they
# can also be applied to a session someone else has built.
RUNTIME_CONF = {
    # Window boundaries are UTC instants; local time appears only in output text.
    "spark.sql.session.timeZone": "UTC",
    # Merge sessions inside each map task before the shuffle, so that a hot key
    # sends its sessions over the network and not its rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Window state grows with keys x open windows: keep it off the JVM heap and
    # upload only the changes of each micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "tidemill", conf: dict[str, str] | None = None
) -> SparkSession:
    """Build (or get) a session. Master, memory and parallelism are left to
    ``spark-submit`` unless ``conf`` names them."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.adaptive.enabled", "true")
    for name, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Stream checkpoints and intermediate tables must outlive any one machine, so
    on a cluster the setting is required. Only a local session falls back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemill-")
    return f"{base.rstrip('/')}/tidemill/{purpose}-{uuid.uuid4().hex}"
