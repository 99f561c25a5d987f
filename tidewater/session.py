"""Session construction and the SQL settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the operators depend on. They are session-scoped and can
# be applied to a session someone else built (the driver's, a notebook's).
RUNTIME_CONF = {
    # All timestamps are UTC; naive ISO strings are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Duplicate attribute keys: the last one wins, like a Python dict.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

# Also for queries over messages, whose parse is one long stage: the JVM compiles no method of more
# bytes than this, so a longer generated stage would be interpreted; its operators get split code instead.
MESSAGE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Shuffle files go when their query has ended; else they stay until the driver happens to collect its garbage.
# For writes of whole tables, whose shuffles are as large as the tables.
TIDY_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def configure(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings, and ``more``, to an existing session (idempotent)."""
    for key, value in {**RUNTIME_CONF, **(more or {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Run a block under other SQL settings."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def get_session(master: str | None = None, app: str = "tidewater",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster, leave ``master`` unset so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names storage every executor can reach. It is
    read from the session. Where it is unset, a local master gets a private temp
    folder; on a cluster that would be a folder per machine, so it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: only the SQL conf is visible
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base and (sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to storage that every executor reaches")
    if not base:
        base = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    sub = f"{name or 'run'}-{uuid.uuid4().hex[:12]}"
    return os.path.join(base, sub) if "://" not in base else base.rstrip("/") + "/" + sub
