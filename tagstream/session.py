"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def check_session(spark: SparkSession) -> None:
    """Parsing must not depend on a setting nobody sees, so it is refused where that is off."""
    if spark.conf.get(REPEATED_KEYS, "false").lower() != "true":
        raise ValueError(f"set {REPEATED_KEYS} to true, or call tagstream.configure(spark)")


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on.

    A repeated JSON key keeps its last value, and timestamps are stored in the
    Parquet type that has statistics, so that scans can skip expired entries.
    """
    spark.conf.set(REPEATED_KEYS, "true")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark hand this package to its Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="tagstream-")) / root.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", root.parent, root.name))
        _shipped.add(application)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the one the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine is used only where that setting is absent and the
    session is local, as in tests.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="tagstream-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
