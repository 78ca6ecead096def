"""Session factory and shared-folder helpers.

Library code never stops a caller's session.  The scratch/checkpoint folder
is always read from ``spark.checkpoint.dir``; a local one is created only
when that setting is unset (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app_name: str = "catalogprep",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    When the setting is unset a private folder is created and registered, so
    ``DataFrame.checkpoint()`` works, but only in local mode; on a cluster each
    executor would write to its own disk, so that raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path:
        path = sc.getCheckpointDir()
    if not path and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="catalogprep-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a session may refuse core confs at run time
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", base):
        os.makedirs(base, exist_ok=True)
    return f"{base}{sep}catalogprep-scratch/{name}-{uuid.uuid4().hex}"
