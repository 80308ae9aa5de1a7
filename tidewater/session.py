"""Session settings used by tests, the bench and stand-alone jobs."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on; a cluster may override any of them.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stored tables, named by the cluster.

    Where it is unset, a session of one machine takes a temporary folder; any other fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        application = spark.sparkContext.applicationId
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
        if application not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _LOCAL_ROOTS[application]
    return root.rstrip("/")
