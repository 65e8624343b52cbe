"""Session construction and the shared checkpoint folder.

On a cluster the operator of the job names a shared, fault-tolerant folder
in ``spark.checkpoint.dir``; everything this library materialises (CSV
exports, stream sinks and checkpoints, lineage cuts) lives below it. Only
when the setting is absent (local tests) is a private scratch folder made.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults for local runs. On a cluster the submitter's settings win
# because getOrCreate() reuses the running session.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete reliable RDD checkpoints (surrogate keys) once they are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_fallback_roots: dict[str, str] = {}   # by application id


def get_session(master: str | None = None, app: str = "bazaarlens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised data.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset on a
    ``local[...]`` master (tests, a laptop) one private scratch folder per
    SparkContext is made and registered with ``setCheckpointDir`` so that
    ``DataFrame.checkpoint()`` works too; on a cluster it must be set.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared, fault-tolerant "
                               "folder for materialised tables and stream checkpoints")
        key = sc.applicationId
        root = _fallback_roots.get(key)
        if root is None:
            root = tempfile.mkdtemp(prefix="bazaarlens-")
            _fallback_roots[key] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
