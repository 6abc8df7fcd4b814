"""Session settings the pipeline relies on.

* ``spark.sql.session.timeZone=UTC``: trip durations and calendar fields are
  computed from wall-clock timestamps; a zone with DST would shift them.
* ``partitionOverwriteMode=dynamic``: loading one month replaces only that
  month's partitions.
* ANSI mode stays on (Spark 4 default); guarded expressions avoid its errors.
* AQE with skew-join handling is the fallback for joins whose small side is
  too large to broadcast.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "tripstar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false")
    # checkpoint files of slices no longer referenced are removed by the
    # context cleaner instead of piling up in the shared folder
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in PIPELINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_pipeline_conf(spark)
    return spark


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in PIPELINE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise RuntimeError("the pipeline needs spark.sql.session.timeZone=UTC")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints: the one the cluster
    names in ``spark.checkpoint.dir``.

    Without the setting a job fails rather than write to a machine-local
    folder.  Only a session in one JVM (``local``, as in tests), where every
    task shares the driver's disk, sets one of its own, for its lifetime.
    """
    sc = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(staged tables and checkpoints are written there)")
        configured = tempfile.mkdtemp(prefix="tripstar-work-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared work folder."""
    base = work_dir(spark)
    leaf = "-".join([*parts, uuid.uuid4().hex[:12]]) if parts else uuid.uuid4().hex
    return f"{base}/tripstar/{leaf}"


def staged_table(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once in the shared folder and read back: later uses
    read files instead of computing the rows again, also after lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
