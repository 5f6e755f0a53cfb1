"""Session settings shared by the bench, the tests and stand-alone jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(
    app: str = "dockflow",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every job here wants; ``conf`` wins over them.

    AQE picks partition counts, splits skewed join partitions and turns a join into a
    broadcast only when the measured side is below ``autoBroadcastJoinThreshold``. Operators
    hint at a broadcast only for frames whose size does not depend on the data.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # latest-n limits work before the shuffle up to this n (a six-week sequence has 1008 rows)
        "spark.sql.optimizer.windowGroupLimitThreshold": "20000",
        # a site's packed sequence is some 100 KB, so Python batches hold fewer rows than usual
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session: the cluster's, or a temporary one on local masters."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="dockflow-ckpt-")
    context.setCheckpointDir(folder)
    return folder
