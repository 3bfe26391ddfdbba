"""SparkSession helpers: settings the operators are designed around."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here carries.  AQE re-plans joins from measured sizes
# (broadcast only below ``autoBroadcastJoinThreshold``, otherwise sort-merge), splits
# skewed shuffle partitions, and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once the DataFrame that wrote them is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only for local runs and tests; on a cluster leave it ``None`` so the
    submitter decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None if unset)."""
    value = spark.sparkContext.getCheckpointDir()
    if value:
        return value
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``.  Only a local-mode session (tests)
    with the setting unset gets a fresh scratch folder; a cluster session without it is
    an error, because a machine-local folder would not survive a lost executor."""
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
    local = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet below the checkpoint folder and read from there.  Like
    ``checkpoint()`` it gives one copy that every later reader shares, but a reader takes only
    the columns that it names, where a checkpoint's whole rows are deserialised each time."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
