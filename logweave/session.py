"""Session helpers: defaults that matter for correctness and for scale."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Time zone pins the 5-minute bucket and the
# epoch seconds to UTC (contract Q6); AQE coalesces small shuffle partitions
# and splits skewed join partitions at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "logweave", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session for local runs and tests. The UI stays off."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.logweave.scan.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LOGWEAVE_DRIVER_MEMORY", "16g")))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    share_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver imported it from.

    Workers do not see the driver's ``sys.path``; without this they find the
    package only when it is installed or the job was started in its folder. On
    a cluster whose workers lack that folder, install or ship the package.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


_KEPT = "spark.logweave.kept."


def override(spark: SparkSession, key: str, value: str) -> None:
    """Change a setting for the query being built; ``apply_defaults`` puts the session's own value back."""
    now = spark.conf.get(key)
    if now != value:
        spark.conf.set(_KEPT + key, f"{value} instead of {now}")
        spark.conf.set(key, value)


def _restore(spark: SparkSession, key: str) -> None:
    kept = spark.conf.get(_KEPT + key, None)
    if kept is not None:
        value, before = kept.split(" instead of ", 1)
        if spark.conf.get(key) == value:  # otherwise it was set anew since
            spark.conf.set(key, before)
        spark.conf.unset(_KEPT + key)


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the settings on a session someone else built (e.g. the driver's)."""
    share_package(spark)
    _restore(spark, "spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked config: leave as is
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster's
    ``spark.checkpoint.dir``. Only a local-mode session (tests) falls back to a
    fresh scratch folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to shared storage on a cluster")
    local_dir = tempfile.mkdtemp(prefix="logweave-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for written intermediate tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as parquet under the checkpoint folder
    and reading it back (one computation, columnar, column pruning on re-read;
    zstd, as text takes half the disk it takes with the default).
    The folder is the cluster's shared ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
