"""Session construction and the checkpoint folder.

On a cluster the session is created by the platform; ``build_session`` is for
local runs (tests, bench). ``ensure_checkpoint_dir`` reads the folder the
cluster names in ``spark.checkpoint.dir`` and only invents one in local mode.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins and coalesces partitions
# from runtime sizes; skew-join splits hot keys. Timestamps stay in UTC so
# results agree with engines that treat them as zone-less.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "acctflow",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    # None for a Spark Connect session, which has no SparkContext.
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; a
    machine-local temp folder would not survive the loss of an executor.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it"
        )
    folder = tempfile.mkdtemp(prefix="acctflow-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()``, but computes the plan a single
    time (an eager reliable checkpoint runs it once to count and again to
    write), stores it compressed and columnar, and gives later joins real
    size statistics. The files live in the cluster's shared checkpoint folder,
    so they survive the loss of any executor. Remove them with ``release``.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/acctflow/{tag}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    out = spark.read.parquet(path)
    out._acctflow_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files behind a frame returned by ``materialize``."""
    path = getattr(df, "_acctflow_path", None)
    sc = _context(df.sparkSession)
    if path is None or sc is None:
        return  # without a JVM handle (Spark Connect) the files stay
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
