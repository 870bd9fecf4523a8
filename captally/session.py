"""Session helpers: a local session for tests and the checkpoint folder rule.

On a cluster the checkpoint folder must be shared storage named by the
cluster in ``spark.checkpoint.dir``; we only ever read it.  A machine-local
temporary folder is used solely when the session is a ``local[...]`` one and
nothing is configured (tests, local benches).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Rows per key above which a join key is treated as hot (see operators/skew.py).
HOT_KEY_ROWS_CONF = "captally.skew.hotKeyRows"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "captally") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The configured shared checkpoint folder, or None."""
    jsc = spark.sparkContext._jsc
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a scratch one only for local sessions."""
    found = checkpoint_dir(spark)
    if found:
        return found
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared checkpoint folder"
        )
    scratch = tempfile.mkdtemp(prefix="captally-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))
