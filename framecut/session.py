"""Session helpers: configuration for local runs and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files of DataFrames that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "framecut",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, cores: int, split_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on ``cores``
    executor cores: files split every ``split_mb``; one shuffle partition per
    GiB of input (the shuffled rows are narrower and pre-aggregated), between
    2 and 8 per core, which AQE coalesces where the data turns out smaller;
    skewed join partitions are split at run time.  Pass them to the session
    builder; ``spark.checkpoint.dir`` is left to the cluster."""
    per_gib = -(-input_bytes // (1 << 30))
    partitions = min(max(2 * cores, per_gib), 8 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is used as
    it is.  Only when nothing is set (a local test session) a folder in the
    warehouse is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    sc.setCheckpointDir(conf_dir or spark.conf.get("spark.sql.warehouse.dir") + "/framecut-checkpoints")
    return sc.getCheckpointDir()
