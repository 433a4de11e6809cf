"""Spark session defaults and lineage cutting.

Defaults are set only where the caller's session leaves them unset, so a
cluster's own settings (shuffle partitions, checkpoint folder) win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings this engine relies on; applied with ``setIfMissing`` semantics.
DEFAULT_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions (hot prefixes such as __bos__), turn a join into a
    # broadcast only after the measured size of a side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Text explodes ~25x into n-gram rows: keep input splits moderate.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Checkpoint files go when their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "corpusgrams",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session with the engine's defaults.

    ``master`` / ``shuffle_partitions`` are for local runs and tests; on a
    cluster pass neither and let the cluster configuration decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    The shared folder named by ``spark.checkpoint.dir`` is used as is.  Only a
    ``local[...]`` master (one machine) gets a temporary folder when none is
    configured; on a cluster a missing setting is an error, because executors
    cannot read each other's local files."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server's own setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="corpusgrams-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder (survives executor
    loss, unlike a local checkpoint) and return the re-read DataFrame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as compressed Parquet to the shared checkpoint folder and read back.

    For tables that grow with the corpus: a checkpoint holds every row
    uncompressed.  The files go when the driver ends."""
    spark = df.sparkSession
    path = _own_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, key: str, buckets: int, sort: str | None = None) -> DataFrame:
    """``stored`` as a table of ``buckets`` buckets of the column ``key``: what groups or joins
    it by that key does not move it.  ``df`` dealt out by ``repartition(buckets, key)``
    is written as a file a bucket, in the order of ``sort``."""
    spark = df.sparkSession
    path = _own_path(spark)
    name = os.path.basename(path).replace("-", "_")
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key)
    (writer.sortBy(sort) if sort else writer).saveAsTable(name)
    return spark.table(name)


def _own_path(spark: SparkSession) -> str:
    """A new folder name in the shared checkpoint folder, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    try:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # remote session: the folder is the server's
        jvm = None
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).deleteOnExit(folder)
    return path
