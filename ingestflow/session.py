"""Spark session defaults and lineage cutting.

The engine never hard-codes a scratch folder: checkpoints go to the shared
folder the cluster names in ``spark.checkpoint.dir``.  Only tests and local
runs set that value themselves, and only when it is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small) and splits skewed shuffle
# partitions; the session zone is pinned so epoch-ms arithmetic is stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # State calls of Python stateful operators go through a socket file, not a port.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str | None = None, app: str = "ingestflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session; ``fallback`` is used
    only when it is unset (tests, local runs).  No machine-local default is
    ever invented here.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    chosen = conf_dir or fallback
    if not chosen:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for checkpoints")
    if not conf_dir:
        spark.conf.set("spark.checkpoint.dir", chosen)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(chosen)
    return chosen


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder; a local session without one gets a folder of its own.

    Anywhere else an unset ``spark.checkpoint.dir`` is an error: a folder of
    one machine would not be seen by the others.
    """
    local = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if local and not spark.conf.get("spark.checkpoint.dir", None):
        return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="ingestflow-"))
    return ensure_checkpoint_dir(spark)


def materialize(df: DataFrame, name: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Compute ``df`` once for several consumers: a Parquet table in the shared folder.

    One computation, durable across lost executors; plans built on the result
    start from the files.  (An eager ``checkpoint()`` would compute the rows
    twice: once for its count, once to write.)
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/ingestflow/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote and nothing reads any more."""
    spark = df.sparkSession
    for uri in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_session_for_tests(tmp_root: str, cpus: int | str = "*",
                            shuffle_partitions: int = 8,
                            extra: dict[str, str] | None = None) -> SparkSession:
    """Local session used by tests and the bench; sets a checkpoint folder only if unset."""
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=shuffle_partitions,
                          extra={"spark.driver.memory": "8g", **(extra or {})})
    ensure_checkpoint_dir(spark, os.path.join(tmp_root, "checkpoints"))
    return spark
