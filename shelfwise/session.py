"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets: adaptive execution re-plans joins and
# partition counts from runtime sizes, skew splitting guards hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "shelfwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults."""
    builder = SparkSession.builder.appName(app_name)
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading it from the session.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that
    value always wins. Only when nothing is configured (local tests) is a
    private folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCOPE: ContextVar[list | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside the block are deleted at its end. Write or
    collect the results inside; a service that answers many calls uses one
    block for each, so the shared folder does not fill up."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        for path in _SCOPE.get():
            _delete(spark, path)
        _SCOPE.reset(token)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    The written table survives executor loss (never ``localCheckpoint``),
    is columnar and compressed (cheaper than a row checkpoint), and the
    read-back gets column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    if _SCOPE.get() is not None:
        _SCOPE.get().append(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}"


def drop_materialized(spark: SparkSession) -> None:
    """Delete this session's materialized tables (call when the DataFrames
    built on them are no longer needed, e.g. at the end of a job)."""
    _delete(spark, scratch_path(spark, ""))


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one written table, once what was made of it is written too."""
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)
