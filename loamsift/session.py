"""Session settings and scratch tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single machines; on a cluster use the one it gives."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
    }
    return SparkSession.builder.master(master).config(map=settings | conf).getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:  # only without a cluster, as in tests
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{base.rstrip('/')}/loamsift-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: that of the default file system where it names none."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return uri if "://" in uri else uri.replace(":", "://", 1)


def make_dir(spark: SparkSession, path: str) -> None:
    """An empty folder, in any store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


#: Folders of scratch tables that are still there.
_scratch: set[str] = set()
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within go as each query ends: what they fed is in a written table."""
    before = spark.conf.get(_CLEAN_SHUFFLES, None)
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN_SHUFFLES) if before is None else spark.conf.set(_CLEAN_SHUFFLES, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write a Parquet table into the shared scratch folder and read it back. It stays until ``release`` or the end of the program."""
    path = scratch_dir(df.sparkSession)
    _scratch.add(path)
    with without_shuffle_files(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` gave and that no lazy DataFrame reads any more; others are left alone."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path in _scratch:
            _delete(t.sparkSession.sparkContext, path)


def _delete(context: SparkContext, path: str) -> None:
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    _scratch.discard(path)


@atexit.register
def _delete_all() -> None:
    if (context := SparkContext._active_spark_context) is not None:
        for path in list(_scratch):
            _delete(context, path)


#: Texts differ in length by orders of magnitude, so Arrow batches are bounded by bytes, in the JVM and in Python alike.
BATCH_BYTES = 6 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to BATCH_BYTES, unless the cluster's settings name a bound."""
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


#: Bytes of files for each core under which a table is dealt out anew: a small table is often one row group, which one task would read alone.
SMALL_PER_CORE = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt to all cores if its files are too small to fill them; larger tables are read where they lie, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < SMALL_PER_CORE * cores else df
