"""Session and shared-storage helpers used by every package."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain, count
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Folders of the working tables that are still there.
_WRITTEN: WeakKeyDictionary = WeakKeyDictionary()


def local_session(cores: int | str = 8, app: str = "loomtext", **conf: str) -> SparkSession:
    """A local session with adaptive execution, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of our own when it is unset.

    Our own is a temporary folder in local mode, where there is one machine only, and lies in the warehouse on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        alone = re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master)
        own = tempfile.mkdtemp(prefix="loomtext-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/loomtext-working"
        spark.sparkContext.setCheckpointDir(own)
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> Iterator[None]:
    """Inside, what is written has Arrow batches of bounded rows and bytes; the session's own settings come back at the end."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df once as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors.

    The folder is removed by `discard`, or when the file system closes at the end of the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomtext-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release_on_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def written(df: DataFrame, label: str) -> DataFrame:
    """df if it is a working table already, else df written as one."""
    return df if df in _WRITTEN else materialise(df, label)


def materialise_small(df: DataFrame, label: str) -> DataFrame:
    """materialise, with small Arrow batches: for tables of long texts."""
    with small_batches(df.sparkSession):
        return materialise(df, label)


def discard(*tables: DataFrame) -> None:
    """Deletes working tables that materialise wrote, once nothing reads them any more; others are left alone."""
    for df in tables:
        path = _WRITTEN.pop(df, None)
        if path is not None:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def fresh(stem: str, *taken: Iterable[str]) -> str:
    """A column name that begins with stem and is in none of the lists of names, whatever the case."""
    used = {name.lower() for names in taken for name in names}
    return next(name for name in chain([stem], (f"{stem}{i}" for i in count(1))) if name.lower() not in used)


def release_on_exit(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
