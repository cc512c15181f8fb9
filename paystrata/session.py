"""Session settings, shared checkpoint folder and materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "paystrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests, benches and local runs; a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that survives the loss of an executor: ``spark.checkpoint.dir``.

    Only a local master may go without the setting (tests, benches); a cluster
    run that lacks it is refused, as a machine-local folder would not be
    visible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can read")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="paystrata-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_root(spark)}/paystrata/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor re-reads files instead of recomputing
    (and possibly re-sampling) what led to them. Parquet keeps column pruning
    and gives the optimizer a real size, which a checkpointed RDD does not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _file_system(spark, path)
    return store.exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    store, target = _file_system(spark, path)
    return [f.getPath().getName() for f in store.listStatus(target)] if store.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    store, target = _file_system(spark, path)
    store.delete(target, True)


def together(*actions: Callable[[], object]) -> list:
    """Results of actions that run at the same time, each with jobs of its own; raises the first error."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block, such as the start of a query."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``materialize`` for the length of a block: what was kept is removed at its end.

    For work that is written before the block ends, such as one micro-batch.
    """
    paths: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(scratch_path(spark, label))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            remove(spark, path)
