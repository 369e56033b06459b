"""Session defaults and small session-level helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

GROUP_ROWS_CONF = "spark.wattline.maxGroupRows"
DEFAULT_GROUP_ROWS = 1_000_000


def build_session(app_name: str = "wattline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects.

    Partition counts are left to adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` and merges or splits by real sizes.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Wide projections above HotSpot's method limit would run interpreted;
        # below this size limit Spark splits them into methods it can compile.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def max_group_rows(spark: SparkSession) -> int:
    """Largest group one task may sort or hold; larger groups are split."""
    return int(spark.conf.get(GROUP_ROWS_CONF, str(DEFAULT_GROUP_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, for checkpoints and intermediate tables.

    It is ``spark.checkpoint.dir`` of the session. Only a local-mode session
    without one gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattline-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what ``materialize`` stored inside; for runs whose results are written elsewhere."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver itself found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Compute ``df`` once, as a parquet table in the shared folder; ``options`` are the writer's.

    Like a reliable checkpoint it cuts the lineage and survives lost executors;
    unlike one it keeps column pruning and filter push-down for its readers. Inside
    ``scratch`` the table goes when that ends, else when the folder is cleaned.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing reads them any more."""
    for table in tables:
        _delete(table.sparkSession, table.stored_at)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries now: it does so when the driver collects their plans, which
    may be long after a large stage if little else runs there."""
    spark._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
