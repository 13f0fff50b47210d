"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "*", app: str = "millrace") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster has to name one,
    because a folder of one machine is lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir()


_scopes: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of the shared one for all that is materialized meanwhile; it goes away at the end.

    Tables read from it must not be used afterwards: write or collect them inside.
    """
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write the table once to the shared folder and read it back: later passes prune and push down
    into it, and a lost executor re-reads files instead of replaying the whole lineage."""
    spark = df.sparkSession
    path = f"{_scopes[-1] if _scopes else shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` builds, written once; all that is materialized while it is built is deleted."""
    path = f"{_scopes[-1] if _scopes else shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    with scratch(spark):
        made = make()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)
