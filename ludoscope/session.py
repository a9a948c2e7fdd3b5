"""Session settings, the shared folder, and cutting lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even if the rows must then be shuffled once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Has Spark delete a query's shuffle files once it has ended; otherwise they stay until the driver happens to collect its garbage.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "ludoscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **ADAPTIVE,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # One thread per task in numpy; tasks fill the cores already.
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """The settings the library counts on, set on a session somebody else has built."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session that names none gets a folder in its warehouse, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def drop_on_exit(spark: SparkSession, path: str) -> None:
    """Have Spark's file system delete an intermediate folder when the driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries planned and run in here leave no shuffle files: for steps that store their rows, so that nobody reads them again."""
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_END) if before is None else spark.conf.set(SHUFFLES_END, before)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored`` with the folder, for steps that ``delete`` it."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_end(df.sparkSession):
        df.write.parquet(path)
    drop_on_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the files: columns can be pruned when they are read.

    The files stay as long as the driver runs. They take a fraction of a checkpoint's room, whose rows are written as they are in memory.
    """
    return stored_at(df, name)[0]


def cut_lineage(df: DataFrame, keep_partitioning: bool = False) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the stored rows.

    Spark forgets how rows were placed when an adaptive plan is stored. ``keep_partitioning`` plans
    this one step without it, so later joins on the same keys do not move the rows again.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if not keep_partitioning:
        with shuffles_end(spark):
            # A plan made here, as each one knows from the start what becomes of its files.
            return df.select("*").checkpoint(eager=True)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with shuffles_end(spark):
            return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
