"""Session settings and the one way in which the engine cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lodestrata")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes df as a compressed table to the cluster's shared checkpoint folder and reads it from there.

    The folder is the session's spark.checkpoint.dir. Only where that is unset (tests, the bench) a
    folder of this machine is taken. The table survives the loss of executors, later stages read only the
    columns they need, and the planner knows its size. The tables of a session go when it ends.
    """
    path = f"{_shared_folder(df)}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shared_folder(df: DataFrame) -> str:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lodestrata-checkpoint-"))
    folder = f"{context._jsc.sc().getCheckpointDir().get()}/tables"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, context, folder)
    return folder


_folders: set[str] = set()


def _remove(context, folder: str) -> None:
    try:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session has ended; its owner clears the folder
        pass


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
