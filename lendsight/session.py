"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folder of the running job below the scratch folder; tables of a job live and go with it.
_run_folder: list[str] = []

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(app_name: str) -> SparkSession:
    """Session for the jobs; a setting from spark-submit or the cluster's defaults wins over ours."""
    spark = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false").getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and
    executors share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lendsight-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    root = _run_folder[-1] if _run_folder else scratch_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs within; the ones before hold again at the end, also after an error."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """One scratch folder for what is stored within; it is removed at the end, also after an error.

    For jobs, whose results are written before the end. A DataFrame that reads
    a stored table must not leave the block.
    """
    folder = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    _run_folder.append(folder)
    try:
        yield folder
    finally:
        _run_folder.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    For results that several branches of one query read: they are computed
    once, the lineage is cut, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
