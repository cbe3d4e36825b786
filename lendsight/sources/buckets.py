"""Tables stored in buckets of a key, so that joins and windows on that key need no shuffle.

Features, panel and labels are all read by credit. Stored with one hash layout
they meet bucket by bucket: Spark reads a bucket of either side in one task.
Buckets are written by one shuffle on the key, the last that the table needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendsight.session import scratch_path
from lendsight.sources import folders

#: A join on the key and something more still uses the buckets of the key alone.
CO_LOCATED = "spark.sql.requireAllClusterKeysForCoPartition"


def bucket_count(spark: SparkSession) -> int:
    """One bucket per shuffle partition: whoever sizes those for a table of this kind sizes its buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_bucketed(df: DataFrame, path: str, name: str, key: str, order: str, buckets: int | None = None) -> DataFrame:
    """``df`` written below ``path`` in buckets of ``key``, sorted by ``key`` and ``order``, and read back as table ``name``.

    A bucket is one file, since each is made by one task. A key with very many
    rows makes a large bucket; credits have one row per period.
    """
    spark = df.sparkSession
    spark.conf.set(CO_LOCATED, "false")
    buckets = buckets or bucket_count(spark)
    laid_out = df.repartition(buckets, key)
    laid_out.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, order).saveAsTable(name)
    return spark.table(name)


def stored_once(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], key: str = "credit_id", order: str = "period"
) -> DataFrame:
    """The bucketed table ``name`` of the tables in ``folder``, built when it is first asked for in a session.

    The name in the catalogue carries the state of the folder (its files, their
    sizes and times) and the number of buckets, so that changed tables or
    settings lead to a new one.
    """
    content = f"{folder} {bucket_count(spark)} {folders.fingerprint(spark, folder)}"
    table = f"{name}_{hashlib.md5(content.encode()).hexdigest()}"
    spark.conf.set(CO_LOCATED, "false")
    if spark.catalog.tableExists(table):
        found = spark.table(table)
        files = found.inputFiles()
        if files and folders.exists(spark, files[0]):
            return found
        spark.sql(f"DROP TABLE {table}")
    return store_bucketed(build(), scratch_path(spark, name), table, key, order)
