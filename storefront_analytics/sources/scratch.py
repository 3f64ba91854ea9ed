"""Intermediate tables in the cluster's shared folder.

A frame that several later steps read is written once as Parquet and read
back. That cuts the lineage, survives the loss of executors and keeps column
pruning, none of which a block-manager cache gives.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"
INITIAL_PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_local_dirs: dict[str, str] = {}
_stored: dict[str, list[str]] = {}


class Stored:
    """A stored frame; ``rows`` is answered from the Parquet footers."""

    def __init__(self, frame: DataFrame):
        self.frame = frame

    @cached_property
    def rows(self) -> int:
        return self.frame.count()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; only a local session may go without."""
    folder = spark.conf.get(SHARED_DIR_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        path = tempfile.mkdtemp(prefix="storefront-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs[app] = path
    return "file://" + _local_dirs[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/storefront/{name}-{uuid.uuid4().hex}"


def store(frame: DataFrame, name: str) -> Stored:
    """Write ``frame`` to the shared folder and return what was written."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    frame.write.parquet(path)
    return Stored(spark.read.schema(frame.schema).parquet(path))


def store_in_buckets(frame: DataFrame, name: str, column: str) -> Stored:
    """As ``store``, in buckets of ``column``: joins on it move the other side only.

    As many buckets as a shuffle has partitions, so a frame that is shuffled by ``column`` fills each from one task.
    Buckets need a table; its name is dropped at once, what was read by it keeps them.
    """
    spark = frame.sparkSession
    path = new_folder(spark, name)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    buckets = spark.conf.get(INITIAL_PARTITIONS_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions")
    table = f"storefront_{uuid.uuid4().hex}"
    frame.write.bucketBy(int(buckets), column).saveAsTable(table, format="parquet", path=path)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return Stored(found)


def stored_so_far(spark: SparkSession) -> int:
    """How many tables this application has stored and not cleared."""
    return len(_stored.get(spark.sparkContext.applicationId, []))


def clear(spark: SparkSession, since: int = 0, last: bool = True) -> int:
    """Delete what this application has stored after the first ``since`` tables: frames that read it fail from then on.

    ``last`` false keeps the table that was stored last.
    """
    app = spark.sparkContext.applicationId
    paths = _stored.get(app, [])
    end = len(paths) if last else len(paths) - 1
    gone = paths[since:end]
    if app in _stored:
        _stored[app] = paths[:since] + paths[max(end, since) :]
    for path in gone:
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
    return len(gone)
