"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A staged table cuts the lineage: readers do not recompute it and it survives lost executors.
Being Parquet, it also gives later passes column pruning, and gives the planner a real size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, else a folder beside the tables of the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


class Workspace:
    """A private folder for staged tables.

    As a context manager it deletes them at the end of the block, otherwise when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/tripmill-{uuid.uuid4().hex}"
        context = spark.sparkContext
        self._folder = context._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = self._folder.getFileSystem(context._jsc.hadoopConfiguration())
        self._files.mkdirs(self._folder)
        self._files.deleteOnExit(self._folder)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_exception) -> None:
        self._files.delete(self._folder, True)

    def fresh_path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, table: DataFrame, name: str) -> DataFrame:
        """Write the table once and return a scan of the copy."""
        path = self.fresh_path(name)
        table.write.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)


_WORKSPACES: dict[str, Workspace] = {}


def workspace(spark: SparkSession) -> Workspace:
    """The application's workspace, for tables that lazy results still read."""
    app = spark.sparkContext.applicationId
    if app not in _WORKSPACES:
        _WORKSPACES[app] = Workspace(spark)
    return _WORKSPACES[app]
