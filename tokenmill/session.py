"""Session helpers: a local session for tests/bench, and lineage cutting.

On a cluster the session comes from the caller; nothing here overrides
settings that are already present.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .validation import require


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tokenmill") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TOKENMILL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Uses ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only a local master may go without: there a fresh scratch
    folder is created and registered. A cluster without the setting is an
    error, because executors do not share a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        require(sc.master.startswith("local[") or sc.master == "local",
                "set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tokenmill-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _filesystem(spark: SparkSession, path: str):
    """(Hadoop filesystem, Hadoop path) of ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _filesystem(spark, path)
    return fs.exists(hadoop)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none if it does not exist."""
    fs, hadoop = _filesystem(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if it does not exist."""
    fs, hadoop = _filesystem(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(hadoop) if x.isDirectory()) if fs.exists(hadoop) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, hadoop = _filesystem(spark, path)
    fs.create(hadoop).close()


def move_file(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file; its new folder is made if it is missing."""
    fs, hadoop = _filesystem(spark, target)
    fs.mkdirs(hadoop.getParent())
    fs.rename(_filesystem(spark, path)[1], hadoop)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's JVM ends."""
    fs, hadoop = _filesystem(spark, path)
    fs.deleteOnExit(hadoop)


class Written:
    """A table written once to the shared folder; ``drop()`` deletes its files."""

    def __init__(self, df: DataFrame, tag: str):
        self._spark = df.sparkSession
        self.path = f"{checkpoint_dir(self._spark)}/{tag}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        delete_on_exit(self._spark, self.path)
        self._schema = df.schema
        self.df = self.read()

    def read(self) -> DataFrame:
        """The table as a frame of its own, for joins with itself."""
        return self._spark.read.schema(self._schema).parquet(self.path)

    def drop(self) -> None:
        fs, hadoop = _filesystem(self._spark, self.path)
        fs.delete(hadoop, True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage without recomputation, survives lost executors, and gives
    the planner the real size of the table for its broadcast decisions. The
    folder goes when the driver's JVM ends.
    """
    return Written(df, tag).df
