"""Runs of a growing dataset, published one at a time.

A dataset is a folder with tables ``<table>/run=<run>/…``, each run written by one job, and
``manifest/<version>.json``, the runs that count. A run writes its tables, which nobody
reads yet, and is then published: a manifest with one entry more is written beside and
renamed to the next version's name. The rename fails if that name is taken, so of two
jobs that publish at once one sees the other's version and decides again. Readers take
the latest manifest; a job killed at any moment leaves files that no manifest lists.

The manifest has one entry a run (its name, its key and its shards), whatever the size of
the tables.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..session import child_names


def new_run() -> str:
    return uuid.uuid4().hex


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path

    def run_path(self, table: str, run: str) -> str:
        return f"{self.path}/{table}/run={run}"

    def read(self, table: str, schema: str, entries: list[dict]) -> DataFrame:
        """A table of the given runs, as one scan, with the column ``run``."""
        if not entries:
            return self._spark.createDataFrame([], f"{schema}, run string")
        paths = [self.run_path(table, e["run"]) for e in entries]
        return self._spark.read.schema(f"{schema}, run string").option("basePath", f"{self.path}/{table}").parquet(*paths)

    def latest(self) -> tuple[int, list[dict]]:
        """``(version, entries)``; version 0 has none."""
        versions = [int(n[:-5]) for n in child_names(self._spark, f"{self.path}/manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not versions:
            return 0, []
        lines = self._spark.read.text(f"{self.path}/manifest/{max(versions):08d}.json", wholetext=True).first()[0]
        return max(versions), json.loads(lines)

    def publish(self, decide: Callable[[int, list[dict]], dict | None]) -> bool:
        """Add the entry that ``decide(version, entries)`` makes of the latest manifest, if any;
        asked again when another job was faster. False if there was none."""
        while True:
            version, entries = self.latest()
            entry = decide(version, entries)
            if entry is None:
                return False
            if self._create(version + 1, entries + [entry]):
                return True

    def _create(self, version: int, entries: list[dict]) -> bool:
        jvm, sc = self._spark.sparkContext._jvm, self._spark.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/{version:08d}.json")
        beside = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/.{version:08d}-{new_run()}")
        conf = sc._jsc.hadoopConfiguration()
        out = target.getFileSystem(conf).create(beside, False)
        out.write(json.dumps(entries).encode())
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        never_over = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        never_over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        try:
            files.rename(beside, target, never_over)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
                raise
            files.delete(beside, False)
            return False
        return True
