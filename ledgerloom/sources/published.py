"""Folders whose content changes all at once.

Data is written below a folder of its own for each run; then one small file, the run's line in the
manifest, makes it current. Readers resolve the manifest first, so a run that fails midway changes
nothing for them, and one that succeeds changes everything it holds in one step. What is current is
kept by part (a report year, a month of cells): for each, the latest run that holds it.

One writer at a time per folder; any number of readers. Earlier runs stay until ``remove_old``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Row, SparkSession

MANIFEST_SCHEMA = "version long, run string, batch string, parts map<string, string>"


class Published:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, folder: str):
        """Spark's file system and path object for a folder, whatever store it is in."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, folder: str) -> bool:
        fs, path = self._place(folder)
        return fs.exists(path)

    def new_run(self) -> str:
        """Name of a run that nothing refers to yet; its data goes below ``folder``."""
        return uuid.uuid4().hex

    def folder(self, run: str) -> str:
        return f"{self.path}/runs/{run}"

    def entries(self) -> list[Row]:
        """Lines of the manifest, one per published run."""
        if not self._exists(f"{self.path}/manifest"):
            return []
        lines = self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").json(f"{self.path}/manifest")
        return lines.orderBy("version", "run").collect()

    def commit(self, run: str, parts: Mapping[str, str], batch: str | None = None) -> None:
        """Make a run current for ``parts``: part -> its place below the run's folder, '' for a part
        that is empty from now on. The line is one file in a folder of the run's name, and counts
        from the moment Spark moves that file into place."""
        version = max((e.version for e in self.entries()), default=0) + 1
        line = self.spark.createDataFrame([(version, run, batch, dict(parts))], MANIFEST_SCHEMA)
        line.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{run}")

    def current(self) -> dict[str, str]:
        """part -> folder with its data, without parts that are empty."""
        found: dict[str, str] = {}
        for entry in self.entries():
            for part, place in entry.parts.items():
                found[part] = f"{self.folder(entry.run)}/{place}" if place else ""
        return {part: folder for part, folder in found.items() if folder}

    def batches(self) -> set[str]:
        return {e.batch for e in self.entries() if e.batch is not None}

    def remove_old(self) -> list[str]:
        """Delete the data of published runs that are current for no part; returns their names.
        Their lines stay, so that batches are not applied twice. Call it when no reader of an
        earlier state is left. Folders of runs that were never published are not touched."""
        entries = self.entries()
        latest = {part: e.run for e in entries for part in e.parts}
        gone = [e.run for e in entries if e.run not in latest.values() and self._exists(self.folder(e.run))]
        for run in gone:
            fs, path = self._place(self.folder(run))
            fs.delete(path, True)
        return gone
