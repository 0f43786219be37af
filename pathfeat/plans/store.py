"""Cells of a corpus that grows: only files that were not read yet are read.

Counts per (path, a, b) add up, so a store holds the cells of every addition and a
manifest of the files they came from. An addition is written under a name of its own and
counts only once its files are in the manifest, which is the last thing written: what a
broken run leaves behind is never read, and its files are read again. A file that is
already in the manifest with another size or time is an error, as its old counts can't be
taken out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_arcs
from ..operators.paths import path_records
from ..operators.vocabulary import merge_cells, path_cells
from ..options import Options
from ..sources.text import read_lines
from .staging import exists

_MANIFEST = "path string, length bigint, modified timestamp, addition string"
_CELLS = "dp string, a string, b string, n bigint, addition string"


class CellStore:
    """A folder that all executors share, with ``manifest`` and ``cells``."""

    def __init__(self, spark: SparkSession, root: str, options: Options = Options()) -> None:
        self.spark, self.root, self.options = spark, root.rstrip("/"), options

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    @property
    def manifest(self) -> DataFrame:
        """``path, length, modified, addition`` of every file that was read."""
        return self._read("manifest", _MANIFEST)

    @property
    def cells(self) -> DataFrame:
        """``dp, a, b, n`` of all files in the manifest."""
        additions = self.manifest.select("addition").distinct()
        return merge_cells(self._read("cells", _CELLS).join(additions, "addition", "left_semi"))

    def unread(self, paths: str | list[str]) -> DataFrame:
        """Files at ``paths`` that the manifest lacks; their contents are not read."""
        files = self.spark.read.format("binaryFile").load(paths)
        files = files.select("path", "length", F.col("modificationTime").alias("modified"))
        known = self.manifest.select("path", F.col("length").alias("_l"), F.col("modified").alias("_m"))
        changed = files.join(known, "path").where((F.col("length") != F.col("_l")) | (F.col("modified") != F.col("_m")))
        row = changed.head()
        if row is not None:
            raise ValueError(f"{row.path} has changed since it was read")
        return files.join(known, "path", "left_anti")

    def add(self, paths: str | list[str], partitions: int | None = None) -> int:
        """Read the files that were not read yet; how many there were."""
        # One row per file, and names are what a read takes.
        files = self.unread(paths).collect()
        if not files:
            return 0
        addition = uuid.uuid4().hex
        lines = read_lines(self.spark, [f.path for f in files], partitions)
        records = path_records(parse_arcs(lines), self.options)
        cells = path_cells(records.select("dp", "a", "b"))
        cells.withColumn("addition", F.lit(addition)).write.partitionBy("addition").mode("append").parquet(f"{self.root}/cells")
        rows = [(f.path, f.length, f.modified, addition) for f in files]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("append").parquet(f"{self.root}/manifest")
        return len(files)
