"""Result tables of a run that can go on after it was broken off.

Every finished table has a mark below ``_finished``: a fingerprint of what it was made
from, which are the files that were read, by name, size and time, the options that bear on
the table, and the fingerprints of the tables it derives from. A table with the mark it
should have is read instead of made. One without a mark is what a broken run left behind,
one with another mark was made from other inputs or options; either is made anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import delete, exists


def files_fingerprint(spark: SparkSession, paths: str | list[str]) -> str:
    """Of the files at ``paths``: one row from an aggregate over their names, sizes and
    times; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    row = files.agg(
        F.count(F.lit(1)),
        F.sum("length"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")),
        F.sum(F.xxhash64("modificationTime", "length", "path").cast("decimal(38,0)")),
    ).first()
    return fingerprint("files", [str(v) for v in row])


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


class Outputs:
    """The folder of a run's tables. Without ``resume`` a table that is there is an error."""

    def __init__(self, spark: SparkSession, root: str, resume: bool = False) -> None:
        self.spark, self.root, self.resume = spark, root.rstrip("/"), resume
        self.made: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _mark(self, name: str) -> str:
        return f"{self.root}/_finished/{name}"

    def finished(self, name: str, mark: str) -> bool:
        """Whether the table is there as ``mark`` says."""
        if not (self.resume and exists(self.spark, self._mark(name))):
            return False
        rows = self.spark.read.text(self._mark(name)).collect()
        return [r.value for r in rows] == [mark]

    def make(self, name: str, mark: str, write: Callable[[str], None]) -> None:
        """Have ``write`` write the table to a path, unless it is finished."""
        if self.finished(name, mark):
            return
        if self.resume:
            # The mark goes first: a table is never there in part with a mark.
            delete(self.spark, self._mark(name))
            delete(self.spark, self.path(name))
        write(self.path(name))
        marks = self.spark.createDataFrame([(mark,)], "value string").coalesce(1)
        marks.write.mode("overwrite").text(self._mark(name))
        self.made.append(name)

    def table(self, name: str, mark: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """The table, made from ``rows`` unless it is finished; read from its files."""
        self.make(name, mark, lambda path: rows().write.parquet(path))
        return self.spark.read.parquet(self.path(name))
