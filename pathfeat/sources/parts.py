"""One document from ordered part files, without a task that passes all of it.

The parts in name order are the document. ``part_list`` says at which byte of it each of
them starts, so that a reader can take any range; ``join_parts`` has the file system make
one file of them where it can, which moves no bytes.
"""

from __future__ import annotations

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import running_totals
from ..plans.staging import delete, exists


def part_list(spark: SparkSession, path: str) -> DataFrame:
    """``path, first, length`` of the parts below ``path`` that hold anything, ``first``
    being the byte of the document at which the part starts. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    parts = files.load(path).where("length > 0").select("path", "length")
    ended = running_totals(parts, ["path"], {"_end": "length"})
    return ended.select("path", (F.col("_end") - F.col("length")).alias("first"), "length")


def join_parts(spark: SparkSession, path: str, target: str) -> bool:
    """Make the parts below ``path`` one file at ``target``, if the file system joins files.

    The parts are gone then. Where it doesn't, nothing changes, and the answer is false:
    the list of parts is the document.
    """
    if exists(spark, target):
        raise ValueError(f"{target} is there already")
    # Names only, one a part; the file system takes them as one list.
    names = [r.path for r in part_list(spark, path).orderBy("first").select("path").collect()]
    jvm = spark._jvm
    end = jvm.org.apache.hadoop.fs.Path(target)
    system = end.getFileSystem(spark._jsc.hadoopConfiguration())
    sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(names))
    for i, name in enumerate(names):
        sources[i] = jvm.org.apache.hadoop.fs.Path(name)
    system.create(end).close()
    try:
        if names:
            system.concat(end, sources)
    except UnsupportedOperationException:
        delete(spark, target)
        return False
    return True
