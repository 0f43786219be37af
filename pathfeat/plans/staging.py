"""Tables written once and read by several later steps."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"

_scope: ContextVar[Staging | None] = ContextVar("staging", default=None)


class Staging:
    """Where the tables staged inside ``with`` go, and which they are.

    ``root`` is a folder that all executors share; without one the session's is taken.
    ``close`` deletes the tables.
    """

    def __init__(self, root: str | None = None) -> None:
        self.root = root.rstrip("/") if root else None
        self._paths: list[tuple[SparkSession, str]] = []
        self._tables: list[tuple[SparkSession, str]] = []
        self._persisted: list[DataFrame] = []
        self._tokens: list = []

    def __enter__(self) -> Staging:
        self._tokens.append(_scope.set(self))
        return self

    def __exit__(self, *_) -> None:
        _scope.reset(self._tokens.pop())

    def add(self, spark: SparkSession, path: str) -> None:
        """Delete what is at ``path`` as well."""
        self._paths.append((spark, path))

    def keep(self, df: DataFrame) -> None:
        """Unpersist ``df`` as well."""
        self._persisted.append(df)

    def close(self) -> None:
        while self._tables:
            spark, name = self._tables.pop()
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        while self._paths:
            delete(*self._paths.pop())
        while self._persisted:
            self._persisted.pop().unpersist()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it, or a file, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="pathfeat-")


def staging_root(spark: SparkSession) -> str | None:
    """The folder of the enclosing ``Staging``, else the context's checkpoint folder, else
    the one the session's setting names; a temporary one in local mode only."""
    scope = _scope.get()
    if scope is not None and scope.root:
        return scope.root
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    return _local_root() if spark.sparkContext.master.startswith("local") else None


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and return the table.

    The written table cuts the lineage, survives lost executors, is read with
    column pruning, and its known size lets the planner decide on broadcasts. On a
    cluster that names no shared folder the rows are persisted on disk instead.
    ``schema`` gives types to read the columns back as, with the same storage form.
    """
    spark, scope = df.sparkSession, _scope.get()
    root = staging_root(spark)
    if root is None:
        if schema is not None:
            # JSON text is a storage form that both types share.
            df = df.select(F.from_json(F.to_json(F.struct("*")), schema).alias("_row")).select("_row.*")
        df = df.persist(StorageLevel.DISK_ONLY)
        if scope is not None:
            scope._persisted.append(df)
        return df
    path = f"{root}/pathfeat/{name}-{uuid.uuid4().hex}"
    if scope is not None:
        scope._paths.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def stage_by(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``stage``, with the rows dealt into ``buckets`` by a hash of ``keys``.

    Joins and groupings on the keys of tables with equal buckets read them without another
    shuffle. The rows are shuffled once, here, and every task writes one file. ``buckets``
    is the session's number of shuffle partitions unless said otherwise; it is how many tasks
    later steps have, so it should follow the size of the table.
    """
    spark, scope = df.sparkSession, _scope.get()
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, root = df.repartition(buckets, *keys), staging_root(spark)
    if root is None:
        dealt = dealt.persist(StorageLevel.DISK_ONLY)
        if scope is not None:
            scope._persisted.append(dealt)
        return dealt
    table = f"pathfeat_{name}_{uuid.uuid4().hex}"
    path = f"{root}/pathfeat/{name}-{uuid.uuid4().hex}"
    if scope is not None:
        scope._tables.append((spark, table))
        scope._paths.append((spark, path))
    dealt.write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)
