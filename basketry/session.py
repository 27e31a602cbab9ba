"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "basketry", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        # Small local data would otherwise be coalesced into fewer tasks than there are cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Shuffles start with a partition for so many bytes of the source tables, and small partitions are merged up to so many bytes.
SOURCE_BYTES = 4 << 20
MERGED_BYTES = 16 << 20
INITIAL_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def scale_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Let the number of shuffle partitions grow with the source tables, so that a task's share, and with it its memory, stays the same
    and nothing spills. The number is never lowered; shuffles with fixed numbers of partitions are not touched."""
    wanted = source_bytes // SOURCE_BYTES + 1
    if wanted > int(spark.conf.get(INITIAL_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_KEY, wanted)
    merged = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(MERGED_KEY))
    if merged > MERGED_BYTES:
        spark.conf.set(MERGED_KEY, MERGED_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where every task runs on
    this machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="basketry-")
        spark.conf.set(CHECKPOINT_KEY, named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def source_state(spark: SparkSession, paths: list[str]) -> tuple:
    """What changes when a table is written anew: time, total size and number of files. Two calls a table, however many
    files it has."""
    found = []
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        size = system.getContentSummary(hadoop)
        found.append((path, system.getFileStatus(hadoop).getModificationTime(), size.getLength(), size.getFileCount()))
    return tuple(found)


@contextmanager
def shuffles_end_with_write(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted when the write is done, not when the driver happens to collect garbage: nobody reads
    them again, as later passes read the written table. Only writes belong inside, which plan anew each time."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)


def materialize(df: DataFrame, label: str = "table", split_by: str | None = None, kept: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: the table survives lost executors, and later passes read only the columns
    (and, with ``split_by``, only the partitions) they need instead of recomputing what led here. The
    path is added to ``kept``.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_end_with_write(df.sparkSession):
        (df.write if split_by is None else df.write.partitionBy(split_by)).parquet(path)
    if kept is not None:
        kept.append(path)
    elif _PASSING:
        _PASSING[-1].append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


# The tables written within each block of ``passing``, the innermost last.
_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables of ``materialize`` written inside are deleted at the end, but for those handed to what this gives, which belong to the block
    around. No plan that is still to run may read the others."""
    mine: list[str] = []
    stay: list[str] = []

    def stays(table: DataFrame) -> DataFrame:
        stay.append(table.scratch)
        return table

    _PASSING.append(mine)
    try:
        yield stays
    finally:
        _PASSING.remove(mine)
        for path in mine:
            if path not in stay:
                delete_path(spark, path)
            elif _PASSING:
                _PASSING[-1].append(path)


def let_go(table: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing reads any more."""
    delete_path(table.sparkSession, table.scratch)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class Buckets:
    """Tables of one owner in the shared folder, bucketed by the same keys, so that joins on them move no rows.

    The owner deletes a table when it is done with it, and all of them at the end. Nobody else knows their names.
    """

    def __init__(self, spark: SparkSession, keys: list[str], n: int):
        self.spark, self.keys, self.n = spark, keys, n
        self.tables: list[tuple[str, str, str, DataFrame]] = []

    def write(self, df: DataFrame, label: str, ordered: bool = True) -> DataFrame:
        """``df`` as a table; without ``ordered``, rows of a bucket are in no order."""
        path = scratch_path(self.spark, label)
        name = "".join(c if c.isalnum() else "_" for c in f"{label}_{uuid.uuid4().hex}")
        writer = df.repartition(self.n, *self.keys).write.format("parquet").bucketBy(self.n, *self.keys)
        writer = writer.sortBy(*self.keys) if ordered else writer
        with shuffles_end_with_write(self.spark):
            writer.option("path", path).saveAsTable(name)
        table = self.spark.table(name)
        self.tables.append((name, path, label, table))
        return table

    def _drop(self, chosen: list[tuple[str, str, str, DataFrame]]) -> None:
        for entry in chosen:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry[0]}")
            delete_path(self.spark, entry[1])
            self.tables.remove(entry)

    def discard(self, table: DataFrame) -> None:
        self._drop([t for t in self.tables if t[3] is table])

    def discard_older(self, label: str, newest: DataFrame) -> None:
        self._drop([t for t in self.tables if t[2] == label and t[3] is not newest])

    def discard_all(self) -> None:
        self._drop(list(self.tables))
