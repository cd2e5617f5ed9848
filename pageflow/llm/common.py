"""What the operators share: table reading, files in the shared folder, Arrow columns as numpy arrays."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path

CHUNK_BYTES = 2 << 20
# Documents, or rows that stand for some, of which a table that is stored between steps has one file.
TASK_ROWS = 4_096
# Names and paths of the tables stored inside the innermost ``passing`` of this thread.
_PASSING: ContextVar[list[tuple[SparkSession, str, str]] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, a NULL counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to a new table in the shared folder and read back.

    Later steps read the files, so a lost executor costs a reread and not the work before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (tables := _PASSING.get()) is not None:
        tables.append((spark, name, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(*last: str):
    """Removes at its end the tables that are ``stored`` inside it, for which nothing that is returned may read them.

    Those with the names in ``last`` stay, or go with the ``passing`` around this one. Also a decorator of functions.
    """
    tables: list[tuple[SparkSession, str, str]] = []
    around = _PASSING.get()
    token = _PASSING.set(tables)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for spark, name, path in tables:
            if name not in last:
                remove(spark, path)
            elif around is not None:
                around.append((spark, name, path))


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table in whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def tasks_for(rows: int) -> int:
    """Tasks that write what follows from so many documents.

    For ``coalesce`` before ``stored``: with many shuffle partitions a small table would get a file from each of them, and every file
    costs its task more than the rows do; on a local file system Hadoop even starts a process for each, next to an executor's memory.
    Tables with more rows than partitions of this size keep their partitions.
    """
    return max(1, -(-rows // TASK_ROWS))


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps, which it does when the driver collects its garbage.

    The driver gives memory back then, too. Loops of many small jobs call this in each turn: what these leave in the driver
    is little, but its heap grows by their garbage, a task for each partition, until it is collected whole. What native code of
    the JVM has freed stays with the process besides, some hundred MB after a few hundred jobs, until it is trimmed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()
    trimmed(spark)


def trimmed(spark: SparkSession) -> bool:
    """Lets the driver's JVM give freed native memory back, by its command System.trim_native_heap; False where it has none."""
    jvm = spark.sparkContext._jvm
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    # By the interface, since the server's own class is closed to callers.
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        call.invoke(server, given)
    except Py4JJavaError:  # another C library, or an older JVM
        return False
    return True


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def plain_files(docs: DataFrame) -> bool:
    """Whether the rows are those of Parquet files as they lie there, each file read once.

    A row's file and its place in it (``_metadata``) then tell it from all others, at every reading.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    found = plan.relation()
    if found.fileFormat().getClass().getSimpleName() != "ParquetFileFormat" or found.location().getClass().getSimpleName() != "InMemoryFileIndex":
        return False
    return found.location().allFiles().size() == len(set(docs.inputFiles()))


def unused(taken, stem: str) -> str:
    """A column name that is not taken."""
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and the offsets of its texts; NULL is empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).view(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``limit`` bytes, a longer text being a part of its own."""
    _, ends = bytes_of(batch.column(text))
    start = 0
    while start < len(ends) - 1:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def digest_of(text: str | Column) -> Column:
    return F.unhex(F.md5(text_of(text)))


def print_of(text: str | Column) -> Column:
    return F.xxhash64(text_of(text))


def decided(
    docs: DataFrame,
    decisions: DataFrame,
    how: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: str = "_digest",
) -> DataFrame:
    """The rows of ``docs`` joined with the decision on their id and text, in the manner of ``how``.

    ``decisions`` has ``_id`` and, as ``key``, ``_digest`` or ``_print`` of the text. NULL ids match NULL
    ids, and repeated rows share their decision.
    """
    own = {"_digest": digest_of, "_print": print_of}[key](docs[text_col])
    return docs.join(decisions, docs[id_col].eqNullSafe(decisions["_id"]) & (own == decisions[key]), how)
