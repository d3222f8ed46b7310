"""What the corpus operators share: the shared folder, cut lineage and Arrow-batched row functions."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code units of one whitespace class used by every word definition here: U+0020 and U+0009 to U+000D.
#: It is also what ``bytes.split()`` and ``bytes.strip()`` take as white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that are turned into Python objects at once.
SLICE_ROWS = 512


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, as the cluster names it.

    Only a session in one JVM (``local[n]``, as in tests) gets a folder of its own where it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="orolog-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/orolog-{spark.sparkContext.applicationId}"


#: Paths of the tables that this driver has written, in order.
_written: list[str] = []


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and it survives lost executors."""
    spark = df.sparkSession
    root = shared_root(spark)
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)  # with the driver, as results may be read till then
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """Number of tables that `cut` has written."""
    return len(_written)


def release(spark: SparkSession, since: int) -> None:
    """Delete the tables that `cut` has written since there were `since`, but for the last: what they led to is in it."""
    for path in _written[since:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _written[since:-1] = []


def columns(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    """Columns by their exact names, whatever characters these have."""
    return [df[f"`{n.replace('`', '``')}`"] for n in names or df.columns]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of doc_id as text leaves 1 modulo 3; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: What the tasks of this process share, by its key: one thing at a time.
_held: dict[str, Any] = {}
#: Keys that the present task has asked for.
_asked: set[str] = set()


def held(key: str, make: Callable[[], Any]) -> Any:
    """What this process's tasks share under `key`, made by the first of them; anything else that it held is let go."""
    _asked.add(key)
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drop what earlier tasks of this process have left."""
    _held.clear()
    gc.collect()


def _task_begins() -> None:
    _asked.clear()


def _task_ends() -> None:
    """Let go of what the task has not asked for, and return free memory to the system: workers outlive a stage, and what they keep counts against their executor."""
    if _held and not _asked:
        let_go()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``; after a task its process keeps nothing but what the task has asked `held` for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _task_begins()  # functions of this module, as a task has copies of the variables that it names itself
        try:
            yield from run(batches)
        finally:
            _task_ends()

    return df.mapInArrow(task, schema)


def map_rows(df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable[..., Any]]) -> DataFrame:
    """Run Python over ``df`` in Arrow batches.

    ``make()`` runs once in each task and returns ``f(*columns) -> list of output columns``; the columns
    are Python lists of at most SLICE_ROWS values. Nothing is kept between batches but what ``make`` keeps.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                out = row_fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    return map_batches(df, run, target)


def keep_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of ``df`` whose text the function that ``make`` returns in each task says yes to; all columns as they are."""
    at = df.columns.index(text_col)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = make()
        for batch in batches:
            yield batch.filter(pa.array([good(v.as_py()) for v in batch.column(at)], pa.bool_()))

    return map_batches(plain, keep, plain.schema).toDF(*df.columns)


def running_sums(df: DataFrame, order: list[str | Column], sums: dict[str, str], place: str, label: str = "running-sums") -> DataFrame:
    """``df`` with sums of whole-numbered columns over all rows before each in `order`, and its place among all rows.

    A range exchange puts rows in order; each task writes the sums within its own partition, and the totals of the
    partitions, one row each, make them global. Rows equal in all of `order` should end it with a tie-breaking column, so
    that no number of them meets in one task.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    added = ["__part", *sums, place]
    out = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in added)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, at = to_arrow_schema(out), [df.columns.index(c) for c in sums.values()]

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, n = TaskContext.get().partitionId(), [0] * len(at), 0
        for b in batches:
            if not b.num_rows:
                continue
            more = [pa.array(np.full(b.num_rows, part, np.int64))]
            for k, i in enumerate(at):
                value = b.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(value) + before[k]
                more.append(pa.array(ends - value))
                before[k] = int(ends[-1])
            more.append(pa.array(np.arange(n, n + b.num_rows, dtype=np.int64)))
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns, arrow, strict=False)), *more], schema=arrow)

    local = cut(map_batches(ordered, running, out), label)
    totals = local.groupBy("__part").agg(*(F.sum(c).alias(n) for n, c in sums.items()), F.count("*").alias(place)).orderBy("__part").collect()  # one row for each partition
    offsets, base = [], [0] * (len(sums) + 1)
    for t in totals:
        offsets.append((t["__part"], *base))
        base = [x + t[n] for x, n in zip(base, (*sums, place), strict=True)]
    names = [f"__base{k}" for k in range(len(base))]
    bases = spark.createDataFrame(offsets, ", ".join(f"{n} long" for n in ("__part", *names)))
    joined = local.join(F.broadcast(bases), "__part")  # as many rows as partitions
    return joined.select(*columns(joined, df.columns), *((joined[n] + joined[b]).alias(n) for n, b in zip((*sums, place), names, strict=True)))
