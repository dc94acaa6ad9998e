"""What the operators share: tables, words, chunks of rows, scratch tables, split points."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are none of space, tab, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Rows in an Arrow batch where the session doesn't say: texts are long, and both ends of a Python worker hold a batch.
ARROW_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ARROW_ROWS rows, unless the session has a number of its own. The rows of a batch are in the memory
    of the executor and of its Python worker, each twice while they are copied."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run):
    """A function for mapInArrow that gives unused memory back when a task ends; a worker lives on between tasks."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def words(text: bytes) -> list[bytes]:
    """The words of a text. bytes.split() splits at exactly the six characters above."""
    return text.split()


def chunks(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about most_bytes of text, one row at least, with the texts as UTF-8 (null: empty)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0))
        ends, start, total = [], 0, 0
        for i, s in enumerate(sizes.tolist()):
            if total and total + s > most_bytes:
                ends.append((start, i))
                start, total = i, 0
            total += s
        ends.append((start, n))
        for a, b in ends:
            part = batch.slice(a, b - a)
            texts = part.column(part.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            yield part, [t or b"" for t in texts]


class Hashes(dict):
    """The 64-bit hash of each word; forgets what it holds when it holds too much."""

    def __init__(self, most: int = 100_000):
        import xxhash

        self.most, self.of = most, xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = self.of(word, 42)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: The multiplier of rolled hashes; odd, so that a single differing word always changes the sum.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def rolled(h: np.ndarray, length: int) -> np.ndarray:
    """For each start, the polynomial hash of `length` consecutive values. Windows are joined from windows of powers of two."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    rest = length
    while rest:
        if rest & 1:
            part = power[done : done + n]
            out = part.copy() if out is None else out * np.uint64(pow(BASE, size, 1 << 64)) + part
            done += size
        rest >>= 1
        if rest:
            power = power[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + power[size:]
            size *= 2
    return out


_scratch: list[tuple[SparkSession, str]] = []


def _clean() -> None:
    for spark, path in _scratch:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone by now
            return


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, spark.checkpoint.dir. Where the session doesn't name one, only a
    local master has a substitute, the warehouse's folder; on a cluster that is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not _scratch:
        atexit.register(_clean)
    path = f"{top.rstrip('/')}/seiche-{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later frame reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to shared storage and read again: its lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs now instead of at its next periodic collection."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def code_points(c):
    return F.char_length(c).cast("bigint")


def u64(h: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark's bigint with the same bits."""
    return pa.array(np.ascontiguousarray(h).view(np.int64))
