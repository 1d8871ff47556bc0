"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# The ASCII white space that separates words, as a pattern of
# words for the JVM. In Python ``bytes.split()`` splits at the same six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE = b" \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder below the shared folder that the cluster names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, what: str, partition_by: str | None = None, gathered: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors and is computed once. The shuffle files
    of the write are removed with it, since only the table is read afterwards.

    ``gathered``: the rows of all tasks are dealt evenly to as many files as the
    cluster runs tasks at once. For tables of few bytes a row that come out of
    wide shuffles: else each task writes a file of its own, however small, and
    on file systems without native calls each file starts several processes.
    """
    spark = df.sparkSession
    if gathered:
        df = df.repartition(spark.sparkContext.defaultParallelism)
    path = shared_folder(spark, what)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """What is planned inside goes to the Python workers in Arrow batches of
    about ``size`` bytes, if the session says nothing."""
    before = spark.conf.get(_BATCH, None)
    if before is None:
        spark.conf.set(_BATCH, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)


def remove(df_or_path, spark: SparkSession | None = None) -> None:
    """Delete a folder made by ``written`` once nothing reads it any more."""
    if isinstance(df_or_path, DataFrame):
        spark, paths = df_or_path.sparkSession, {f.rsplit("/part-", 1)[0] for f in df_or_path.inputFiles()}
    else:
        paths = {df_or_path}
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def binary_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column (no decoding, so odd bytes do no harm)."""
    return column.cast(pa.binary()).to_pylist()


def portions(batches: Iterator[pa.RecordBatch], place: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text (column ``place``)
    each, one row at least, so that a worker never holds a whole batch's texts
    and words as Python objects. Empty batches go."""
    for batch in batches:
        size = pc.binary_length(batch.column(place)).fill_null(0).to_numpy().astype(np.int64)
        cuts = (np.flatnonzero(np.diff((np.cumsum(size) - size) // most)) + 1).tolist()
        for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
            if z > a:
                yield batch.slice(a, z - a)


def chunks(texts: list[bytes | None], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each (one row at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Ids(dict):
    """word -> number in the order of first sight."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Hashes(dict):
    """word -> 64-bit hash, remembered for at most ``most`` words."""

    def __init__(self, most: int = 100_000):
        self.most = most

    def __missing__(self, word):
        import xxhash
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class TwoGenerations:
    """A memo of at most twice ``most`` entries. When the young half is full
    it becomes the old half; an old entry that is asked for is young again, so
    frequent keys stay and rare ones go."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def hold(self, keys: set, make) -> None:
        """See that all keys are in the young half; ``make`` gives the entries of a list of unknown ones."""
        missing = keys - self.young.keys()
        unknown = []
        for k in missing:
            if k in self.old:
                self.young[k] = self.old[k]
            else:
                unknown.append(k)
        self.young.update(make(unknown))

    def turn(self) -> None:
        """Between two rounds of work: let the old half go if the young one is full."""
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}


_STATE = "_corpus_worker_state"


def worker_state(key, make):
    """What a Python worker keeps from task to task: ``make()`` once a key.

    Functions are pickled by value, so their module's own globals live for one
    task only; the interpreter's module table lives as long as the worker."""
    import sys
    import types
    kept = sys.modules.setdefault(_STATE, types.ModuleType(_STATE)).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def forget(name: str) -> None:
    """Let go of what ``worker_state`` keeps under keys that begin with
    ``name``, and of memory freed so far, which workers that live on would hold
    beside the tables of later stages."""
    import ctypes
    import gc
    import sys
    kept = sys.modules[_STATE].__dict__ if _STATE in sys.modules else {}
    found = [k for k in kept if isinstance(k, tuple) and k[0] == name]
    for k in found:
        del kept[k]
    if found:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shift-multiply finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def shingle_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive 64-bit hashes of all ``width``-word windows; with fewer
    words, of the whole sequence as one window; none without words."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    w = min(width, n)
    out = np.full(n - w + 1, w, np.uint64)
    for j in range(w):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[j:n - w + 1 + j])
    return out


def crc_bucket(doc_id, mod: int) -> int:
    """crc32 of the id as text, modulo ``mod`` (null id: bucket of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def crc_bucket_col(doc_id: str, mod: int) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod
