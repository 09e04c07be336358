"""What the training-data operators share: reading, shared scratch folders, words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where a local session without spark.checkpoint.dir puts shared files.
LOCAL = "file:///tmp/skygrid-shared"
#: A process keeps all its folders in one.
RUN = f"llm-run-{uuid.uuid4().hex}"


def base_dir(spark: SparkSession) -> str:
    """This process's folder under spark.checkpoint.dir, which driver and
    executors share. A local session may have none: nothing is set then, the
    folder is just elsewhere."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = LOCAL
    return f"{base.rstrip('/')}/{RUN}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{base_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Removes what this process's operators wrote to the shared folder: models,
    token files and intermediate tables. DataFrames that read them can't be
    read afterwards, so it is the caller's last step."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and an executor lost later costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let Arrow batches hold no more than ``rows`` texts, so that a Python
    worker's memory stays small beside its executor's."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` with a broadcast hint, if it has no more than ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def tokens(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased. bytes.split() and bytes.lower() treat exactly
    the ASCII white space and letters that the word definition names."""
    return text.lower().split() if text else []


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of two 64-bit values, as unsigned integers."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, dtype=np.uint64)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x


class WordHashes:
    """64-bit hashes of words with a bounded memo per worker."""

    def __init__(self, limit: int = 200_000):
        self.limit, self.memo = limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        memo = self.memo
        if len(memo) > self.limit:
            memo.clear()
        for w in set(words):
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


@contextmanager
def new_file(uri: str) -> Iterator:
    """A stream to a file that has another name until it is whole, so that a
    retried or duplicate task leaves one complete file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        yield out
    store.move(part, path)


def put_file(uri: str, data: bytes) -> None:
    """Write a whole file, as ``new_file`` does."""
    with new_file(uri) as out:
        out.write(data)


def remove_file(uri: str) -> None:
    """Remove a file that no task reads any more."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.delete_file(path)


def open_file(uri: str):
    """A file of the shared store for random access; memory-mapped where the
    store is a mounted folder."""
    import pyarrow as pa
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def map_array(uri: str, dtype, offset: int = 0, count: int = -1) -> np.ndarray:
    """A read-only array over a file's bytes; pages come in as they are touched."""
    with open_file(uri) as f:
        f.seek(offset)
        size = f.size() - offset if count < 0 else count * np.dtype(dtype).itemsize
        return np.frombuffer(f.read_buffer(size), dtype) if size else np.empty(0, dtype)


def slices(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``limit`` at most, or single rows."""
    runs, first, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and total + n > limit:
            runs.append((first, i))
            first, total = i, 0
        total += n
    if len(sizes) > first:
        runs.append((first, len(sizes)))
    return runs


def text_runs(b, limit: int):
    """(first row, row after, texts as bytes) over a record batch with a column
    text, in runs of about ``limit`` bytes; null is empty."""
    import pyarrow as pa
    from pyarrow import compute as pc

    column = b["text"].cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for i, j in slices(sizes, limit):
        yield i, j, [t or b"" for t in column.slice(i, j - i).to_pylist()]


def worker_state() -> dict:
    """What a reused Python worker keeps between tasks: only memos of bounded
    size that any task can fill again."""
    import sys

    return sys.__dict__.setdefault("_skygrid_worker_state", {})
